"""Signals of pictures over the vectors as grids of 8 x 8 grey pixels, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import images
from ..operators import aggregates as A
from .proxies import table

QUERIES, SQL = {}, {}
C = F.col


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def pictures(spark, d) -> DataFrame:
    """Vectors as pictures eight pixels wide."""
    grey = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 127.5))
    return table(spark, d, "embeddings").select("vec_id", "label", images.grey_pixels(grey).alias("pixels"), F.lit(8).alias("w"))


#: g: the 64 grey levels, row by row.
GREY = "pic as (select vec_id, label, [floor((x::double + 1) * 127.5) for x in embedding] as g from embeddings)"


@query("f11_laplacian_variance", f"""with {GREY}, spot as (select r, c from range(1, 7) a(r), range(1, 7) b(c)),
e as (select vec_id, g[(r*8+c)::int] + g[(r*8+c+2)::int] + g[((r-1)*8+c+1)::int] + g[((r+1)*8+c+1)::int] - 4 * g[(r*8+c+1)::int] as v from pic, spot)
select vec_id, round(var_pop(v), 2) as sharpness from e group by 1""")
def _f11(spark, d):
    return pictures(spark, d).select("vec_id", images.laplacian_variance(C("pixels"), C("w")).alias("sharpness"))


@query("f13_average_hash", f"""with {GREY}, spot as (select r, c from range(1, 6) a(r), range(1, 6) b(c)), p as (select vec_id, r, c, g[(r*8+c+1)::int] as v from pic, spot), m as (select *, v > avg(v) over (partition by vec_id) as bit from p)
select vec_id, string_agg(case when bit then '1' else '0' end, '' order by r, c) || '0000000' as bits, count(*) filter (bit)::int as ones from m group by 1""")
def _f13(spark, d):
    """The 65 % crop of eight pixels is five wide: hashes of 25 bits without resizing."""
    h = pictures(spark, d).select("vec_id", F.hex(images.average_hash(C("pixels"), C("w"), size=5)).alias("h"))
    bits = F.lpad(F.conv("h", 16, 2), 32, "0")
    return h.select("vec_id", bits.alias("bits"), F.length(F.regexp_replace(bits, "0", "")).alias("ones"))


@query("f14_difference_hash", f"""with {GREY}, spot as (select r, c from range(0, 7) a(r), range(0, 7) b(c)), p as (select vec_id, r, c, g[(r*8+c+2)::int] > g[(r*8+c+1)::int] as bit from pic, spot)
select vec_id, string_agg(case when bit then '1' else '0' end, '' order by r, c) as bits from p group by 1""")
def _f14(spark, d):
    """The upper seven rows: hashes of 7 x 7 bits without resizing."""
    p = pictures(spark, d)
    h = p.select("vec_id", F.hex(images.difference_hash(F.substring("pixels", 1, 56), C("w"), size=7)).alias("h"))
    return h.select("vec_id", F.substring(F.lpad(F.conv("h", 16, 2), 56, "0"), 1, 49).alias("bits"))


@query("x5_structural_similarity", f"""with {GREY}, pair as (select a.vec_id, a.g as x, b.g as y from pic a join pic b on b.vec_id = a.vec_id + 1), spot as (select wr, wc, r, c from range(0, 2) a(wr), range(0, 2) b(wc), range(0, 7) d(r), range(0, 7) e(c)),
s as (select vec_id, wr, wc, avg(x[((wr+r)*8+wc+c+1)::int]) as mx, avg(y[((wr+r)*8+wc+c+1)::int]) as my, var_samp(x[((wr+r)*8+wc+c+1)::int]) as vx, var_samp(y[((wr+r)*8+wc+c+1)::int]) as vy, covar_samp(x[((wr+r)*8+wc+c+1)::int], y[((wr+r)*8+wc+c+1)::int]) as vxy from pair, spot group by 1, 2, 3)
select vec_id, round(avg((2 * mx * my + 6.5025) * (2 * vxy + 58.5225) / ((mx * mx + my * my + 6.5025) * (vx + vy + 58.5225))), 6) as ssim from s group by 1""")
def _x5(spark, d):
    """Each picture and the next, as they are."""
    p = pictures(spark, d)
    after = p.select((C("vec_id") - 1).alias("vec_id"), C("pixels").alias("other"), C("w").alias("other_w"))
    return p.join(after, "vec_id").select("vec_id", F.round(images.structural_similarity(C("pixels"), C("w"), C("other"), C("other_w"), size=None), 6).alias("ssim"))


def inked(spark, d) -> DataFrame:
    """Vectors as pages of 8 x 8 pixels, whose positive entries are ink; a label's pages in order of id are a document."""
    grey = F.transform("embedding", lambda x: F.lit(255) - F.least(F.lit(255), F.floor(F.greatest(x.cast("double"), F.lit(0.0)) * 400)))
    return table(spark, d, "embeddings").select("vec_id", "label", images.page_grid(images.grey_pixels(grey), F.lit(8)).alias("grid"))


GRID = """pic as (select vec_id, label, [255 - least(255, floor(greatest(x::double, 0) * 400)) for x in embedding] as g from embeddings),
ink as (select vec_id, label, [255 - list_avg(g[r*8+1:r*8+8]) for r in range(0, 8)] as ri, [255 - list_avg([g[(r*8+c+1)::int] for r in range(0, 8)]) for c in range(0, 8)] as ci from pic),
flag as (select vec_id, label, t, [i > t for i in ri] as rf, [i > t for i in ci] as cf from ink, (select unnest([5, 8, 12, 18, 25, 35]) as t)),
band as (select vec_id, label, t, [{'start': i / 8.0, 'end': (list_min([j for j in range(i, 9) if j = 8 or not rf[(j+1)::int]])) / 8.0} for i in range(0, 8) if rf[(i+1)::int] and (i = 0 or not rf[i::int])] as rows, [{'start': i / 8.0, 'end': (list_min([j for j in range(i, 9) if j = 8 or not cf[(j+1)::int]])) / 8.0} for i in range(0, 8) if cf[(i+1)::int] and (i = 0 or not cf[i::int])] as cols from flag),
grid as (select vec_id, label, arg_min(rows, t) as rows, arg_min(cols, t) as cols from (select *, case when len(rows) <= 4 and len(cols) <= 4 then 5 else 0 end as score, max(case when len(rows) <= 4 and len(cols) <= 4 then 5 else 0 end) over (partition by vec_id) as best from band where len(rows) > 0 and len(cols) > 0) where score = best group by 1, 2)"""


@query("s18_page_grids", f"with {GRID} select vec_id, len(rows) as n_rows, len(cols) as n_cols, list_sum([b.start for b in rows])::double as starts, list_sum([b.end for b in cols])::double as ends from grid")
def _s18(spark, d):
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda s, b: s + b[f])
    return inked(spark, d).where("grid is not null").select("vec_id", F.size("grid.rows").cast("long").alias("n_rows"), F.size("grid.cols").cast("long").alias("n_cols"), total("grid.rows", "start").alias("starts"), total("grid.cols", "end").alias("ends"))


SHAPED = f"""{GRID}, shape as (select label, len(rows) as r, len(cols) as c, count(*) as n, min(vec_id) as o from grid group by 1, 2, 3), modal as (select * from shape qualify row_number() over (partition by label order by n desc, o) = 1),
edge as (select g.label, 'rows' as axis, unnest(g.rows) as b, unnest(range(len(g.rows))) as band from grid g join modal m on m.label = g.label and len(g.rows) = m.r union all select g.label, 'cols', unnest(g.cols), unnest(range(len(g.cols))) from grid g join modal m on m.label = g.label and len(g.cols) = m.c)"""


@query("s18_band_consensus", f"with {SHAPED} select label, axis, band::int as band, median(b.start::double) as start, median(b.end::double) as \"end\", round(coalesce(stddev_samp(b.start::double), 0), 9) as start_std, round(coalesce(stddev_samp(b.end::double), 0), 9) as end_std, count(*) as pages, greatest(coalesce(stddev_samp(b.start::double), 0), coalesce(stddev_samp(b.end::double), 0)) > 0.02 as drifts from edge group by 1, 2, 3")
def _s18c(spark, d):
    out = A.band_consensus(inked(spark, d), ["label"], "vec_id", "grid")
    return out.withColumns({c: F.round(c, 9) for c in ("start_std", "end_std")})

