"""Signals of pictures against plain versions, pixel by pixel, and the layout of pages."""

import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeweave.functions import images, loops
from timeweave.operators import aggregates, sequences

KERNELS = {"cubic": (lambda x: (1.5 * abs(x) - 2.5) * x * x + 1 if abs(x) < 1 else ((-0.5 * abs(x) + 2.5) * abs(x) - 4) * abs(x) + 2 if abs(x) < 2 else 0.0, 2), "lanczos": (lambda x: 1.0 if x == 0 else 3 * math.sin(math.pi * x) * math.sin(math.pi * x / 3) / (math.pi * x) ** 2 if abs(x) < 3 else 0.0, 3)}


def plain_line(line, to, kernel):
    f, reach = KERNELS[kernel]
    step = len(line) / to
    wide, out = max(step, 1.0), []
    for i in range(to):
        centre = (i + 0.5) * step
        w = {j: f((j + 0.5 - centre) / wide) for j in range(max(0, math.floor(centre - reach * wide + 0.5)), min(len(line), math.floor(centre + reach * wide + 0.5)))}
        value = sum(line[j] * x for j, x in w.items()) / sum(w.values())
        out.append(min(255, max(0, math.floor(value + 0.5 + 1e-9))))
    return out


def plain_resize(rows, height, width, kernel):
    wide = [plain_line(r, width, kernel) for r in rows] if len(rows[0]) != width else rows
    return [list(r) for r in zip(*(plain_line(c, height, kernel) for c in zip(*wide, strict=True)), strict=True)] if len(rows) != height else wide


def picture(rng, h, w):
    smooth = [[int(127 + 100 * math.sin(x * a + y * b)) for x in range(w)] for y in range(h)] if (a := rng.random()) and (b := rng.random()) else []
    return [[min(255, max(0, v + rng.randrange(-20, 21))) for v in row] for row in smooth]


@pytest.mark.parametrize("kernel", ["cubic", "lanczos"])
@pytest.mark.parametrize("size", [(5, 7), (32, 32), (8, 9), (40, 3)])
def test_resizing_matches_pixel_by_pixel(kernel, size):
    rng = random.Random(str(size))
    rows = picture(rng, 23, 31)
    got = images.resized(np.array([rows, rows[::-1]]), *size, kernel)
    assert np.abs(got[0] - plain_resize(rows, *size, kernel)).max() <= 1 and (got[0] == plain_resize(rows, *size, kernel)).mean() > 0.99
    flat = images.resized(np.full((1, 9, 4), 200), *size, kernel)
    assert (flat == 200).all()


def plain_ssim(a, b):
    total = []
    for y in range(len(a) - 6):
        for x in range(len(a[0]) - 6):
            p, q = ([m[y + i][x + j] for i in range(7) for j in range(7)] for m in (a, b))
            mp, mq, vp, vq = statistics.mean(p), statistics.mean(q), statistics.variance(p), statistics.variance(q)
            cov = sum((u - mp) * (v - mq) for u, v in zip(p, q, strict=True)) / 48
            c1, c2 = 2.55**2, 7.65**2
            total.append((2 * mp * mq + c1) * (2 * cov + c2) / ((mp * mp + mq * mq + c1) * (vp + vq + c2)))
    return statistics.mean(total)


def table(spark, pictures):
    rows = [(i, None if p is None else bytearray(v for r in p for v in r), len(p[0]) if p else None) for i, p in enumerate(pictures)]
    return spark.createDataFrame(rows, "i int, pixels binary, w int")


def test_signals_match_plain_versions(spark):
    rng = random.Random(4)
    pics = [picture(rng, h, w) for h, w in ((20, 24), (20, 24), (33, 17), (9, 40), (7, 7), (2, 9))]
    df = table(spark, pics).select("i", images.average_hash(F.col("pixels"), F.col("w"), size=6).alias("a"), images.difference_hash(F.col("pixels"), F.col("w")).alias("d"), images.laplacian_variance(F.col("pixels"), F.col("w")).alias("l"), images.laplacian_variance(F.col("pixels"), F.col("w"), 12).alias("narrow"))
    for r in df.collect():
        p = pics[r["i"]]
        h, w = len(p), len(p[0])
        cut = [row[int(w * 0.35 / 2) : int(w * 1.65 / 2)] for row in p[int(h * 0.35 / 2) : int(h * 1.65 / 2)]]
        small = plain_resize(cut, 6, 6, "cubic")
        mean = statistics.mean(v for row in small for v in row)
        same_bits(r["a"], [v > mean for row in small for v in row])
        wide = plain_resize(p, 8, 9, "lanczos")
        same_bits(r["d"], [row[x + 1] > row[x] for row in wide for x in range(8)])
        edges = [p[y][x - 1] + p[y][x + 1] + p[y - 1][x] + p[y + 1][x] - 4 * p[y][x] for y in range(1, h - 1) for x in range(1, w - 1)]
        assert r["l"] == (pytest.approx(statistics.pvariance(edges), abs=0.006) if edges else 0)
        assert w <= 12 or r["narrow"] != r["l"] or not edges
    pairs = table(spark, pics[:1]).join(table(spark, pics[1:2]).select(F.col("pixels").alias("p"), F.col("w").alias("v")))
    got = pairs.select(images.structural_similarity(F.col("pixels"), F.col("w"), F.col("p"), F.col("v"), None).alias("s"), images.structural_similarity(F.col("pixels"), F.col("w"), F.col("pixels"), F.col("w")).alias("one"), images.changed_fraction(F.col("pixels"), F.col("w"), F.col("p"), F.col("v"), height=20, wide=24).alias("c")).first()
    moved = statistics.mean(abs(u - v) > 24 for x, y in zip(pics[0], pics[1], strict=True) for u, v in zip(x, y, strict=True))
    assert (got["s"], got["one"], got["c"]) == (pytest.approx(plain_ssim(*pics[:2])), pytest.approx(1), pytest.approx(moved))


def same_bits(packed, bits):
    """A pixel that lies on the rounding edge may turn a bit."""
    want = np.packbits(np.array(bits)).tobytes()
    assert len(packed) == len(want) and sum((a ^ b).bit_count() for a, b in zip(packed, want, strict=True)) <= 1


def test_unreadable_pictures(spark):
    rows = [(0, None, 3), (1, b"", 3), (2, b"abcd", 3), (3, b"abc", None), (4, b"abc", 0), (5, b"a", 1)]
    df = spark.createDataFrame([(i, p and bytearray(p), w) for i, p, w in rows], "i int, pixels binary, w int")
    p, w = F.col("pixels"), F.col("w")
    got = df.select("i", images.average_hash(p, w).alias("a"), images.difference_hash(p, w).alias("d"), images.laplacian_variance(p, w).alias("l"), images.structural_similarity(p, w, p, w, None).alias("s"), images.page_grid(p, w).alias("g")).orderBy("i").collect()
    assert {r["l"] for r in got} == {0.0} and all(x is None for r in got[:5] for x in (r["a"], r["d"], r["s"], r["g"])) and got[5]["s"] is None
    assert df.limit(0).select(images.average_hash(p, w)).count() == 0
    pair = spark.createDataFrame([(bytearray([255, 0]), bytearray([254, 1])), (None, bytearray(1)), (bytearray(1), bytearray(2))], "a binary, b binary")
    assert [r[0] for r in pair.select(images.hamming_bytes(F.col("a"), F.col("b"))).collect()] == [2, None, None]


def plain_bands(flags, gap):
    out, start, missing = [], None, 0
    for i, f in enumerate(flags):
        if f:
            start, missing = i if start is None else start, 0
        elif start is not None:
            missing += 1
            if missing >= gap:
                out.append((start, i - missing + 1))
                start, missing = None, 0
    return out + ([(start, len(flags))] if start is not None else [])


def test_bands_match_a_walk():
    rng = random.Random(9)
    for _ in range(300):
        flags = [rng.random() < 0.5 for _ in range(rng.randrange(1, 40))]
        for gap in (0, 1, 2, 5):
            assert images.bands(np.array(flags), gap) == plain_bands(flags, gap)


def sheet(rows, cols, h=200, w=160):
    """A page with rows x cols dark cells."""
    page = np.full((h, w), 255, np.uint8)
    for i in range(rows):
        for j in range(cols):
            page[int(h * (i + 0.15) / rows) : int(h * (i + 0.85) / rows), int(w * (j + 0.15) / cols) : int(w * (j + 0.85) / cols)] = 60
    return page


def test_pages_of_several_slides(spark):
    """Seven pages of 3 x 2 but for a title page and a blank one: cells by consensus, the title page as one slide."""
    pages = [sheet(1, 1), *(sheet(3, 2) for _ in range(4)), np.full((200, 160), 255, np.uint8), sheet(3, 2)]
    df = spark.createDataFrame([("deck", i, bytearray(p.tobytes()), 160) for i, p in enumerate(pages)], "doc string, page int, pixels binary, w int")
    grids = df.select("doc", "page", images.page_grid(F.col("pixels"), F.col("w")).alias("grid")).cache()
    sampled = aggregates.sample_pages(grids, ["doc"], "page")
    assert sorted(r["page"] for r in sampled.collect()) == [1, 2, 3, 4, 6]
    bands = aggregates.band_consensus(sampled, ["doc"], "page", "grid")
    got = {(r["axis"], r["band"]): (r["start"], r["end"], r["pages"], r["drifts"]) for r in bands.collect()}
    assert set(got) == {("rows", i) for i in range(3)} | {("cols", i) for i in range(2)} and all(v[2:] == (5, False) for v in got.values())
    assert got["rows", 1][:2] == (pytest.approx((1.15) / 3, abs=0.006), pytest.approx(1.85 / 3, abs=0.006))
    cells = aggregates.crop_cells(grids, ["doc"], "page", "grid", bands).orderBy("slide_id").collect()
    assert [r["slide_id"] for r in cells] == list(range(1, 38)) and Counter(r["page"] for r in cells) == {0: 1, **{i: 6 for i in range(1, 7)}}
    assert [cells[0]["layout"], cells[1]["layout"]] == ["page", "consensus"] and cells[1]["left"] < cells[2]["left"] and cells[2]["top"] == cells[1]["top"] < cells[3]["top"]


def test_wide_hashes_group_frames(spark):
    """1024 bits: a step of 40, a drift of 80 from the group's first, more than 0.06 of the pixels."""
    rng = random.Random(6)
    value, rows, plain = 0, [], []
    for i in range(200):
        for bit in rng.sample(range(1024), rng.choice([0, 5, 25, 39, 40, 60])):
            value ^= 1 << bit
        rows.append((0, i, bytearray(value.to_bytes(128)), rng.choice([0.0, 0.05, 0.06, 0.0601])))
    for _, i, h, moved in rows:
        own = int.from_bytes(h)
        if not plain or (own ^ plain[-1][-1][1]).bit_count() >= 40 or (own ^ plain[-1][0][1]).bit_count() >= 80 or moved > 0.06:
            plain.append([])
        plain[-1].append((i, own))
    df = spark.createDataFrame(rows, "k int, i int, h binary, moved double")
    got = sequences.adjacent_dedup(df, ["k"], "i", changed="moved").orderBy("grp").collect()
    assert [(r["group_size"], r["first_frame"], r["kept_frame"]) for r in got] == [(len(g), g[0][0], g[-1][0]) for g in plain]


def test_payload_repetition(spark):
    line = "a line of the note that is repeated"
    unit = "".join(chr(0x4E00 + i) for i in range(300))
    cases = [(None, (0, 1.0, 0, False)), ("", (0, 1.0, 0, False)), (f"- {line}\n" * 3 + f"> __{line}", (3, None, None, False)), (f"1. `{line}`\n> - {line}\n* {line}\n   {line}", (4, None, None, True)), (f"| {line} |\n" * 9, (0, None, None, False)), (f"> [!note] {line}\n" * 9, (0, None, None, False)), ("short line\n" * 9, (0, None, None, False)), (unit + unit, (1, 300 / 593, 600, True)), (unit[:200] * 2, (1, None, 400, False)), (f"---\n{line}\n{line}\n---\n![[{line}.png]]\n{line} (see 01:02)\n{line}\n{line} https://{line.replace(' ', '')}", (3, None, None, False))]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = df.select("i", loops.payload_repetition(F.col("t")).alias("r")).orderBy("i").collect()
    for r, (t, want) in zip(got, cases, strict=True):
        assert all(w is None or g == w for g, w in zip(r["r"], want, strict=True)), (t, r["r"])
