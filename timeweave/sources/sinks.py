"""Writers. Tables go through Spark's commit protocol, so a reader never sees half of one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import fmt_hms


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", kind: str = "parquet") -> None:
    """``mode='ignore'`` keeps what is there, ``append`` adds, ``overwrite`` replaces."""
    df.write.mode(mode).format(kind).save(path)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def transcript_lines(segments: DataFrame, start: str, text: str) -> DataFrame:
    """``[MM:SS] text`` lines."""
    return segments.withColumn("line", F.concat(F.lit("["), fmt_hms(F.col(start)), F.lit("] "), F.col(text)))


def render_markdown(rows: DataFrame, keys: list[str], title: str, order: str, line: str) -> DataFrame:
    """One document per key: a heading and its lines in order."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: F.concat(F.lit("- "), x[line])), "\n")
    return rows.groupBy(*keys, title).agg(body.alias("__tw_b")).select(*keys, F.concat(F.lit("# "), F.col(title).cast("string"), F.lit("\n"), "__tw_b").alias("text"))


def timeline_json(blocks: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order])))
    return blocks.groupBy(*keys).agg(F.to_json(rows).alias("timeline"))


def unresolved_refs(refs: DataFrame, assets: DataFrame, name: str) -> DataFrame:
    return refs.select(name).distinct().join(assets.select(name).distinct(), name, "left_anti")
