"""Readers of transcripts, logs and vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = "struct<start:double,end:double,text:string>"
EVENT = "ts timestamp, run_id string, stage string, event string, status string, elapsed_monotonic_s double"


def segments_json(spark: SparkSession, path: str) -> DataFrame:
    """Transcripts that are a list of segments, or an object with ``segments``; anything else is an error when read."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("lecture_id"), "value")
    plain = F.from_json("value", f"array<{SEGMENT}>", {"mode": "PERMISSIVE"})
    held = F.from_json("value", f"struct<segments:array<{SEGMENT}>>")["segments"]
    rows = F.when(F.trim("value").startswith("["), plain).otherwise(held)
    checked = F.coalesce(rows, F.raise_error(F.concat(F.lit("no segments in "), "lecture_id")).cast(f"array<{SEGMENT}>"))
    return raw.select("lecture_id", F.posexplode(checked).alias("seg_id", "s")).select("lecture_id", "seg_id", F.col("s.start").alias("start_s"), F.col("s.end").alias("end_s"), F.col("s.text").alias("text"))


def _seconds(stamp):
    return F.aggregate(F.split(F.replace(stamp, F.lit(","), F.lit(".")), ":"), F.lit(0.0), lambda a, x: a * 60 + x.cast("double"))


def parse_vtt(files: DataFrame, key: str, value: str) -> DataFrame:
    """Cues of WebVTT texts: tags and entities gone, lines of the cue before dropped, equal neighbours merged."""
    blocks = files.select(key, F.posexplode(F.split(F.replace(value, F.lit("\r"), F.lit("")), "\n\n+")).alias("pos", "b")).where(F.contains("b", F.lit("-->")))
    stamp = "([0-9:.,]+)\\s+-->\\s+([0-9:.,]+)[^\\n]*\\n?"
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("b", f"(?s)^.*?{stamp}", ""), "<[^>]*>", ""), "&nbsp;", " ")
    lines = F.filter(F.transform(F.split(F.replace(body, F.lit("&amp;"), F.lit("&")), "\n"), F.trim), lambda x: x != "")
    cues = blocks.select(key, "pos", _seconds(F.regexp_extract("b", stamp, 1)).alias("start_s"), _seconds(F.regexp_extract("b", stamp, 2)).alias("end_s"), lines.alias("lines"))
    w = Window.partitionBy(key).orderBy("pos")
    fresh = cues.withColumn("text", F.array_join(F.array_except("lines", F.coalesce(F.lag("lines").over(w), F.array().cast("array<string>"))), " ")).where("text <> ''")
    return fresh.withColumn("__tw_p", F.lag("text").over(w)).withColumn("__tw_i", F.sum((~F.col("text").eqNullSafe(F.col("__tw_p"))).cast("int")).over(w)).groupBy(key, "__tw_i").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.first("text").alias("text")).withColumn("seg_id", F.col("__tw_i") - 1).drop("__tw_i")


def event_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """JSON lines of events; extra fields are ignored, broken lines give nulls."""
    return (spark.readStream if stream else spark.read).schema(EVENT).json(path)


def words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct white-space separated words of text files."""
    return spark.read.text(path).select(F.explode(F.split("value", "\\s+")).alias("token")).where("token <> ''").distinct()


def corpus(files: DataFrame, book: str, name: str, text: str, per_book: int = 15, chars: int = 200_000) -> DataFrame:
    """At most ``per_book`` files of each book by name, each cut to ``chars``: the scan's defined limits."""
    w = Window.partitionBy(book).orderBy(name)
    return files.withColumn("__tw_r", F.row_number().over(w)).where(F.col("__tw_r") <= per_book).drop("__tw_r").withColumn(text, F.substring(text, 1, chars))


def json_strings(df: DataFrame, key: str, text: str) -> DataFrame:
    """All string values anywhere in JSON texts (not the keys), their escapes decoded."""
    found = F.regexp_extract_all(F.col(text), F.lit('"[^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+"\\s*+:?'), 0)
    values = F.filter(found, lambda x: ~F.endswith(x, F.lit(":")))
    # the literals together are a JSON list, which Spark's own parser decodes
    decoded = F.from_json(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")), "array<string>")
    return df.select(key, F.explode(decoded).alias("value"))


def classify_paths(files: DataFrame, path: str, kinds: dict[str, list[str]]) -> DataFrame:
    """The kind of each path by its extension; ``other`` without a rule."""
    ext = F.lower(F.regexp_extract(path, "\\.([^./]+)$", 1))
    kind = F.lit("other")
    for name, exts in kinds.items():
        kind = F.when(ext.isin(*exts), name).otherwise(kind)
    return files.withColumn("kind", kind)


def image_decks(files: DataFrame, path: str, kind: str = "kind", least: int = 3) -> DataFrame:
    """(folder, images): folders with at least ``least`` images, which are a deck; ``files`` as classify_paths gives them."""
    folder = F.regexp_replace(path, "/[^/]*$", "")
    return files.where(F.col(kind) == "image").groupBy(folder.alias("folder")).agg(F.count("*").alias("images")).where(F.col("images") >= least)


def frame_times(frames: DataFrame, n: str, interval_s: float) -> DataFrame:
    return frames.withColumn("t", (F.col(n) - 1) * F.lit(interval_s))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: missing ones as typed nulls, present ones cast."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
