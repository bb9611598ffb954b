"""Timed-text views of the generic tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as utterances of 15 characters a second."""
    df = table(spark, sf_dir, "conversations").withColumn("dur", F.greatest(F.lit(1).cast("long"), F.floor(F.length("text") / 15.0)))
    w = Window.partitionBy("conv_id").orderBy("turn")
    return df.withColumn("end_s", F.sum("dur").over(w)).withColumn("start_s", F.col("end_s") - F.col("dur")).select("conv_id", "turn", "role", "text", "start_s", "end_s")


SEG = """seg as (select conv_id, turn, role, text, cast(sum(dur) over (partition by conv_id order by turn) as bigint) - dur as start_s,
  cast(sum(dur) over (partition by conv_id order by turn) as bigint) as end_s
  from (select *, greatest(1, cast(floor(length(text) / 15.0) as bigint)) as dur from conversations))"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as media of ``value`` minutes from their time, in whole seconds."""
    lo = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000)
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", lo.alias("lo"), (lo + F.floor(F.col("value") * 60)).alias("hi"))


SPAN = """span as (select event_id, user_id, event_type, cast(floor(epoch_us(ts) / 1000000.0) as bigint) as lo,
  cast(floor(epoch_us(ts) / 1000000.0) as bigint) + cast(floor(value * 60) as bigint) as hi from events)"""


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign bits of the vectors as 64-bit perceptual hashes: (vec_id, label, h)."""
    bits = F.concat(*[F.when(F.element_at("embedding", i + 1) > 0, F.lit("1")).otherwise(F.lit("0")) for i in range(64)])
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.conv(bits, 2, -10).cast("long").alias("h"))


HASH = """hash as (select vec_id, label, cast(list_sum(list_transform(range(1, 65), lambda i: case when embedding[i] > 0 then cast(1 as hugeint) << cast(64 - i as int) else cast(0 as hugeint) end))
  - case when embedding[1] > 0 then cast(1 as hugeint) << 64 else cast(0 as hugeint) end as bigint) as h from embeddings)"""
