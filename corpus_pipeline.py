"""The corpus pipeline: language ID, near duplicates, decontamination, secrets, encoding.

Each stage reads all that its predecessor kept, as Parquet, and returns a
DataFrame; all but the last return the columns of ``documents``, extra ones
included, whatever their names.

Defined results: null, empty and letterless texts go with language ID. Rows
with a null id pass like any other. Of repeated rows, and of near duplicates,
the one of least id stays (null ids last, ties by the text's hash). An empty
table gives an empty table at every stage; null lang, source or n_chars change
nothing. A stage's own scratch tables go as soon as its rows are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from timeweave.llm import byte_bpe, decontaminate, jaccard_join, language_id, secret_scan
from timeweave.llm.common import scratch, stored

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id.stage),
    ("jaccard_join", jaccard_join.stage),
    ("decontaminate", decontaminate.stage),
    ("secret_scan", secret_scan.stage),
    ("byte_bpe", byte_bpe.stage),
]

#: Stages with models and byte-level encoders can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, writing each stage's rows before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        if at + 1 == len(STAGES):
            return stage(spark, docs, sf_dir)
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
