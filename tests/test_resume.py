"""Runs that are stopped between and within parts, and updates that keep what was there."""

import os

import pytest
from pyspark.sql import functions as F

from timeweave.sources import resume

EVENTS = "/root/testdata/sf0.001/events.parquet"


def totals(rows):
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def test_a_stopped_run_is_taken_up(spark, tmp_path):
    path, events = str(tmp_path / "out"), spark.read.parquet(EVENTS)
    events = events.unionByName(events.limit(3).withColumn("user_id", F.lit(None).cast("long")))
    done, calls = [], []

    def work(rows):
        calls.append(len(done))
        if len(calls) == 4:
            # written in part, then lost
            totals(rows).limit(1).write.parquet(f"{path}/data/part=3")
            raise KeyboardInterrupt
        return totals(rows)

    with pytest.raises(KeyboardInterrupt):
        for part in resume.process(events, "user_id", path, work, 8):
            done.append(part)
    assert done == [0, 1, 2] == resume.finished(spark, path)
    some = {tuple(r) for r in resume.result(spark, path).collect()}
    open(f"{path}/_manifest/part-5.abc.tmp", "w").close()  # a manifest entry that was never renamed
    calls.clear()
    assert list(resume.process(events, "user_id", path, lambda rows: calls.append(1) or totals(rows), 8)) == [3, 4, 5, 6, 7] and len(calls) == 5
    whole = [tuple(r) for r in resume.result(spark, path).collect()]
    want = {tuple(r) for r in totals(events).collect()}
    assert {(k, n, round(t, 6)) for k, n, t in whole} == {(k, n, round(t, 6)) for k, n, t in want} and len(whole) == len(want) and some < set(whole)
    assert list(resume.process(events, "user_id", path, None, 8)) == []
    with pytest.raises(ValueError, match="another plan"):
        list(resume.process(events, "user_id", path, totals, 9))


def test_no_part_and_empty_tables(spark, tmp_path):
    events = spark.read.parquet(EVENTS).limit(0)
    with pytest.raises(ValueError, match="no finished part"):
        resume.result(spark, str(tmp_path / "none"))
    assert list(resume.process(events, "user_id", str(tmp_path / "e"), totals, 2)) == [0, 1]
    assert resume.result(spark, str(tmp_path / "e")).count() == 0


def test_updates_keep_the_first_table(spark, tmp_path):
    path = str(tmp_path / "t")
    resume.update_in_place(spark.range(3), path)
    assert not os.path.exists(f"{path}.orig")
    for _ in range(2):
        # made from the table itself
        assert resume.update_in_place(spark.read.parquet(path).select((F.col("id") + 1).alias("id")), path) == f"{path}.orig"
    dated = resume.update_in_place(spark.range(1), path, dated=True)
    ids = lambda p: sorted(r["id"] for r in spark.read.parquet(p).collect())
    assert (ids(path), ids(dated), ids(f"{path}.orig")) == ([0], [2, 3, 4], [0, 1, 2])
    with pytest.raises(Exception, match="broken"):
        resume.update_in_place(spark.read.parquet(path).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert ids(path) == [0]
    assert sorted(x.split(".")[1] if "." in x else x for x in os.listdir(tmp_path) if not x.endswith(".new"))[0:2] == [dated.rsplit(".", 2)[1], "orig"]
