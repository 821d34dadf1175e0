"""Sinks that commit: a failed write and repeated tasks leave one version."""

import json

import pytest
from pyspark.sql import functions as F

from wordloom.session import run_folder
from wordloom.sinks import committed


def values(spark, at):
    return [r.value for r in committed.read(spark, at).orderBy("part", "pos").collect()]


def test_lines_come_back_in_order(spark):
    at = run_folder(spark, "sink")
    df = spark.range(1000).select(F.concat(F.lit("x א,"), F.format_string("%04d", "id")).alias("value"), "id")
    committed.write(df.repartition(7).orderBy(F.desc("id")), at)
    assert values(spark, at) == [f"x א,{k:04d}" for k in range(999, -1, -1)]
    committed.write(df.where("id < 3").orderBy("id"), at, mode="append")
    assert len(values(spark, at)) == 1003 and values(spark, at)[-1] == "x א,0002"
    committed.write(df.where("id = 5"), at)
    assert values(spark, at) == ["x א,0005"] and committed.clean(at) > 0 and values(spark, at) == ["x א,0005"]


def test_a_write_that_fails_changes_nothing(spark):
    at = run_folder(spark, "sink")
    committed.write(spark.range(10).select(F.col("id").cast("string").alias("value")), at)
    number = committed.manifest(at)[0]
    bad = spark.range(0, 400, 1, 4).select(F.when(F.col("id") == 399, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("string").alias("value"))
    with pytest.raises(Exception, match="lost"):
        committed.write(bad, at)
    assert committed.manifest(at)[0] == number and sorted(values(spark, at)) == sorted(map(str, range(10)))


def test_repeated_attempts_count_once(tmp_path, monkeypatch):
    """Two attempts of a part were made, one is reported."""
    writer = committed.CommittedWriter(str(tmp_path), "lines", 100, True)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"value": ["a", "b"]})
    monkeypatch.setattr(committed.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 3})()))
    first, second = writer.write(iter([batch])), writer.write(iter([batch]))
    assert first.folder != second.folder
    writer.commit([None, second])
    assert committed.manifest(str(tmp_path))[1]["parts"] == [{"folder": second.folder, "rows": 2}]
    assert committed.clean(str(tmp_path)) == 1
    lost = writer.write(iter([batch]))
    writer.abort([lost, None])
    assert committed.clean(str(tmp_path)) == 0


def test_batches_hold_a_hundred_and_the_rest(spark):
    at = run_folder(spark, "sink")
    df = spark.range(0, 250, 1, 1).select(F.to_json(F.struct("id")).alias("value"))
    committed.write(df, at, "batches")
    got = [json.loads(v) for v in values(spark, at)]
    assert [len(x) for x in got] == [100, 100, 50] and [y["id"] for x in got for y in x] == list(range(250))


def test_one_file_per_name(spark):
    at = run_folder(spark, "sink")
    rows = [("a b.txt", "one\n\ntwo", 1), ("a b.txt", "last", 3), ("a b.txt", "mid", 2), ("שיר+%20.txt", "x", 1), ("c.txt", "x", 1)]
    committed.write(spark.createDataFrame(rows, "file_name string, body string, ord int"), at, "files")
    committed.write(spark.createDataFrame([("c.txt", "new", 1)], "file_name string, body string, ord int"), at, "files", mode="append")
    got = {r.file_name: r.body for r in committed.read(spark, at).collect()}
    assert got == {"a b.txt": "last", "c.txt": "new", "שיר+%20.txt": "x"}


def test_nothing_written(spark):
    at = run_folder(spark, "sink")
    assert committed.read(spark, at).collect() == []
    committed.write(spark.range(0).select(F.lit("x").alias("value")), at)
    assert committed.read(spark, at).collect() == []
    with pytest.raises(Exception, match="needs the columns"):
        spark.range(1).write.format("committed").option("kind", "files").mode("append").save(at)
