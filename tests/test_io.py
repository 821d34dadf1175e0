"""Scans (S1, S3, S7) and file sinks (K1, K2, K6)."""

import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wordloom.operators import songs as S
from wordloom.sinks import writers as W
from wordloom.sources import tables as TB


def test_json_array_keeps_order(spark):
    d = tempfile.mkdtemp(prefix="wl-json-")
    docs = [{"word": "חברה", "songs": 2}, {"word": "צהל"}, {"word": "שלי", "songs": 1}]
    with open(f"{d}/ws.json", "w", encoding="utf-8") as f:
        json.dump(docs, f, ensure_ascii=False, indent=2)
    schema = StructType.fromDDL("word string, songs long")
    got = [(r.ord, r.word, r.songs) for r in TB.json_array(spark, f"{d}/ws.json", schema).orderBy("ord").collect()]
    assert got == [(0, "חברה", 2), (1, "צהל", None), (2, "שלי", 1)]


def test_text_files_one_row_per_song(spark):
    d = tempfile.mkdtemp(prefix="wl-songs-")
    for name, body in [("a - x.txt", "שורה\nשורה\nעוד"), ("b - y.txt", "אחרת"), ("skip.md", "no")]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(body)
    files = TB.text_files(spark, d)
    assert files.count() == 2
    lines = S.song_lines(files.withColumnRenamed("file", "song").withColumnRenamed("value", "text"))
    assert sorted(r.line for r in lines.collect()) == ["אחרת", "עוד", "שורה"]


def test_optional_prior(spark):
    schema = StructType.fromDDL("word string, sentence string")
    assert TB.optional(spark, "/nonexistent/path/x", schema).count() == 0
    d = tempfile.mkdtemp(prefix="wl-prior-")
    spark.createDataFrame([("a", "b")], schema).write.mode("overwrite").parquet(f"{d}/p")
    assert TB.optional(spark, f"{d}/p", schema).count() == 1


def test_writers_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="wl-out-")
    df = spark.createDataFrame([("חברה", 3), ("צהל", 2)], "word string, total long")
    W.write_json(df, f"{d}/json")
    back = spark.read.schema("word string, total long").json(f"{d}/json")
    assert sorted(tuple(r) for r in back.collect()) == [("חברה", 3), ("צהל", 2)]
    raw = "".join(open(os.path.join(f"{d}/json", p), encoding="utf-8").read()
                  for p in os.listdir(f"{d}/json") if p.endswith(".json"))
    assert "חברה" in raw  # non-ASCII kept as is
    W.write_lines(df.select(F.col("word").alias("line")), f"{d}/lines")
    assert sorted(r.value for r in spark.read.text(f"{d}/lines").collect()) == ["חברה", "צהל"]
    files = S.lyric_files(spark.createDataFrame([("A:B", "T?", "שורה")], "artist string, title string, lyrics string"))
    W.write_song_files(files, f"{d}/songs")
    assert {p: open(f"{d}/songs/{p}", encoding="utf-8").read() for p in os.listdir(f"{d}/songs")} == {"AB - T.txt": "T? - A:B\n\nשורה"}


def test_song_file_of_one_name_is_replaced_by_the_last(spark):
    d = tempfile.mkdtemp(prefix="wl-songs-")
    files = spark.createDataFrame([("x.txt", "first", 0), ("x.txt", "last", 2), ("x.txt", "mid", 1), ("y.txt", "y", 0)], "file_name string, body string, ord long")
    W.write_song_files(files, f"{d}/songs")
    assert {p: open(f"{d}/songs/{p}").read() for p in os.listdir(f"{d}/songs")} == {"x.txt": "last", "y.txt": "y"}
