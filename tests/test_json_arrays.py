"""JSON arrays read by many tasks: the same elements and positions as a whole parse."""

import json
import random

import pytest

from wordloom.session import run_folder
from wordloom.sources import json_arrays


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "50"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def value(r, depth=0):
    kind = r.randrange(9 if depth < 3 else 6)
    if kind < 3:
        return "".join(r.choices(['a', ',', '"', '\\', '[', ']', '{', '}', 'א', '\n', ':', ' ', '/', '😀'], k=r.randint(0, 25)))
    if kind < 6:
        return [None, True, 12, -1.5e3][r.randrange(4)]
    if kind == 6:
        return [value(r, depth + 1) for _ in range(r.randint(0, 4))]
    return {f"k{j}{r.choice(['', ',', chr(34)])}": value(r, depth + 1) for j in range(r.randint(0, 4))}


@pytest.mark.parametrize("indent, ascii", [(None, False), (2, False), (None, True)])
def test_one_file_over_many_tasks(spark, small_ranges, tmp_path, indent, ascii):
    r = random.Random(indent)
    want = [value(r) for _ in range(700)]
    (tmp_path / "a.json").write_text(json.dumps(want, indent=indent, ensure_ascii=ascii), encoding="utf-8")
    (tmp_path / "b.json").write_text("  [ ]\n")
    (tmp_path / "c.json").write_text("﻿ [1]\n", encoding="utf-8")
    assert spark.read.option("lineSep", ",").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 20
    got = json_arrays.elements(spark, str(tmp_path)).orderBy("file", "ord").collect()
    assert [json.loads(x.value) for x in got if x.file.endswith("a.json")] == want
    assert [x.ord for x in got if x.file.endswith("a.json")] == list(range(len(want)))
    assert [(x.file[-6:], x.ord, x.value) for x in got if not x.file.endswith("a.json")] == [("c.json", 0, "1")]


@pytest.mark.parametrize("text", ['{"a": [1, 2]}', "[1, 2", '["a, b', "1, 2", "[1]]"])
def test_what_is_no_array_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="no JSON array"):
        json_arrays.elements(spark, str(tmp_path)).collect()


def test_written_arrays_are_read_back_in_order(spark, small_ranges):
    at = run_folder(spark, "arrays")
    rows = [(k, "a, [b] \"c\" \\ {" * (k % 5) + "א") for k in range(200)]
    json_arrays.write(spark.createDataFrame(rows, "k long, t string").repartition(3, "k"), at, ["k"])
    got = json_arrays.records(spark, at, "k long, t string").collect()
    assert sorted((x.k, x.t) for x in got) == rows
    for file in {x.file for x in got}:
        own = sorted((x.ord, x.k) for x in got if x.file == file)
        assert [o for o, _ in own] == list(range(len(own))) and [k for _, k in own] == sorted(k for _, k in own)
