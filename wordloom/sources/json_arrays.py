"""S1 JSON arrays of any size: one file is read by many tasks.

A file is cut at its commas, which Spark's text source can do from any place in
it, so every task reads its own byte range. What a comma means depends on all
that stands before it: whether it is inside a string, and how deep the brackets
are. Both are sums over pieces: each range works out what it adds, once for a
range that is entered outside a string and once for one entered inside; the few
sums per range are added up in file order, and then every piece knows its true
parity and depth. A comma outside strings at depth one ends an element.

Elements may be objects, arrays, strings, numbers, true, false or null, written
on one line or over many. ``ord`` is the position in the array. A file that
holds no array, or none that is closed, is an error; an empty file has no
elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package

RANGE = ["file", "range"]


def _count(x: Column, chars: str) -> Column:
    """How many characters of ``x`` are one of ``chars``."""
    return F.length(x) - F.length(F.translate(x, chars, ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between commas, with its place in the file and what it adds to the quotes and to the depth."""
    raw = spark.read.option("lineSep", ",").text(path)
    p = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("i"), F.col("value").alias("piece"))
    # without escapes, every quote opens or closes a string; the parts between quotes are outside and inside strings in turn
    parts = F.split(F.regexp_replace("piece", r"(?s)\\.", ""), '"', -1)
    of = lambda side: F.array_join(F.filter(parts, lambda _, k: k % 2 == side), "")
    step = lambda x: _count(x, "{[") - _count(x, "}]")
    p = p.withColumns({"quotes": (F.size(parts) - 1).cast("long"), "_even": of(0), "_odd": of(1)})
    return p.withColumns({"even": step(F.col("_even")).cast("long"), "odd": step(F.col("_odd")).cast("long")}).drop("_even", "_odd")


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, value) of every element of the JSON arrays in the files of ``path``; ``value`` is its JSON text."""
    in_range = Window.partitionBy(*RANGE).orderBy("i")
    earlier, so_far = in_range.rowsBetween(Window.unboundedPreceding, -1), in_range.rowsBetween(Window.unboundedPreceding, 0)
    p = _pieces(spark, path)
    p = p.withColumn("entered", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)   # inside a string, if the range is entered outside one
    p = p.withColumns({"d0": F.when(F.col("entered") == 0, F.col("even")).otherwise(F.col("odd")), "d1": F.when(F.col("entered") == 0, F.col("odd")).otherwise(F.col("even"))})
    # a row per range: its quotes, and the depth that it adds when it is entered outside and inside a string
    sums = p.groupBy(*RANGE).agg(F.sum("quotes").alias("q"), F.sum("d0").alias("s0"), F.sum("d1").alias("s1"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("e", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2)
    adds = F.when(F.col("e") == 0, F.col("s0")).otherwise(F.col("s1"))
    sums = sums.withColumns({"depth": F.coalesce(F.sum(adds).over(before), F.lit(0)), "open": (F.sum(adds).over(Window.partitionBy("file")) != 0) | (F.sum("q").over(Window.partitionBy("file")) % 2 != 0)})
    p = p.join(sums.select(*RANGE, "e", "depth", "open"), RANGE)
    p = p.withColumns({"after": F.col("depth") + F.sum(F.when(F.col("e") == 0, F.col("d0")).otherwise(F.col("d1"))).over(so_far),
                       "inside": (F.col("e") + F.col("entered") + F.col("quotes")) % 2})
    p = p.withColumn("ends", ((F.col("inside") == 0) & (F.col("after") == 1)).cast("long"))
    # the element of a piece: the commas before it that end one
    ended = p.groupBy(*RANGE).agg(F.sum("ends").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    p = p.withColumn("k", F.coalesce(F.sum("ends").over(earlier), F.lit(0))).join(ended.select(*RANGE, "start"), RANGE)
    one = F.array_sort(F.collect_list(F.struct("range", "i", "piece")))
    whole = p.groupBy("file", (F.col("start") + F.col("k")).alias("ord")).agg(F.array_join(F.transform(one, lambda x: x["piece"]), ",").alias("text"), F.max_by("after", F.struct("range", "i")).alias("closed"), F.max("open").alias("open"))
    last = F.col("closed") == 0
    text = F.when(F.col("ord") == 0, F.regexp_replace("text", r"^[\uFEFF\s]*\[", "")).otherwise(F.col("text"))
    text = F.btrim(F.when(last, F.regexp_replace(text, r"\][\s]*$", "")).otherwise(text), F.lit(" \t\r\n"))
    # the last piece of a file closes its array; the first one opens it
    bad = F.col("open") | ((F.col("ord") == 0) & ~F.col("text").rlike(r"^[\uFEFF\s]*\[")) | ~F.col("closed").isin(0, 1)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("no JSON array in "), F.col("file"))).cast("string")).otherwise(text)
    return whole.select("file", "ord", checked.alias("value")).where("value != ''")


def records(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """(file, ord, fields) of arrays of objects, parsed with a schema."""
    return elements(spark, path).select("file", "ord", F.from_json("value", schema, {"mode": mode}).alias("r")).select("file", "ord", "r.*")


def write(df: DataFrame, path: str, order: list[str]) -> None:
    """One JSON array per partition, its elements in ``order``, streamed; text is written as it is."""
    ship_package(df.sparkSession)
    rows = df.sortWithinPartitions(*order).select(F.to_json(F.struct("*")).alias("value"))
    rows.mapInArrow(_array, "value string").write.mode("overwrite").text(path)


def _array(batches):
    import pyarrow as pa
    opened = False
    for b in batches:
        lines = [("," if opened or k else "[") + v for k, v in enumerate(b.column(0).to_pylist())]
        opened = opened or bool(lines)
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]"] if opened else ["[]"], pa.string())], names=["value"])
