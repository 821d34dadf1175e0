"""Helpers shared by the operators: tables, run folders, bounded filters, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.session import filesystem, run_folder, ship_package  # noqa: F401  (used by the operators)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written as Parquet to a shared folder and read again: lineage ends there."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def batch(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller record batches, so that Python objects of few rows live at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()   # the worker lives on


# --- bounded membership filter ----------------------------------------------
def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """``2**bits`` bits, set at the low bits of each value of a long column.

    The size is fixed by ``bits`` however long the column is: more values only
    mean more false positives. Spark folds the values into 64-bit words, so the
    driver gets at most ``2**(bits - 6)`` rows.
    """
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (df.select(slot.alias("s"))
             .groupBy(F.shiftright("s", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("m")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    if words.num_rows:
        out[words["w"].to_numpy()] = words["m"].to_numpy().view(np.uint64)
    return out


def in_bitmap(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which uint64 values may be in the bitmap's column (never a false no)."""
    slot = values & np.uint64(len(words) * 64 - 1)
    return (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


# --- connected components ---------------------------------------------------
def components(links: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """(v, c): each linked vertex and the smallest vertex it can reach.

    Alternating large-star and small-star steps on the edge table. Every step
    is a grouped minimum with a map-side part and an equi-join that AQE can
    split, so a vertex with very many links stays divisible. Each round is
    written to the shared folder, which also cuts the lineage.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), f"{folder}/edges-0")
    before = None
    for k in range(1, 100):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        edges = written(small, f"{folder}/edges-{k}")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        before = now
    return edges.groupBy("u").agg(F.min("v").alias("c")).select(F.col("u").alias("v"), "c") \
        .unionAll(edges.select("v").distinct().select("v", F.col("v").alias("c")))
