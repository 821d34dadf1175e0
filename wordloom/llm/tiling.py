"""Benchmark decontamination by greedy string tiling.

Tokens are words of letters and digits, ASCII case folded. Seeds are windows of
``MIN_TILE`` tokens. Documents and benchmark items are joined on shared seeds;
then, for every (document, item) pair that can reach the threshold, greedy
tiling marks the longest match of unmarked tokens again and again, found by
Karp-Rabin hashes of decreasing length, until no match of ``MIN_TILE`` tokens is
left. Tiles never overlap and may come in any order, so reordered passages
count. A document is contaminated by an item when the tiles cover at least
``THRESHOLD`` of the item's tokens.

Every tile is a run of shared seeds, so the tiling works on seed positions and
no text is shuffled. Documents emit only seeds that pass a bitmap of the
benchmark's seeds. Its size is fixed, so it can be broadcast whatever the size
of the benchmark; the join that follows is exact.

Defined results: null and empty texts have no tokens and are never
contaminated. An item with fewer tokens than ``MIN_TILE`` is one seed, its whole
token sequence. Items without tokens match nothing. Equal items, equal
documents and repeated ids are handled row by row; ties of coverage go to the
smallest item id. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common, kernel

MIN_TILE = 5
THRESHOLD = 0.8
SEED_BITS = 24
U64 = np.uint64
MOD, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E687

ITEM_SEEDS = pa.schema([("item_id", pa.int64()), ("m", pa.int32()), ("n", pa.int32()), ("seeds", pa.list_(pa.int64()))])
DOC_SEEDS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("seeds", pa.list_(pa.struct([("p", pa.int32()), ("h", pa.int64())])))])


def _rows(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(index, token hashes) of each text."""
    separators = kernel.not_letters()
    for first, last, data, offsets in kernel.chunks(texts):
        h, row, _ = kernel.words(data, offsets, separators)
        bounds = np.searchsorted(row, np.arange(last - first + 1))
        for i in range(last - first):
            yield first + i, h[bounds[i]: bounds[i + 1]]


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per item: seed width m (MIN_TILE, or fewer for a short item), token count and seed hashes in order."""
    for b in common.slices(batches):
        ids, ms, ns, seeds = [], [], [], []
        id_list = b.column(0).to_pylist()
        for i, h in _rows(b.column(1).to_pylist()):
            if len(h):
                m = min(MIN_TILE, len(h))
                ids.append(id_list[i])
                ms.append(m)
                ns.append(len(h))
                seeds.append(kernel.combine(h, m).view(np.int64))
        yield common.batch(ITEM_SEEDS, ids, ms, ns, pa.array(seeds, pa.list_(pa.int64())))


def _doc_seeds(shared, widths: list[int]):
    """Documents with seeds that pass the benchmark's bitmap, and where these stand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = shared.value
        separators = kernel.not_letters()
        for b in common.slices(batches):
            ids, rows = b.column(0).to_pylist(), b.column(2).to_pylist()
            out_ids, out_rows, sizes, ps, hs = [], [], [0], [], []
            for first, last, data, offsets in kernel.chunks(b.column(1).to_pylist()):
                h, row, _ = kernel.words(data, offsets, separators)
                starts = np.searchsorted(row, np.arange(last - first + 1))
                at, found = [], []
                for m in widths:
                    w = kernel.combine(h, m)
                    hit = np.flatnonzero(common.in_bitmap(present, w))
                    hit = hit[row[hit] == row[hit + m - 1]]
                    at.append(hit)
                    found.append(w[hit])
                at, found = np.concatenate(at), np.concatenate(found)
                by = np.argsort(at, kind="stable")
                at, found = at[by], found[by].view(np.int64)
                of, counts = np.unique(row[at], return_counts=True)
                out_ids += [ids[first + i] for i in of]
                out_rows += [rows[first + i] for i in of]
                sizes += counts.tolist()
                ps.append((at - starts[row[at]]).astype(np.int32))
                hs.append(found)
            if out_ids:
                values = pa.StructArray.from_arrays([pa.array(np.concatenate(ps)), pa.array(np.concatenate(hs))], names=["p", "h"])
                yield common.batch(DOC_SEEDS, out_ids, out_rows, pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), values))
    return run


# --- greedy string tiling -------------------------------------------------------
def _runs(positions: np.ndarray, free: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [a, z) of consecutive unmarked seed starts (indexes into positions)."""
    keep = np.flatnonzero(free)
    if not len(keep):
        return []
    cut = np.flatnonzero((np.diff(positions[keep]) != 1) | (np.diff(keep) != 1)) + 1
    return [(int(g[0]), int(g[-1]) + 1) for g in np.split(keep, cut)]


def _windows(h: np.ndarray, a: int, z: int, s: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of every window of s seeds in [a, z)."""
    if z - a < s:
        return
    lead = pow(BASE, s - 1, MOD)
    v = 0
    for i in range(a, a + s):
        v = (v * BASE + int(h[i])) % MOD
    yield a, v
    for i in range(a + s, z):
        v = ((v - int(h[i - s]) * lead) * BASE + int(h[i])) % MOD
        yield i - s + 1, v


def tile(doc_pos: np.ndarray, doc_h: np.ndarray, item_h: np.ndarray, m: int, n: int) -> int:
    """Tokens of an item of ``n`` tokens covered by greedy tiles of at least ``m`` tokens.

    ``doc_pos`` and ``doc_h``: where the document has seeds of the item, in
    order; ``item_h``: the item's seed at every position.
    """
    doc_free, item_free = np.ones(len(doc_pos), bool), np.ones(len(item_h), bool)
    item_pos = np.arange(len(item_h))
    covered = 0
    longest = len(item_h)
    while longest >= 1:
        item_runs, doc_runs = _runs(item_pos, item_free), _runs(doc_pos, doc_free)
        longest = min(longest, max((z - a for a, z in item_runs), default=0), max((z - a for a, z in doc_runs), default=0))
        if longest < 1:
            break
        where: dict[int, list[int]] = {}
        for a, z in item_runs:
            for i, v in _windows(item_h, a, z, longest):
                where.setdefault(v, []).append(i)
        for a, z in doc_runs:
            for i, v in _windows(doc_h, a, z, longest):
                for j in where.get(v, ()):
                    if item_free[j: j + longest].all() and doc_free[i: i + longest].all() and (item_h[j: j + longest] == doc_h[i: i + longest]).all():
                        tokens = longest + m - 1
                        covered += tokens
                        # seeds that touch a marked token are no longer free
                        item_free[max(0, j - m + 1): j + tokens] = False
                        p = doc_pos[i]
                        doc_free[(doc_pos > p - m) & (doc_pos < p + tokens)] = False
                        break
        longest -= 1
    return min(covered, n)


TILED = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("item_id", pa.int64()), ("covered", pa.int32()), ("n", pa.int32())])


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.slices(batches, 128):
        covered = []
        for seeds, item, m, n in zip(b.column(3), b.column(4), b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True):
            p, h = seeds.values.field(0).to_numpy(), seeds.values.field(1).to_numpy()
            p, by = np.unique(p, return_index=True)  # repeated rows bring a seed twice
            covered.append(tile(p, h[by], item.values.to_numpy(), m, n))
        yield common.batch(TILED, b.column(0), b.column(1), b.column(2), covered, b.column(6))


def leaks(docs: DataFrame, benchmark: DataFrame, folder: str, threshold: float = THRESHOLD) -> DataFrame:
    """(row, doc_id, item_id, covered, n): pairs whose tiles cover at least ``threshold`` of the item.

    ``docs``: (row, doc_id, text), ``row`` telling rows apart; ``benchmark``: (item_id, text).
    """
    spark = docs.sparkSession
    items = common.written(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
                           .mapInArrow(_item_seeds, "item_id long, m int, n int, seeds array<long>"), f"{folder}/items")
    # equal items are tiled once, under the smallest id
    items = items.groupBy("m", "n", "seeds").agg(F.min("item_id").alias("item_id"))
    items = common.written(items, f"{folder}/distinct-items")
    seeds = items.select("item_id", "m", "n", F.explode("seeds").alias("h")).groupBy("item_id", "m", "n", "h").agg(F.count("*").cast("int").alias("k"))
    widths = sorted(r["m"] for r in items.select("m").distinct().collect())
    if not widths:
        return spark.createDataFrame([], "row long, doc_id long, item_id long, covered int, n int")
    shared = spark.sparkContext.broadcast(common.bitmap(seeds, "h", SEED_BITS))
    found = (docs.select("doc_id", F.col("text").cast("string").alias("text"), "row")
             .mapInArrow(_doc_seeds(shared, widths), "doc_id long, row long, seeds array<struct<p:int,h:long>>")
             .select("doc_id", "row", F.explode("seeds").alias("x")).select("doc_id", "row", "x.p", "x.h"))
    # a tile of L tokens has L - m + 1 seeds, so tiles cover at most m tokens for each place of the item whose seed was found (k places of one seed)
    pairs = (found.join(seeds, "h").groupBy("row", "doc_id", "item_id", "m", "n")
             .agg(F.collect_list(F.struct("p", "h", "k")).alias("at")))
    places = F.aggregate(F.array_distinct(F.transform("at", lambda x: F.struct(x["h"].alias("h"), x["k"].alias("k")))), F.lit(0), lambda a, x: a + x["k"])
    pairs = pairs.where(places * F.col("m") >= F.lit(threshold) * F.col("n"))
    at = F.transform("at", lambda x: F.struct(x["p"].alias("p"), x["h"].alias("h"))).alias("at")
    whole = pairs.select("doc_id", "row", "item_id", at).join(items, "item_id").select("doc_id", "row", "item_id", "at", "seeds", "m", "n")
    tiled = whole.mapInArrow(_tiled, "doc_id long, row long, item_id long, covered int, n int")
    return tiled.where(F.col("covered") >= F.lit(threshold) * F.col("n")).select("row", "doc_id", "item_id", "covered", "n")


def contamination(docs: DataFrame, benchmark: DataFrame, folder: str, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: (doc_id, contaminated, item_id, coverage); the item with the highest coverage, if any.

    Texts are tiled one by one; where rows share a ``doc_id``, all are contaminated if one is.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    found = leaks(keyed, benchmark, folder, threshold)
    best = (found.groupBy("doc_id").agg(F.min(F.struct((-F.col("covered") / F.col("n")).alias("c"), F.col("item_id").alias("i"))).alias("b"))
            .select(F.col("doc_id").alias("d"), F.col("b.i").alias("item_id"), (-F.col("b.c")).alias("coverage")))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(best, F.col("doc_id").eqNullSafe(F.col("d")), "left")
            .select("doc_id", F.col("item_id").isNotNull().alias("contaminated"), "item_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage")))
