"""Hard-negative mining by the threshold algorithm over sorted candidate lists.

Rows are dealt into blocks of about ``BLOCK`` candidates. A block keeps, per
dimension, its candidates sorted by that component (``Lists``). An anchor walks
the lists of its non-zero dimensions from the end its component's sign names
(sorted access), scores every candidate that it meets for the first time by an
exact integer inner product (random access), and stops once the threshold, the
score of a candidate that would stand at the walk's place in every list, lies
strictly below the kth score of each of its windows: whatever was not met
scores no more than the threshold, so no tie is lost. A window with fewer than
k candidates stops below its lower end.

Two passes, each block by anchor chunk: the ``positives`` best rows of the
anchor's label, then per positive the ``negatives`` best rows of other labels
within ``[low * positive, high * positive]``. A block's bests are merged by a
window function that ranks before its shuffle. Anchors are a stated query set;
a task holds one block and one chunk of anchors, whatever the table's size.

Defined results: rows with a null id, label or vector or with a null or
non-finite component take no part. An empty vector scores 0 with everything, a
shorter vector counts as zero beyond its end. Ties go to the smaller id. Rows
that share an id are candidates each on its own, but are never positives or
negatives of an anchor of the same id; repeated anchors give their rows once
each. Components are floored to 64 bits; scores are exact and only clipped to
64 bits where they are returned. An anchor without positives, or a positive
without candidates in its window, gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm import common

BLOCK = 4096      # candidates whose lists a task holds
CHUNK = 1024      # anchors that meet a block together
STRIDE = 16       # a walk looks at its threshold after every 1/STRIDE of the lists
EXACT = 1 << 53   # integers below are exact as doubles
LONG = (-(1 << 63), (1 << 63) - 1)


def matrix(vectors: pa.Array) -> np.ndarray:
    """Integer rows of a list column, zero beyond the end of shorter ones."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


class Lists:
    """Sorted candidate lists of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T   # per dimension, ascending
        self.most = max((abs(int(x)) for x in (vectors.max(initial=0), vectors.min(initial=0))), default=0)
        self.as_double = vectors.astype(np.float64)

    def search(self, anchor: np.ndarray, anchor_id: int, windows: list[tuple[int, int]], k: int, usable: np.ndarray | None = None) -> list[list[tuple[int, int]]]:
        """Per window [low, high] of scores the best k (score, id), by score descending and id; ``usable`` masks candidates."""
        d = min(len(anchor), self.vectors.shape[1])
        exact = d * self.most * max(abs(int(x)) for x in (anchor.max(initial=0), anchor.min(initial=0))) < EXACT
        rows, a = (self.as_double, anchor.astype(np.float64)) if exact else (self.vectors.astype(object), anchor.astype(object))
        dims = np.flatnonzero(anchor[:d])
        n = len(self.ids)
        lists = [self.order[j] if a[j] < 0 else self.order[j][::-1] for j in dims]
        ok = self.ids != anchor_id
        if usable is not None:
            ok &= usable
        seen = np.zeros(n, bool)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, rows.dtype), np.zeros(0, np.int64)) for _ in windows]
        live = [w for w, (low, high) in enumerate(windows) if low <= high]
        step, at = -(-n // STRIDE), 0
        while at < n and live:
            end = min(n, at + step) if len(dims) else n
            met = np.zeros(n, bool)
            for of in lists:
                met[of[at:end]] = True
            if not len(dims):
                met[:] = True
            new = np.flatnonzero(met & ~seen & ok)
            seen |= met
            scores, ids = rows[new][:, :d] @ a[:d], self.ids[new]
            threshold = sum(a[j] * rows[of[end - 1], j] for j, of in zip(dims, lists, strict=True))
            still = []
            for w in live:
                low, high = windows[w]
                inside = (scores >= low) & (scores <= high)
                if inside.any():
                    s, i = np.concatenate([best[w][0], scores[inside]]), np.concatenate([best[w][1], ids[inside]])
                    top = np.lexsort((i, -s))[:k]
                    best[w] = s[top], i[top]
                kth = best[w][0][-1] if len(best[w][0]) == k else low
                if threshold >= kth:
                    still.append(w)
            live, at = still, end
        return [[(int(x), int(y)) for x, y in zip(*found, strict=True)] for found in best]


# --- passes -------------------------------------------------------------------
UNBOUNDED = (-(1 << 200), 1 << 200)
FOUND = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def _clipped(x: int) -> int:
    return min(max(x, LONG[0]), LONG[1])


def _found(rows: list[tuple[int, int, int, int]]) -> pa.Table:
    return pa.Table.from_batches([common.batch(FOUND, *(zip(*rows, strict=True) if rows else [[]] * 4))])


def _positives(k: int):
    def run(block: pa.Table, anchors: pa.Table) -> pa.Table:
        if not block.num_rows or not anchors.num_rows:   # such a side has no columns
            return _found([])
        ids, labels, vectors = block["vec_id"].to_numpy(), block["label"].to_numpy(), matrix(block["v"])
        of_label: dict[int, Lists | None] = {}
        out = []
        for key, i, label, a in zip(anchors["a_key"].to_pylist(), anchors["a_vec_id"].to_pylist(), anchors["a_label"].to_pylist(), matrix(anchors["a_v"]), strict=True):
            if label not in of_label:
                own = labels == label
                of_label[label] = Lists(ids[own], vectors[own]) if own.any() else None
            if (lists := of_label[label]) is not None:
                out += [(key, 0, y, _clipped(x)) for x, y in lists.search(a, i, [UNBOUNDED], k)[0]]
        return _found(out)
    return run


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score s with low * positive <= 100 * s <= high * positive."""
    return -((-low * positive) // 100), (high * positive) // 100


def _negatives(k: int, low: int, high: int):
    def run(block: pa.Table, anchors: pa.Table) -> pa.Table:
        if not block.num_rows or not anchors.num_rows:
            return _found([])
        labels = block["label"].to_numpy()
        lists = Lists(block["vec_id"].to_numpy(), matrix(block["v"]))
        others: dict[int, np.ndarray] = {}
        out = []
        for key, i, label, found, a in zip(*(anchors[f"a_{c}"].to_pylist() for c in ("key", "vec_id", "label", "found")), matrix(anchors["a_v"]), strict=True):
            if label not in others:
                others[label] = labels != label
            windows = [window_of(p["score"], low, high) for p in found]
            for p, best in zip(found, lists.search(a, i, windows, k, others[label]), strict=True):
                out += [(key, p["slot"], y, _clipped(x)) for x, y in best]
        return _found(out)
    return run


def _in_blocks(candidates: DataFrame, anchors: DataFrame, n_blocks: int, n_chunks: int, run) -> DataFrame:
    """Every block of candidates with every chunk of anchors, one such pair a group."""
    chunks = F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    left = candidates.select("vec_id", "label", "v", "block", chunks)
    # columns of their own, as both sides come from one table
    right = anchors.select(*(F.col(c).alias(f"a_{c}") for c in anchors.columns), blocks).withColumnRenamed("block", "a_block")
    return left.groupBy("block", "chunk").cogroup(right.groupBy("a_block", "a_chunk")).applyInArrow(run, "anchor long, slot int, id long, score long")


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best rows of each group, ranked from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, folder: str, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``rows`` (vec_id, label, v with integer components).

    ``is_anchor`` is a condition on ``rows``; ``low`` and ``high`` bound a
    negative's score in hundredths of the positive's.
    """
    clean = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("v").cast("array<bigint>").alias("v"),
                         F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.monotonically_increasing_id().alias("key"))
             .where("vec_id is not null and label is not null and v is not null and not exists(v, x -> x is null)"))
    clean = common.written(clean, f"{folder}/rows")   # from here on a row keeps its key
    n, n_anchors = clean.agg(F.count("*"), F.count(F.when(F.col("anchor"), 1))).first()
    n_blocks, n_chunks = max(1, -(-n // block)), max(1, -(-n_anchors // chunk))
    dealt = lambda parts, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(parts)).cast("int")
    candidates = clean.withColumn("block", dealt(n_blocks, 1))
    anchors = clean.where("anchor").select("key", "vec_id", "label", "v", dealt(n_chunks, 2).alias("chunk"))
    best = _best(_in_blocks(candidates, anchors, n_blocks, n_chunks, _positives(positives)), positives, "anchor")
    best = common.written(best.select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), f"{folder}/positives")
    found = best.groupBy(F.col("anchor").alias("key")).agg(F.collect_list(F.struct("slot", F.col("positive_score").alias("score"))).alias("found"))  # at most ``positives`` each
    some = _best(_in_blocks(candidates, anchors.join(found, "key"), n_blocks, n_chunks, _negatives(negatives, low, high)), negatives, "anchor", "slot")
    return (some.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(best, ["anchor", "slot"]).join(clean.where("anchor").select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def integer_vector(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a double; null for a null vector or one with a null or non-finite component."""
    v = F.col(vector).cast("array<double>")
    whole = F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(whole, F.transform(v, lambda x: F.floor(x * scale).cast("bigint")))
