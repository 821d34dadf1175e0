"""N-gram Jaccard join: size-aware heavy-light join over word-shingle sets.

Two documents link when the Jaccard similarity of their sets of distinct
5-word shingles is at least 0.8 (``100 * intersection >= 80 * union``).

Small sets enumerate fixed-size subsets: a pair of sizes ``a <= b`` that links
shares at least ``c = ceil(0.8 b)`` shingles, so both sides emit all subsets of
``c`` shingles and meet on one of them. Large sets scan inverted lists: in one
global order of the shingles (light ones first) two linked sets share one of
the first ``floor(n / 5) + 1``, so only these are posted. The boundary between
the two ways is the size with the least estimated cost.

Equal sets are one class from the start. A list with many classes is not
expanded into pairs: its members are first compared with a few hubs each round,
the member with the fewest lighter shingles before the list's own (of a group
of near copies the least changed one, which most of the others link with) and
the first members of two random components. A hub leaves its list once it met
all of it, a list with one component left is closed, and after the first round
others follow while they find links and the open lists hold more than PAIRWISE
pairs per document; then, or after HUB_ROUNDS, the rest are compared with each
other. No link
between components is lost that way, and a dense group of near copies costs
about one comparison per member. Candidates go through a
64-bucket histogram whose bucket-wise minimum bounds the intersection from
above, then through an exact intersection of the two sets.

Defined results: null, empty and blank texts have an empty set, link with
nothing and are their own component. Rows with the same text, or the same
``doc_id``, are kept as they are, one output row per input row; a null
``doc_id`` never becomes a component's smallest id unless all are null. Further
columns of the input are ignored. Classes carry 64-bit set hashes: with N
distinct sets the chance of one wrong merge is about N^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm import common, kernel

BUCKETS = 64            # histogram buckets of the upper bound
HEAVY_ROWS = 1 << 20    # most shingles in the broadcast table of frequent ones
WINDOW = 1 << 21        # shingles counted together inside a task
SUBSET_SIZES = 14       # no set above this size enumerates subsets
HUB_ROUNDS = 8          # most rounds of hubs
PAIRWISE = 1024         # pairs of places in open lists per document that are joined without a further round; few of them pass the position test
HUBS = 3                # members of a list that its other members are compared with in a round
SET_BITS = 24           # bits of the filter of classes whose sets are needed
U64 = np.uint64


def required(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least intersection of linked sets of sizes a and b: ceil(4 (a + b) / 9)."""
    return (4 * (a + b) + 8) // 9


def class_id(s: np.ndarray) -> int:
    """64-bit id of a set of shingle hashes."""
    return int(kernel.mix(np.array([kernel.mix(s).sum(dtype=np.uint64) + U64(len(s))], np.uint64)).view(np.int64)[0])


def subset_sizes(a: int) -> list[int]:
    """Sizes of the subsets that a set of size ``a`` emits: ceil(0.8 b) of every partner size b >= a, and its own."""
    return sorted({(4 * b + 4) // 5 for b in range(a, (5 * a) // 4 + 1)})


def subset_keys(s: np.ndarray) -> np.ndarray:
    m = kernel.mix(s + U64(0x5DEECE66D))
    out = [kernel.mix(m[np.array(list(combinations(range(len(s)), c)), np.int64)].sum(axis=1, dtype=np.uint64) + U64(c << 32 | 1)) for c in subset_sizes(len(s))]
    return np.concatenate(out)


# --- pass 1: classes, histograms, frequent shingles ---------------------------
CLASSES = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cid", pa.int64()), ("hist", pa.binary()), ("h", pa.int64()), ("k", pa.int64())])


def _histogram(s: np.ndarray) -> bytes:
    return np.minimum(np.bincount((s >> U64(58)).astype(np.int64), minlength=BUCKETS), 65535).astype(np.uint16).tobytes()


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and rows (h, k) for shingles met k > 1 times within a window of the task."""
    window, held = [], 0

    def frequent() -> pa.RecordBatch:
        x = np.sort(np.concatenate(window))
        at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        k = np.diff(np.append(at, len(x)))
        h, k = x[at[k > 1]].view(np.int64), k[k > 1]
        none = pa.nulls(len(h), pa.int64())
        return common.batch(CLASSES, none, none, none, pa.nulls(len(h), pa.binary()), h, k)

    for b in common.slices(batches):
        ids = b.column(0)
        sets = list(kernel.shingle_sets(b.column(1).to_pylist()))
        none = pa.nulls(len(sets), pa.int64())
        yield common.batch(CLASSES, ids, [len(s) for s in sets], [class_id(s) for s in sets], [_histogram(s) for s in sets], none, none)
        window += sets
        held += sum(map(len, sets))
        if held >= WINDOW:
            yield frequent()
            window, held = [], 0
    if held:
        yield frequent()


# --- pass 2: postings ---------------------------------------------------------
POSTINGS = pa.schema([("key", pa.int64()), ("cid", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("salt", pa.int32())])
SALTS = 1024            # parts of a frequent shingle's list while lists are pruned


def _order(s: np.ndarray, heavy: np.ndarray, counts: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, int]:
    """The set in global order, light shingles by hash, then frequent ones by count and hash; how many are light."""
    maybe = np.flatnonzero(common.in_bitmap(present, s))
    if not len(maybe) or not len(heavy):
        return s, len(s)
    at = np.minimum(np.searchsorted(heavy, s[maybe]), len(heavy) - 1)
    hit = heavy[at] == s[maybe]
    where, at = maybe[hit], at[hit]
    light = np.ones(len(s), bool)
    light[where] = False
    by_count = np.lexsort((s[where], counts[at]))
    return np.concatenate([s[light], s[where][by_count]]), len(s) - len(where)


def _postings(shared, boundary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, counts, present = shared.value
        seen: set[int] = set()  # classes of this task's split
        for b in common.slices(batches):
            keys, cids, ns, places, salts = [], [], [], [], []
            for s in kernel.shingle_sets(b.column(0).to_pylist()):
                n = len(s)
                if not n or (cid := class_id(s)) in seen:
                    continue
                seen.add(cid)
                found = []
                if n < boundary:
                    found.append((subset_keys(s), 1 << 62))
                if 5 * n >= 4 * boundary:
                    ordered, light = _order(s, heavy, counts, present)
                    found.append((ordered[: n // 5 + 1], light))
                for f, light in found:
                    place = np.arange(len(f), dtype=np.int32)
                    keys.append(f)
                    cids.append(np.full(len(f), cid, np.int64))
                    ns.append(np.full(len(f), n, np.int32))
                    places.append(place if light <= n else place * 0)
                    salts.append(np.where(place < light, 0, 1 + cid % SALTS).astype(np.int32))
            if keys:
                yield common.batch(POSTINGS, np.concatenate(keys).view(np.int64), *map(np.concatenate, (cids, ns, places, salts)))
    return run


# --- pass 3: whole sets of the classes that are candidates --------------------
SETS = pa.schema([("cid", pa.int64()), ("s", pa.binary())])


def _sets(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed, seen = shared.value, set()
        for b in common.slices(batches):
            cids, sets = [], []
            for s in kernel.shingle_sets(b.column(0).to_pylist()):
                if len(s) and (cid := class_id(s)) not in seen and common.in_bitmap(needed, np.array([cid], np.int64).view(np.uint64))[0]:
                    seen.add(cid)
                    cids.append(cid)
                    sets.append(s.tobytes())
            yield common.batch(SETS, cids, sets)
    return run


# --- candidate checks ---------------------------------------------------------
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and histograms allow a link."""
    for b in batches:
        if not b.num_rows:
            continue
        a_n, b_n = (b.column(i).to_numpy().astype(np.int64) for i in (2, 3))
        x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS) for i in (4, 5))
        most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
        ok = (most >= required(a_n, b_n)) | (np.maximum(a_n, b_n) > 65535)
        yield common.batch(PAIRS, b.column(0), b.column(1)).filter(pa.array(ok))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that link, by exact intersection."""
    for b in common.slices(batches, 256):
        ok = []
        for x, y in zip(b.column(2), b.column(3), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            common_n = len(x) + len(y) - len(np.union1d(x, y))
            ok.append(100 * common_n >= 80 * (len(x) + len(y) - common_n))
        yield common.batch(PAIRS, b.column(0), b.column(1)).filter(pa.array(ok, pa.bool_()))


def choose_boundary(sizes: dict[int, int], shared: float) -> int:
    """Sets below the returned size enumerate subsets, the others scan lists.

    ``sizes``: number of sets per size up to SUBSET_SIZES and a bit above;
    ``shared``: mean number of other sets met per posting. A subset costs its
    row; a posting costs its row and the list it is scanned against.
    """
    def cost(x: int) -> float:
        subsets = sum(k * sum(comb(n, c) for c in subset_sizes(n)) for n, k in sizes.items() if n < x)
        lists = sum(k * (n // 5 + 1) * (1 + shared) for n, k in sizes.items() if 5 * n >= 4 * x)
        return subsets + lists

    return min(range(1, SUBSET_SIZES + 2), key=lambda x: (cost(x), -x))


class _Join:
    def __init__(self, docs: DataFrame, text: str, folder: str):
        self.text, self.folder, self.spark = docs.select(F.col(text).alias("text")), folder, docs.sparkSession
        self.sets: DataFrame | None = None

    def checked(self, pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
        """The (a, b) of ``pairs`` that link."""
        side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"{x}_n"), F.col("hist").alias(f"{x}_hist"))
        sized = pairs.join(side("a"), "a").join(side("b"), "b")
        kept = common.written(sized.select("a", "b", "a_n", "b_n", "a_hist", "b_hist").mapInArrow(_bounded, "a long, b long"), f"{self.folder}/{name}-bounded")
        cids = kept.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        if self.sets is not None:
            cids = cids.join(self.sets.select("cid"), "cid", "left_anti")
        words = common.bitmap(cids, "cid", SET_BITS)
        if words.any():
            shared = self.spark.sparkContext.broadcast(words)
            more = self.text.mapInArrow(_sets(shared), "cid long, s binary").join(cids, "cid", "left_semi").groupBy("cid").agg(F.first("s").alias("s"))
            more = common.written(more, f"{self.folder}/{name}-sets")
            self.sets = more if self.sets is None else self.sets.unionAll(more)
        if self.sets is None:
            return kept
        whole = (kept.join(self.sets.select(F.col("cid").alias("a"), F.col("s").alias("x")), "a")
                 .join(self.sets.select(F.col("cid").alias("b"), F.col("s").alias("y")), "b").select("a", "b", "x", "y"))
        return common.written(whole.mapInArrow(_linked, "a long, b long"), f"{self.folder}/{name}-links")


def component_table(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_shingles, component_id, class_id).

    ``folder`` is a new folder on storage that driver and executors share.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    first = common.written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
                           .mapInArrow(_classes, "doc_id long, n long, cid long, hist binary, h long, k long"), f"{folder}/classes")
    members = first.where("cid is not null").select("doc_id", "n", "cid", "hist")
    # frequent shingles, at most HEAVY_ROWS of them: by the histogram of their counts
    frequent = first.where("h is not null").groupBy("h").agg(F.sum("k").alias("k"))
    frequent = common.written(frequent, f"{folder}/frequent")
    by_power = {r["p"]: r["c"] for r in frequent.groupBy(F.floor(F.log2("k")).alias("p")).agg(F.count("*").alias("c")).collect()}
    least, total = 64, 0
    for p in sorted(by_power, reverse=True):
        if (total := total + by_power[p]) > HEAVY_ROWS:
            break
        least = p
    heavy = frequent.where(F.floor(F.log2("k")) >= least).toArrow()
    h, k = heavy["h"].to_numpy().view(np.uint64), heavy["k"].to_numpy()
    by_hash = np.argsort(h)
    h, k = h[by_hash], k[by_hash]
    present = np.zeros(1 << 16, np.uint64)
    np.bitwise_or.at(present, ((h & U64((1 << 22) - 1)) >> U64(6)).astype(np.int64), U64(1) << (h & U64(63)))
    shared = sc.broadcast((h, k, present))
    sizes = {r["n"]: r["c"] for r in members.where(f"n between 1 and {2 * SUBSET_SIZES}").groupBy("n").agg(F.count("*").alias("c")).collect()}
    repeated = frequent.agg(F.sum("k")).first()[0] or 0
    shingles = members.agg(F.sum("n")).first()[0] or 1
    boundary = choose_boundary(sizes, repeated / shingles)

    join = _Join(docs, text, folder)
    classes = members.where("n > 0").groupBy("cid").agg(F.first("n").alias("n"), F.first("hist").alias("hist"))
    postings = join.text.mapInArrow(_postings(shared, boundary), "key long, cid long, n int, pos int, salt int")
    # lists with at least two classes; those of frequent shingles are kept unseen, in salted parts
    part = Window.partitionBy("key", "salt")
    lists = common.written(postings.withColumns({"lo": F.min("cid").over(part), "hi": F.max("cid").over(part)})
                           .where("lo != hi or salt > 0").select("key", "cid", "n", "pos"), f"{folder}/lists")

    label = None   # (v, c) of the classes linked so far
    links: DataFrame | None = None
    tested: DataFrame | None = None
    spent: DataFrame | None = None   # (key, cid) of the hubs that met their lists in the round before
    n_docs, settled = members.count(), True
    for step in range(HUB_ROUNDS + 1):
        own = lists if spent is None else lists.join(spent, ["key", "cid"], "left_anti")
        if label is None:
            own = own.withColumn("c", F.col("cid"))
        else:
            own = own.join(label.withColumnRenamed("v", "cid"), "cid", "left").withColumn("c", F.coalesce("c", "cid"))
        # of two linked sets the shorter has a shared shingle among its first n / 9, so a list needs such a member
        member = [F.col("cid").alias("o"), F.col("n").alias("on"), F.col("c").alias("oc"), F.col("pos").alias("opos")]
        place, able = F.col("pos").cast("long"), F.col("pos") <= F.col("n") / 9
        ranks = [(place, F.xxhash64("cid", F.lit(step))), *((F.xxhash64("c", F.lit(step * HUBS + k)), place) for k in range(1, HUBS))]
        hubs = [F.min(F.when(able, F.struct(r.alias("r"), then.alias("then"), *member))) for r, then in ranks]
        keys = (own.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.array(*hubs).alias("hubs"), F.count("*").alias("m"), F.count_if(able).alias("e"))
                .where("lo != hi and hubs[0] is not null"))
        keys = common.written(keys.select("key", F.array_distinct(F.transform("hubs", lambda x: x.dropFields("r", "then"))).alias("hubs"), "m", "e"), f"{folder}/keys-{step}")
        still_pairs = keys.agg(F.sum(F.col("m").cast("double") * F.col("e"))).first()[0]
        if still_pairs is None:
            break
        if step:   # only open lists go on
            own = common.written(own.join(keys.select("key"), "key", "left_semi"), f"{folder}/open-{step}")
            lists = own.drop("c")
        last = step == HUB_ROUNDS or (step > 0 and (not settled or still_pairs <= PAIRWISE * n_docs))
        if not last:
            each = keys.select("key", F.explode("hubs").alias("hub")).select("key", "hub.*")
            pairs = own.join(each, "key").where("c != oc")
            spent = each.select("key", F.col("o").alias("cid"))
        else:
            still = own.join(keys.select("key"), "key", "left_semi").distinct()
            other = still.select("key", F.col("cid").alias("o"), F.col("n").alias("on"), F.col("c").alias("oc"), F.col("pos").alias("opos"))
            pairs = still.join(other, "key").where("cid < o and c != oc")
        # both must meet the required intersection from this shingle on
        needed = "floor((4 * (n + on) + 8) / 9)"
        pairs = pairs.where(f"pos + {needed} <= n and opos + {needed} <= on").select(F.least("cid", "o").alias("a"), F.greatest("cid", "o").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = common.written(pairs, f"{folder}/pairs-{step}")
        settled = False
        if pairs.take(1):
            tested = pairs if tested is None else tested.unionAll(pairs)
            found = join.checked(pairs, classes, f"step-{step}")
            if settled := bool(found.take(1)):
                links = found if links is None else links.unionAll(found)
                label = common.written(common.components(links, f"{folder}/components-{step}"), f"{folder}/label-{step}")
        if last:
            break

    out = members.select("doc_id", "n", F.when(F.col("n") > 0, F.col("cid")).alias("class_id"))
    if label is not None:
        out = out.join(label.select(F.col("v").alias("class_id"), "c"), "class_id", "left")
    else:
        out = out.withColumn("c", F.lit(None).cast("long"))
    out = out.withColumn("c", F.coalesce("c", "class_id"))
    lowest = out.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("low"))
    return (out.join(lowest, "c", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id"), "class_id"))
