"""Toxicity scores by a counterfactually regularised linear classifier.

A document's features are its distinct words and word beginnings (3 to 6
bytes), ASCII case folded, as 64-bit hashes. The model is a logistic regression
over the features that tell the classes apart in the training rows. Every
training text is also taken as a counterfactual, and the loss adds
``penalty * (logit(x) - logit(x'))^2``: a text that names a group (``GROUPS``) has
its identity terms swapped for others of the same kind and language, one that
names none gets a neutral mention after its last word. The score must hang
neither on which group is named nor on whether one is, so a neutral mention does
not make a text toxic. The penalty reaches the words and word beginnings that
group names share with other words.

Training rows: labelled documents chosen by the caller, at most ``max_rows``,
those with the smallest id hashes (a bounded sample of labels, fitted on the
driver over at most ``max_features`` features). Scoring covers every whole text.

Defined results: null and empty texts get the score of a text without features.
Without both classes among the training rows every score is 0. Repeated rows are
scored alike; a document with several labels counts as toxic if one says so;
null labels are no labels. Further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common, kernel

MAX_ROWS = 8_000
MAX_FEATURES = 1 << 14
LEAST_ROWS = 4          # a feature occurs in at least so many training rows
PENALTY = 1.0
RIDGE = 2e-3
STEPS = 400
BEGINNINGS = (3, 4, 5, 6)
U64 = np.uint64

# Neutral names of groups in four languages, by kind; a term is swapped for the next one of its list.
GROUPS = {
    "gender": ["women", "men"],
    "gender, one": ["woman", "man"],
    "religion": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    "religion, adjective": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    "origin": ["americans", "mexicans", "germans", "chinese", "indians", "africans", "arabs", "russians"],
    "origin, adjective": ["american", "mexican", "german", "african", "indian", "arab", "russian", "asian"],
    "colour": ["white", "black", "brown"],
    "orientation": ["straight", "gay", "lesbian", "bisexual"],
    "status": ["immigrants", "refugees", "citizens", "locals"],
    "age": ["young", "old"],
    "gender, de": ["frauen", "männer"],
    "religion, de": ["christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"],
    "origin, de": ["amerikaner", "mexikaner", "türken", "chinesen", "inder", "afrikaner", "araber", "russen"],
    "status, de": ["einwanderer", "flüchtlinge", "bürger", "einheimische"],
    "orientation, de": ["heterosexuelle", "schwule", "lesben", "bisexuelle"],
    "age, de": ["jugendliche", "senioren"],
    "gender, fr": ["femmes", "hommes"],
    "religion, fr": ["chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"],
    "origin, fr": ["américains", "mexicains", "allemands", "chinois", "indiens", "africains", "arabes", "russes"],
    "status, fr": ["immigrés", "réfugiés", "citoyens", "habitants"],
    "orientation, fr": ["hétérosexuels", "homosexuels", "lesbiennes", "bisexuels"],
    "age, fr": ["jeunes", "retraités"],
    "gender, es": ["mujeres", "hombres"],
    "religion, es": ["cristianos", "musulmanes", "judíos", "hinduistas", "budistas", "ateos"],
    "origin, es": ["estadounidenses", "mexicanos", "alemanes", "chinos", "indios", "africanos", "árabes", "rusos"],
    "status, es": ["inmigrantes", "refugiados", "ciudadanos", "vecinos"],
    "orientation, es": ["heterosexuales", "homosexuales", "lesbianas", "bisexuales"],
    "age, es": ["jóvenes", "ancianos"],
}


SWAP = {t: terms[(k + 1) % len(terms)] for terms in GROUPS.values() for k, t in enumerate(terms)}
TERM = re.compile(r"(?i)(?<!\w)(?:" + "|".join(sorted(SWAP, key=len, reverse=True)) + r")(?!\w)")
MENTIONS = sorted(SWAP)


def counterfactual(text: str | None) -> str:
    """The text with every identity term swapped for the next of its kind, or with a neutral mention if it names no group.

    Which group is mentioned follows from the text alone.
    """
    swapped, n = TERM.subn(lambda m: SWAP[m.group().lower()], text or "")
    return swapped if n else f"{swapped} {MENTIONS[zlib.crc32(swapped.encode('utf-8', 'replace')) % len(MENTIONS)]}"


def _term_features() -> np.ndarray:
    """Features of the identity terms themselves."""
    return np.unique(np.concatenate([h for _, _, h, _ in features(list(SWAP))]))


def _beginnings(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, row) of every word and word beginning."""
    separators = kernel.not_letters()
    h, row, start = kernel.words(data, offsets, separators)
    raw = np.frombuffer(data, np.uint8)
    hashes, rows = [h], [row]
    if len(h):
        stop = np.append(np.flatnonzero(separators[raw]), len(raw))
        end = np.minimum(stop[np.searchsorted(stop, start)], offsets[row + 1])
        code = np.zeros(len(start), np.uint64)
        for k in range(max(BEGINNINGS)):
            has = end - start > k
            code = np.where(has, kernel.mix(code * U64(0x100000001B3) + kernel.VALUES[raw[np.minimum(start + k, len(raw) - 1)]]), code)
            if k + 1 in BEGINNINGS:
                hashes.append(code[has] ^ U64(k + 1))
                rows.append(row[has])
    return np.concatenate(hashes), np.concatenate(rows)


def features(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, feature hashes, their rows): words and beginnings of each chunk, with repeats."""
    for first, last, data, offsets in kernel.chunks(texts):
        h, row = _beginnings(data, offsets)
        yield first, last, h, row


# --- training -----------------------------------------------------------------
@dataclass
class Model:
    hashes: np.ndarray   # sorted
    weights: np.ndarray
    bias: float

    def filter(self) -> np.ndarray:
        """A bit table over the low bits of the hashes, to pass most other words by."""
        words = np.zeros(1 << 14, np.uint64)
        np.bitwise_or.at(words, ((self.hashes & U64((1 << 20) - 1)) >> U64(6)).astype(np.int64), U64(1) << (self.hashes & U64(63)))
        return words

    def logits(self, h: np.ndarray, row: np.ndarray, rows: int, present: np.ndarray) -> np.ndarray:
        """Logits of ``rows`` texts from their features (each counts once)."""
        at, hit = _found(self.hashes, h, present)
        pairs = np.unique(row[hit] * len(self.hashes) + at) if len(self.hashes) else np.zeros(0, np.int64)
        out = np.full(rows, self.bias)
        if len(pairs):
            np.add.at(out, pairs // len(self.hashes), self.weights[pairs % len(self.hashes)])
        return out


def _found(sorted_hashes: np.ndarray, h: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    maybe = np.flatnonzero(common.in_bitmap(present, h))
    if not len(maybe) or not len(sorted_hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(sorted_hashes, h[maybe]), len(sorted_hashes) - 1)
    ok = sorted_hashes[at] == h[maybe]
    return at[ok], maybe[ok]


class _Rows:
    """Sparse 0/1 rows: products with a weight vector and with a row vector."""

    def __init__(self, row: np.ndarray, col: np.ndarray, n: int, width: int):
        self.row, self.col, self.n, self.width = row, col, n, width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def t_dot(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=v[self.row], minlength=self.width)


def fit(x: list[np.ndarray], swapped: list[np.ndarray], y: np.ndarray, penalty: float = PENALTY, max_features: int = MAX_FEATURES) -> Model:
    """Fit on rows of distinct feature hashes, their counterfactuals and labels 0/1.

    The features kept are those with the largest chi-square statistic; both
    classes weigh the same. Adam on the whole set, with a fixed number of steps.
    """
    n, positive = len(y), int(y.sum())
    if positive == 0 or positive == n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -50.0)
    row = np.repeat(np.arange(n), [len(r) for r in x])
    values, col, count = np.unique(np.concatenate(x), return_inverse=True, return_counts=True)
    with_y = np.bincount(col, weights=y[row], minlength=len(values))
    expected = count * positive / n
    chi = (with_y - expected) ** 2 / (expected * (1 - positive / n) * (1 - count / (n + 1)) + 1e-9)
    chosen = np.flatnonzero((count >= LEAST_ROWS) & (chi > 10.83))  # 0.1 % level
    chosen = np.sort(chosen[np.lexsort((values[chosen], -chi[chosen]))[:max_features]])
    # words swapped in must have weights of their own, else the penalty cannot reach them
    hashes = np.union1d(values[chosen], _term_features())

    def sparse(rows: list[np.ndarray]) -> _Rows:
        r = np.repeat(np.arange(n), [len(v) for v in rows])
        h = np.concatenate(rows)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        ok = hashes[at] == h
        return _Rows(r[ok], at[ok], n, len(hashes))

    a, b = sparse(x), sparse(swapped)
    weight = np.where(y > 0, 0.5 / positive, 0.5 / (n - positive))
    w, bias = np.zeros(len(hashes)), 0.0
    m, v = np.zeros(len(hashes) + 1), np.zeros(len(hashes) + 1)
    for step in range(1, STEPS + 1):
        z, moved = a.dot(w), b.dot(w)
        error = weight * (1 / (1 + np.exp(-np.clip(z + bias, -50, 50))) - y)
        gap = 2 * penalty * (z - moved) / n
        g = np.append(a.t_dot(error + gap) - b.t_dot(gap) + RIDGE * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        change = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w -= change[:-1]
        bias -= change[-1]
    return Model(hashes, w, float(bias))


TRAINING = pa.schema([("toxic", pa.int32()), ("x", pa.list_(pa.int64())), ("swapped", pa.list_(pa.int64()))])


def _distinct(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct features of every text."""
    out = []
    for first, last, h, row in features(texts):
        by = np.argsort(row, kind="stable")
        bounds = np.searchsorted(row[by], np.arange(last - first + 1))
        out += [np.unique(h[by[bounds[i]: bounds[i + 1]]]).view(np.int64) for i in range(last - first)]
    return out


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, features and features of the counterfactual."""
    kind = pa.list_(pa.int64())
    for b in common.slices(batches, 256):
        texts = b.column(1).to_pylist()
        yield common.batch(TRAINING, b.column(0), pa.array(_distinct(texts), kind), pa.array(_distinct([counterfactual(t) for t in texts]), kind))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, penalty: float = PENALTY) -> Model:
    """Fit on the documents that ``labels`` (doc_id, toxic) marks; ``docs``: (doc_id, text).

    At most ``max_rows`` labels are taken, by the hash of the id, so the ids
    that are joined and the fitted matrix have a bound. Features of rare
    occurrence are dropped by Spark before anything reaches the driver.
    """
    chosen = (labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("toxic", "text")
            .mapInArrow(_training, "toxic int, x array<long>, swapped array<long>"))
    folder = common.run_folder(docs.sparkSession, "toxicity")
    rows = common.written(rows, folder)
    # the matrix without features of fewer than LEAST_ROWS rows or without bearing on the label
    totals = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    n, p = totals["n"] or 0, totals["p"] or 0
    if not 0 < p < n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -50.0)
    expected = F.col("k") * F.lit(p / n)
    useful = (rows.select("toxic", F.explode("x").alias("h")).groupBy("h").agg(F.count("*").alias("k"), F.sum("toxic").alias("t"))
              .where(F.col("k") >= LEAST_ROWS)
              .withColumn("chi", (F.col("t") - expected) ** 2 / (expected * (1 - p / n) * (1 - F.col("k") / F.lit(n + 1)) + 1e-9))
              .where("chi > 10.83").orderBy(F.desc("chi"), "h").limit(MAX_FEATURES).select("h").toArrow()["h"].to_numpy())
    keep = np.union1d(useful.view(np.uint64), _term_features())
    shared = docs.sparkSession.sparkContext.broadcast(keep)
    small = rows.select("toxic", "x", "swapped").mapInArrow(_kept(shared), "toxic int, x array<long>, swapped array<long>").toArrow()
    x, swapped = (_rows_of(small[c].combine_chunks()) for c in ("x", "swapped"))
    return fit(x, swapped, small["toxic"].to_numpy().astype(float), penalty)


def _rows_of(lists: pa.ListArray) -> list[np.ndarray]:
    return np.split(lists.flatten().to_numpy().view(np.uint64), np.cumsum(np.diff(lists.offsets.to_numpy()))[:-1])


def _cut(lists: pa.ListArray, keep: np.ndarray) -> pa.ListArray:
    """The lists without values that are not in ``keep``."""
    values, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    ok = np.isin(values.view(np.uint64), keep)
    left = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[ok], minlength=len(sizes))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32)), pa.array(values[ok]))


def _kept(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 256):
            yield common.batch(TRAINING, b.column(0), _cut(b.column(1), shared.value), _cut(b.column(2), shared.value))
    return run


# --- scoring ------------------------------------------------------------------
SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        present = model.filter()
        for b in common.slices(batches):
            out = np.zeros(b.num_rows)
            for first, last, h, row in features(b.column(1).to_pylist()):
                z = model.logits(h, row, last - first, present)
                out[first:last] = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield common.batch(SCORES, b.column(0), np.round(out, 9))
    return run


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_scores(shared), "doc_id long, score double"))
