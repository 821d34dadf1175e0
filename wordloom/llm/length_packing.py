"""Hierarchical packing of documents into sequences of several lengths.

Whole texts become token ids; what fills whole windows of the longest tier is
cut off and is a sequence by itself, the rest of a document is routed to the
shortest tier that holds it. Documents are dealt into buckets of bounded size.
In a bucket the tiers are packed from the longest down: a window opens with the
longest document left in its tier, its gap takes the longest documents of
shorter tiers that still fit, and where none fits the gap is closed by the head
of the shortest one, whose other part stays in its pool. Every window is thus
filled to its tier's length; only what is left at the end of a bucket is cut
into sequences of falling powers of two. A sequence's length is always a power
of two, so no position is padded.

The sequences of a tier are then dealt into step groups of about ``STEP``
tokens, from the costliest down in serpentine order (cost: sum of squares of
the piece lengths, the attention work), so groups of a tier hold the same
number of tokens, up to one sequence, and nearly the same work.

Defined results: null and empty texts are the end id alone. Rows that share a
``doc_id``, null included, are documents of their own. Ties are broken by
document, start and digest, so a bucket packs alike whenever it is computed.
An empty table gives no pieces. Further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common, lookup

TIERS = (2048, 1024, 512, 256)
END_ID = 1
BUCKET = 4 << 20       # bytes of text whose documents are packed together
STEP = 1 << 17         # tokens of a step group
SEGMENT = 1 << 20      # characters of a text whose words are held at a time
GROUP = 1 << 22        # characters of short texts that are encoded together
CACHE = 1_000_000      # most tokens whose ids a worker keeps, over all its tasks


# --- encoding -------------------------------------------------------------------
# Fixed value: the pattern of the tokens that the tokenizer's model sees, after lower-casing.
TOKEN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the same on texts of ASCII and of Latin letters with one lower case form
_tokens = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\x0b\x0c\ra-zß-öø-ÿ0-9]+").findall
_other = re.compile(r"[^\t-\r -\x7eÀ-ÖØ-öø-ÿ]").search


# kinds of the bytes of a lower-cased text of the common alphabet
SPACE, LETTER, DIGIT, OTHER, APOSTROPHE = range(5)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[[*b" \t\n\x0b\x0c\r"]] = SPACE
_KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = LETTER
_KIND[ord("0"): ord("9") + 1] = DIGIT
_KIND[ord("'")] = APOSTROPHE


def _spaced(texts: list[str]) -> pa.StringArray:
    """Lower-cased texts of the common alphabet with a space between tokens that touch, but for those beside an apostrophe."""
    low = [t.lower().encode() for t in texts]
    raw = np.frombuffer(b"".join(low), np.uint8)
    kind = _KIND[raw]
    a, b = kind[:-1], kind[1:]
    digit = (a == DIGIT) | (b == DIGIT)
    cut = 1 + np.flatnonzero((a != SPACE) & (b != SPACE) & (digit | (a != b) & (a != APOSTROPHE) & (b != APOSTROPHE)))
    ends = np.cumsum([0, *map(len, low)])
    # a space where two texts meet goes to the later one
    offsets = (ends + np.searchsorted(cut, ends)).astype(np.int32)
    return pa.StringArray.from_buffers(len(low), pa.py_buffer(offsets), pa.py_buffer(np.insert(raw, cut, ord(" "))))


class Encoder:
    """Whole texts to ids by the ``tokenizers`` library, token by token.

    The tokenizer drops white space and case and gives its model one token of
    letters, one digit or one run of other characters at a time. Texts of the
    common alphabet are lower-cased and cut into these tokens here, and each
    distinct token is encoded once (``tokens``: the same model behind a plain
    split at spaces). Other texts are cut at spaces and line feeds only, which
    ids never reach across. Ids are kept, within a bound.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.t = Tokenizer.from_file(path)
        self.t.encode_special_tokens = True
        self.known, self.known_words = lookup.Table(self._learn, CACHE), lookup.Table(self._learn_words, CACHE)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        self.plain = bool(suffix) and TOKEN_PATTERN in json.dumps(spec["pre_tokenizer"]).replace("\\\\", "\\") and "Lowercase" in json.dumps(spec["normalizer"])
        self.tokens = Tokenizer.from_file(path)
        self.tokens.encode_special_tokens = True
        self.tokens.normalizer = normalizers.Sequence([])
        self.tokens.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.t.get_vocab()
        self.ends = np.zeros(1 + max(vocabulary.values(), default=0), bool)   # ids that end a token
        for token, i in vocabulary.items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)

    def _learn(self, new: list[str]) -> list[bytes]:
        """The ids of strings without white space, each one token unless it has an apostrophe."""
        cut = {w: _tokens(w) for w in new if "'" in w}
        tokens = list({*(w for w in new if w and w not in cut), *(t for found in cut.values() for t in found)})
        ids = {"": b""}
        for at in range(0, len(tokens), 512):
            ids.update(self._token_ids(tokens[at: at + 512]))
        return [b"".join(map(ids.__getitem__, cut[w])) if w in cut else ids[w] for w in new]

    def _token_ids(self, part: list[str]) -> Iterator[tuple[str, bytes]]:
        ids = np.array(self.tokens.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
        stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(stops) != len(part):
            return zip(part, self._learn_words(part), strict=True)
        whole = ids.tobytes()
        return ((w, whole[a:b]) for w, a, b in zip(part, [0, *stops], stops))

    def _learn_words(self, new: list[str]) -> list[bytes]:
        """The ids of strings by the whole tokenizer."""
        return [np.array(e.ids, "<u4").tobytes() for at in range(0, len(new), 4096) for e in self.t.encode_batch_fast(new[at: at + 4096], add_special_tokens=False)]

    def _segments(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > SEGMENT:
                places = [p for c in (" ", "\n") if (p := text.find(c, at + SEGMENT)) >= 0]
                end = min(places, default=end)
            yield text[at:end]
            at = end

    def _encoded(self, segments: list[str]) -> list[bytes]:
        plain = [self.plain and not _other(s) for s in segments]
        common_ones = [s for s, p in zip(segments, plain, strict=True) if p]
        others = [s.replace("\n", " ").split(" ") for s, p in zip(segments, plain, strict=True) if not p]
        ids = {True: iter(self.known.joined(pc.ascii_split_whitespace(_spaced(common_ones))) if common_ones else ()),
               False: iter(self.known_words.joined(pa.array(others, pa.list_(pa.string()))) if others else ())}
        return [next(ids[p]) for p in plain]

    def _groups(self, texts: list[str | None]) -> Iterator[list[str]]:
        """The short texts, about GROUP characters at a time."""
        held, n = [], 0
        for t in texts:
            if t and len(t) <= SEGMENT:
                held.append(t)
                n += len(t)
                if n >= GROUP:
                    yield held
                    held, n = [], 0
        if held:
            yield held

    def encoded(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text and the end id; the new tokens of a group of short texts are learned together."""
        end = END_ID.to_bytes(4, "little")
        short = (ids for group in self._groups(texts) for ids in self._encoded(group))
        for t in texts:
            yield end if not t else next(short) + end if len(t) <= SEGMENT else b"".join([*(self._encoded([s])[0] for s in self._segments(t)), end])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return list(self.encoded(texts))


@lru_cache(maxsize=1)
def load(path: str) -> Encoder:
    """The encoder of a worker, with its cache."""
    return Encoder(path)


PARTS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
OUT = 4 << 20   # bytes of ids in a record batch, about


def _encoded(tokenizer: str, longest: int):
    """Documents cut into whole windows and a rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, n = None, [], 0
        for b in common.slices(batches, 2048):
            encoder = encoder or load(tokenizer)
            for row, doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), encoder.encoded(b.column(2).to_pylist()), strict=True):
                for at in range(0, len(ids), 4 * longest):
                    held.append((row, doc_id, at // 4, len(ids) // 4, ids[at: at + 4 * longest]))
                    n += len(held[-1][-1])
                    if n >= OUT:
                        yield common.batch(PARTS, *zip(*held, strict=True))
                        held, n = [], 0
        if held:
            yield common.batch(PARTS, *zip(*held, strict=True))
    return run


# --- packing a bucket ---------------------------------------------------------------
Piece = tuple[int, int, int]     # item, first token, length


def powers(n: int) -> list[int]:
    """n as falling powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _cut(pieces: list[Piece], sizes: list[int]) -> list[list[Piece]]:
    """``pieces`` laid end to end and cut into runs of ``sizes``."""
    out, left = [], pieces[::-1]
    for size in sizes:
        run = []
        while size:
            item, first, n = left.pop()
            take = min(n, size)
            run.append((item, first, take))
            size -= take
            if n > take:
                left.append((item, first + take, n - take))
        out.append(run)
    return out


def packed(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Sequences of pieces that hold every token of items of ``lengths`` (each at most the longest tier) once."""
    out: list[list[Piece]] = [[(i, 0, n)] for i, n in enumerate(lengths) if n == tiers[0]]
    bounds = [*tiers[1:], 0]
    pools: list[list[tuple[int, int, int]]] = [[] for _ in tiers]      # (length, item, first token) by length
    for i, n in enumerate(lengths):
        if 0 < n < tiers[0]:
            pools[next(t for t, low in enumerate(bounds) if n > low)].append((n, i, 0))
    for pool in pools:
        pool.sort()

    def tail(n: int, item: int, first: int) -> None:
        insort(pools[next(t for t, low in enumerate(bounds) if n > low)], (n, item, first))

    for t, size in enumerate(tiers):
        while pools[t]:
            n, item, first = pools[t].pop()
            window, gap = [(item, first, n)], size - n
            while gap:
                # the longest document that fits, from the next shorter tier that has one
                best = next(((pool, k) for pool in pools[t + 1:] or pools[t:] if (k := bisect_right(pool, (gap, 1 << 62, 0))) > 0), None)
                if best is not None:
                    pool, k = best
                    n, item, first = pool.pop(k - 1)
                    window.append((item, first, n))
                    gap -= n
                    continue
                # none fits: the head of the shortest one left, of this tier where the shorter ones are empty
                pool = next((p for p in [*pools[:t:-1], pools[t]] if p), None)
                if pool is None:
                    break
                n, item, first = pool.pop(0)
                window.append((item, first, min(n, gap)))
                if n > gap:
                    tail(n - gap, item, first + gap)
                gap -= min(n, gap)
            out += _cut(window, powers(size - gap))   # of a full window just itself
    return out


def step_groups(sequences: list[list[Piece]], step: int = STEP) -> list[tuple[int, int]]:
    """(length, group) of every sequence: of a length's sequences the costliest first, dealt in serpentine order."""
    by_size: dict[int, list[int]] = {}
    for i, s in enumerate(sequences):
        by_size.setdefault(sum(n for *_, n in s), []).append(i)
    out = [(0, 0)] * len(sequences)
    for size, which in by_size.items():
        groups = -(-len(which) * size // step)
        which.sort(key=lambda i: (-sum(n * n for *_, n in sequences[i]), i))
        for at, i in enumerate(which):
            turn, k = divmod(at, groups)
            out[i] = size, k if turn % 2 == 0 else groups - 1 - k
    return out


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.string())])


def _packed(tiers: tuple[int, ...], step: int):
    def run(bucket: pa.Table) -> pa.Table:
        number = bucket["bucket"][0].as_py()
        ids = bucket["ids"].to_pylist()
        doc_ids, starts, totals = (bucket[c].to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        order = sorted(range(len(ids)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0, starts[i], totals[i], zlib.crc32(ids[i]), ids[i]))
        sequences = packed([len(ids[i]) // 4 for i in order], tiers)
        rows = []
        for k, (pieces, (size, group)) in enumerate(zip(sequences, step_groups(sequences, step), strict=True)):
            offset = 0
            for item, first, n in pieces:
                i = order[item]
                rows.append((doc_ids[i], starts[i] + first, n, ids[i][4 * first: 4 * (first + n)], totals[i], number << 32 | k, offset, size, f"{number}-{size}-{group}"))
                offset += n
        return pa.Table.from_batches([common.batch(PIECES, *zip(*rows, strict=True))])
    return run


def pieces(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, step: int = STEP, bucket: int = BUCKET) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) in their sequences.

    (doc_id, start, length, ids, doc_tokens, sequence_id, offset, tier,
    step_group); ``ids`` are little-endian 32-bit token ids.
    """
    if list(tiers) != sorted({1 << (t.bit_length() - 1) for t in tiers}, reverse=True):
        raise ValueError("tiers are falling powers of two")
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 4)).first()[0] or 0
    n = int(1 + size // bucket)
    parts = docs.mapInArrow(_encoded(tokenizer, tiers[0]), "row long, doc_id long, start long, doc_tokens long, ids binary")
    # a long document's windows go to buckets of their own, as do repeated rows
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("row", "start"), F.lit(n)).cast("int")).drop("row")
    return dealt.groupBy("bucket").applyInArrow(
        _packed(tuple(tiers), step),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group string")
