"""SentencePiece encoding and decoding with a weighted finite-state transducer.

A model file is compiled into three parts: the normaliser (the model's character
map, extra spaces, dummy prefix, spaces to U+2581), a piece lexicon whose arcs
read a piece and write its id, and byte fallback arcs that read a character
outside the lexicon and write its bytes' ids. Encoding composes them with the
input (``arcs``) and takes the shortest path in the tropical semiring
(``lattice.shortest_path``):

* unigram models: an arc weighs minus its piece's score;
* BPE models: a bigram acceptor over the pieces allows an arc (weight 0) after a
  piece only if merging leaves the two apart, and forbids it (infinite weight)
  otherwise. A merge result is the one path on which every neighbouring pair is
  allowed, so the shortest path equals the merge procedure's output. As every
  finite path weighs 0, a search from the word's end that stops at the first
  allowed arc finds the same path without visiting the others; words take this
  way (``_bpe_path``).

The transducer never joins a non-space character with a following space mark
unless a piece does, so inputs are composed word by word, words are cut between
characters that no piece holds side by side, and the paths of words are kept in
a cache of bounded size.

Defined results: null and empty texts have no ids. Repeated rows are encoded
alike; further columns are ignored. Decoding gives back the text exactly, apart
from characters the model maps elsewhere (U+2581 itself becomes a space).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise
from math import inf

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common, lookup
from wordloom.llm.lattice import Arc, Normaliser, shortest_path

MARK = "▁"
CACHE = 1_000_000       # most words whose paths a worker keeps, over all its tasks
PART_CACHE = 1 << 16    # most parts of words, likewise
PAIR_CACHE = 1 << 18
RECURSE = 200           # longer words are composed left to right
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            c = b[i]
            i += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while i < len(b):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7)
            n = varint() if n is None else n
            yield key >> 3, b[i: i + n]
            i += n


class Transducer:
    """A compiled model: ``encode`` and ``decode``."""

    def __init__(self, model_file: str):
        with open(model_file, "rb") as f:
            self._compile(f.read())
        self.words = lookup.Table(self._learn, CACHE)
        self.parts: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _compile(self, raw: bytes) -> None:
        pieces, trainer, normaliser = [], {}, {}
        for number, value in _fields(raw):
            if number == 1:
                d = dict(_fields(value))
                pieces.append((d[1].decode(), float(np.frombuffer(d.get(2, b"\0\0\0\0"), "<f4")[0]), d.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if not normaliser.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models that write spaces as marks before words are supported")
        self.normaliser, self.squeeze = Normaliser(normaliser.get(2, b"")), bool(normaliser.get(4, 1))
        kind = trainer.get(3, 1)
        if kind not in (1, 2):
            raise ValueError("only unigram and BPE models are supported")
        self.bpe, self.prefix = kind == 2, bool(normaliser.get(3, 1))
        # lexicon: piece -> (id, weight); BPE ranks: the best score merges first, then the smaller id
        self.lexicon = {p: i for i, (p, _, t) in enumerate(pieces) if t in (NORMAL, USER)}
        self.weight = {p: -s for p, s, t in pieces if t in (NORMAL, USER)}
        by_score = sorted(self.lexicon, key=lambda p: (self.weight[p], self.lexicon[p]))
        self.rank = {p: k for k, p in enumerate(by_score)}
        self.longest = max(map(len, self.lexicon), default=1)
        # longest piece that ends in two given characters
        self.reach: dict[str, int] = {}
        for p in self.lexicon:
            self.reach[p[-2:]] = max(self.reach.get(p[-2:], 1), len(p))
        # neighbouring characters within pieces: between others a word can be cut
        self.joined = {p[k: k + 2] for p in self.lexicon for k in range(len(p) - 1)}
        self.byte = {int(p[3:-1], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == UNKNOWN), 0)
        self.whole = any(MARK in p.lstrip(MARK) for p in self.lexicon)
        self.unknown_weight = max(self.weight.values(), default=0.0) + 10.0
        self.surface = [b"" if t == CONTROL else bytes([int(p[3:-1], 16)]) if t == BYTE else " ⁇ ".encode() if t == UNKNOWN else p.replace(MARK, " ").encode() for p, _, t in pieces]
        self.is_byte = np.array([t == BYTE for _, _, t in pieces])

    # --- composition and shortest path ---------------------------------------
    def _fallback(self, c: str) -> list[int]:
        if not self.byte:
            return [self.unknown]
        return [self.byte[b] for b in c.encode("utf-8", "surrogatepass")]

    def _apart(self, left: str, right: str) -> bool:
        """The bigram acceptor: merging ``left + right`` gives these two pieces."""
        found = self.pairs.get((left, right))
        if found is None:
            found = self._merged(left + right) == [left, right]
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def _merged(self, s: str) -> list[str]:
        """The pieces that repeated best-first merging makes of a short string."""
        parts, rank = list(s), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if best is None:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def arcs(self, word: str) -> Callable[[int, str], Iterator[Arc]]:
        """The composition of a normalised word with the lexicon and the fallback; a BPE state is the piece just read."""
        lexicon = self.lexicon

        def out(i: int, before: str) -> Iterator[Arc]:
            for n in range(min(self.longest, len(word) - i), 0, -1):
                t = word[i: i + n]
                if t in lexicon:
                    if self.bpe:
                        yield n, t, 0.0 if not before or self._apart(before, t) else inf, t
                    else:
                        yield n, "", self.weight[t], t
            if word[i] not in lexicon:
                yield 1, "", 0.0 if self.bpe else self.unknown_weight, word[i]
        return out

    def path(self, word: str) -> list[str]:
        """Pieces and fallback characters of the least path."""
        found = shortest_path(len(word), "", self.arcs(word))
        if found is None:
            raise ValueError(f"no path for {word!r}")
        return found[1]

    def _bpe_path(self, word: str) -> list[str]:
        lexicon, pairs, reach = self.lexicon, self.pairs, self.reach
        last: dict[int, str] = {}

        def into(j: int) -> str:
            """The last piece of the only allowed path to ``j``; '' for a character by fallback."""
            t = last.get(j)
            if t is None:
                for i in range(max(0, j - reach.get(word[max(0, j - 2): j], 1)), j):
                    t = word[i:j]
                    if t in lexicon:
                        if i == 0 or not (before := into(i)):
                            break
                        apart = pairs.get((before, t))
                        if self._apart(before, t) if apart is None else apart:
                            break
                else:
                    if word[j - 1] in lexicon:
                        raise ValueError(f"no path for {word!r}")
                    t = ""
                last[j] = t
            return t

        if len(word) > RECURSE:
            for j in range(1, len(word) + 1):
                into(j)
        path, j = [], len(word)
        while j:
            t = into(j)
            path.append(t or word[j - 1])
            j -= len(t) or 1
        return path[::-1]

    def _learn(self, new: list[str]) -> list[bytes]:
        """Ids of words."""
        out = []
        for word in new:
            cuts = [0, *(k for k in range(1, len(word)) if word[k - 1: k + 1] not in self.joined), len(word)]
            out.append(b"" if not word else self._ids(word) if len(cuts) == 2 else b"".join([self._part(word[a:z]) for a, z in pairwise(cuts)]))
        return out

    def _part(self, part: str) -> bytes:
        """Ids of what lies between two cuts, from the cache if it is there."""
        ids = self.parts.get(part)
        if ids is None:
            ids = self._ids(part)
            if len(self.parts) >= PART_CACHE:
                self.parts.clear()
            if len(part) <= RECURSE:
                self.parts[part] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        out: list[int] = []
        for t in (self._bpe_path if self.bpe else self.path)(word):
            if t in self.lexicon:
                out.append(self.lexicon[t])
            else:
                out += self._fallback(t)
        return np.array(out, np.int32).tobytes()

    def _words(self, text: str) -> Iterator[str]:
        """The normalised text, cut where no piece can reach across."""
        s = (MARK if self.prefix else "") + text.replace(" ", MARK)
        if self.whole:
            yield s
            return
        lead = ""
        first, *rest = s.split(MARK)
        if first:
            yield first
        for w in rest:
            lead += MARK
            if w:
                yield lead + w
                lead = ""
        if lead:
            yield lead

    def normalised(self, text: str) -> str:
        if self.normaliser.units:
            text = self.normaliser(text)
        return " ".join(w for w in text.split(" ") if w) if self.squeeze else text

    def _spaced(self, text: str | None) -> str:
        """The words of a text's normalised form with spaces between them; no word has a space."""
        if not text or not (text := self.normalised(text)):
            return ""
        if self.prefix and self.squeeze and not self.whole and MARK not in text:
            return MARK + text.replace(" ", " " + MARK)
        return " ".join(self._words(text))

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        words = pc.split_pattern(pa.array(map(self._spaced, texts), pa.string()), " ")
        return [np.frombuffer(ids, np.int32) for ids in self.words.joined(words)]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        s = b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return s[1:] if self.prefix and s.startswith(" ") else s


@lru_cache(maxsize=1)
def load(model_file: str) -> Transducer:
    """The compiled model of a worker, with its cache."""
    return Transducer(model_file)


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("n_bytes", pa.int64()), ("round_trip", pa.bool_())])


def _encoded(model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = load(model_file)
        for b in common.slices(batches, 1024):
            texts = b.column(1).to_pylist()
            ids = t.encode_all(texts)
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            whole = np.concatenate([np.zeros(0, np.int32), *ids])
            as_bytes = np.concatenate([[0], np.cumsum(t.is_byte[whole])])
            back = [t.decode(i) == (x or "").replace(MARK, " ") for i, x in zip(ids, texts, strict=True)]
            yield common.batch(ENCODED, b.column(0), pa.ListArray.from_arrays(pa.array(sizes), pa.array(whole)), np.diff(sizes).astype(np.int64),
                               np.diff(as_bytes[sizes]).astype(np.int64), back)
    return run


def encoded(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, n_ids, n_bytes, round_trip) of every row of ``docs`` (doc_id, text).

    ``n_bytes``: ids that fall back to bytes; ``round_trip``: decoding the ids gives the text.
    """
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_encoded(model_file), "doc_id long, ids array<int>, n_ids long, n_bytes long, round_trip boolean"))
