"""Token ids in fixed-width bit-packed files.

Ids take the minimum number of bits of the vocabulary (``width_of``). Documents
are sorted by id over a range partitioning; each partition writes one shard:

    header      MAGIC, width (u32)
    block       first token (u64), token count (u32), payload bytes (u32), payload
    documents   per document: id (i64), id is null (u8), first token in the shard (u64), token count (u64)
    blocks      per block: first token (u64), file position (u64), token count (u32)
    footer      position of documents and blocks (u64 each), their counts (u64 each), token count (u64), MAGIC

A block holds ``BLOCK`` ids; its payload is the ids' bits in order, least
significant first, so one numpy call unpacks it, and the block index gives
random access to any token range (``Shard.read``).

Shards get a name of their own per task attempt and count only once the
manifest names them, so a lost executor or a repeated task leaves no mixture.

Defined results: null and empty texts are the end id alone. Rows with a null
``doc_id`` sort first; rows that share a ``doc_id`` follow each other in the
order of their texts' hashes. Further columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm import common

MAGIC = b"BPK1"
BLOCK = 1 << 16
CACHE = 1_000_000      # most pieces whose ids a worker keeps, over all its tasks
END_ID = 0
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("first", "<u8"), ("count", "<u8")])
INDEX = np.dtype([("first", "<u8"), ("at", "<u8"), ("count", "<u4")])
FOOTER = struct.Struct("<QQQQQ4s")
HEAD, BLOCK_HEAD = struct.Struct("<4sI"), struct.Struct("<QII")


def width_of(vocabulary: int) -> int:
    """Bits that hold every id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each id, one after the other."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(payload: bytes, count: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(payload, f"<u{width // 8}", count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(payload, np.uint8), count=count * width, bitorder="little").reshape(count, width)
    whole = np.zeros((count, 32), np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").reshape(count).astype(np.uint32)


# --- files --------------------------------------------------------------------
class Writer:
    """One shard; ids are buffered up to a block."""

    def __init__(self, uri: str, width: int):
        fs, path = common.filesystem(uri)
        self.out, self.width, self.at, self.tokens = fs.open_output_stream(path), width, 0, 0
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.docs: list[np.ndarray] = []
        self.blocks: list[tuple[int, int, int]] = []
        self._put(HEAD.pack(MAGIC, width))

    def _put(self, b: bytes) -> None:
        self.out.write(b)
        self.at += len(b)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        first = self.tokens + self.n_held
        self.docs.append(np.array([(doc_id or 0, doc_id is None, first, len(ids))], DOC))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        at = 0
        while len(ids) - at >= BLOCK or (all_of_it and at < len(ids)):
            part = ids[at: at + BLOCK]
            payload = pack(part, self.width)
            self.blocks.append((self.tokens, self.at, len(part)))
            self._put(BLOCK_HEAD.pack(self.tokens, len(part), len(payload)))
            self._put(payload)
            self.tokens += len(part)
            at += len(part)
        self.held, self.n_held = [ids[at:].copy()], len(ids) - at

    def close(self) -> None:
        self._flush(True)
        docs_at = self.at
        for d in self.docs:
            self._put(d.tobytes())
        blocks_at = self.at
        self._put(np.array(self.blocks, INDEX).tobytes())
        self._put(FOOTER.pack(docs_at, len(self.docs), blocks_at, len(self.blocks), self.tokens, MAGIC))
        self.out.close()


class Shard:
    """Random access to a shard's documents and tokens."""

    def __init__(self, uri: str):
        fs, path = common.filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        docs_at, n_docs, blocks_at, n_blocks, self.tokens, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        head, self.width = HEAD.unpack(self.file.read_at(HEAD.size, 0))
        if magic != MAGIC or head != MAGIC:
            raise ValueError(f"{uri} is not a packed shard")
        self.docs_at, self.n_docs = docs_at, n_docs
        self.blocks = np.frombuffer(self.file.read_at(n_blocks * INDEX.itemsize, blocks_at), INDEX)

    def documents(self, rows: int = 1 << 16) -> Iterator[np.ndarray]:
        for at in range(0, self.n_docs, rows):
            n = min(rows, self.n_docs - at)
            yield np.frombuffer(self.file.read_at(n * DOC.itemsize, self.docs_at + at * DOC.itemsize), DOC)

    def block(self, k: int) -> np.ndarray:
        first, at, count = self.blocks[k]
        _, n, size = BLOCK_HEAD.unpack(self.file.read_at(BLOCK_HEAD.size, int(at)))
        return unpack(self.file.read_at(size, int(at) + BLOCK_HEAD.size), n, self.width)

    def pieces(self, first: int, count: int, cache: dict[int, np.ndarray]) -> Iterator[np.ndarray]:
        """The ids [first, first + count), a block at a time; ``cache`` keeps the last block."""
        k = int(np.searchsorted(self.blocks["first"], first, side="right")) - 1
        while count > 0:
            if k not in cache:
                cache.clear()
                cache[k] = self.block(k)
            at = first - int(self.blocks["first"][k])
            part = cache[k][at: at + count]
            yield part
            first, count, k = first + len(part), count - len(part), k + 1

    def read(self, first: int, count: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *self.pieces(first, count, {})])


# --- encoding -----------------------------------------------------------------
_cut = re.compile(r"(?<=\S)(?=[ \n]\S)")
STOPS = ".,;:!?*#$%&|"
_stop = re.compile(r"(?s)(.*[A-Za-z\u00c0-\u024f])([" + STOPS + "]+)")
# Fixed value: the tokens of the byte-level pre-tokenizer, here on texts of ASCII, Latin letters, spaces and line feeds.
_tokens = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ \nA-Za-zÀ-ÖØ-öø-ÿ0-9]+|[ \n]+(?![^ \n])|[ \n]+").findall
_other = re.compile(r"[^\n -\x7eÀ-ÖØ-öø-ÿ]").search
LITERAL = "\r"   # first character of a piece's name if the piece does not begin with a space


def pieces(text: str) -> list[str]:
    """Names of the pieces of a text, cut before single spaces and line feeds between other characters.

    A name is the piece without its space, or LITERAL and the piece. Texts
    whose only white space is single spaces and line feeds take the short way,
    so no word there begins with LITERAL.
    """
    words = text.replace("\n", " \n").split(" ")
    if LITERAL in text or "" in words or "\n" in words or len(words) != len(text.split()):
        return [LITERAL + p for p in _cut.split(text)] if text else []
    words[0] = LITERAL + words[0]
    return words


def _spelled(name: str) -> str:
    return name[1:] if name[0] == LITERAL else name if name[0] == "\n" else " " + name


class Encoder:
    """Whole texts to ids by the ``tokenizers`` library, piece by piece.

    Texts of the common alphabet are cut into the pre-tokenizer's own tokens,
    and each distinct token goes through the model once (``tokens``: the same
    model without the pre-tokenizer's pattern). Other texts take larger pieces:
    The byte-level pre-tokenizer never joins a character that is no space with
    a single space or line feed after it, nor a letter with the punctuation
    after it (apostrophes apart), so cutting there leaves the ids as they are.
    A piece's ids are kept, as most pieces come again; the cache is bounded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.t = Tokenizer.from_file(path)
        self.t.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.tokens = Tokenizer.from_file(path)
        self.tokens.encode_special_tokens = True
        self.tokens.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.of_token: dict[str, bytes] = {}

    def _learn(self, names: set[str]) -> None:
        """Adds the ids of pieces that are not known; a piece with punctuation at its end is put together from two."""
        known, both = self.known, {}
        for name in names:
            if name[-1] in STOPS and (m := _stop.fullmatch(name)):
                both[name] = (m[1], LITERAL + m[2])
        new = list({x for pair in both.values() for x in pair if x not in known} | (names - both.keys()))
        for at in range(0, len(new), 4096):
            part = new[at: at + 4096]
            for name, e in zip(part, self.t.encode_batch_fast([_spelled(x) for x in part], add_special_tokens=False), strict=True):
                known[name] = np.array(e.ids, "<u4").tobytes()
        for name, (a, b) in both.items():
            known[name] = known[a] + known[b]

    def _learn_tokens(self, new: list[str]) -> None:
        for at in range(0, len(new), 4096):
            part = new[at: at + 4096]
            for token, e in zip(part, self.tokens.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.of_token[token] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        for held in (self.known, self.of_token):
            if len(held) > CACHE:
                held.clear()
        common_alphabet = [bool(t) and not _other(t) for t in texts]
        cut = [[] if not t else _tokens(t) if plain else pieces(t) for t, plain in zip(texts, common_alphabet, strict=True)]
        self._learn_tokens(list(set().union(*(c for c, plain in zip(cut, common_alphabet, strict=True) if plain)).difference(self.of_token)))
        self._learn(set().union(*(c for c, plain in zip(cut, common_alphabet, strict=True) if not plain)).difference(self.known))
        end = np.array([END_ID], "<u4").tobytes()
        return [np.frombuffer(b"".join([*map((self.of_token if plain else self.known).__getitem__, names), end]), "<u4") for names, plain in zip(cut, common_alphabet, strict=True)]


@lru_cache(maxsize=1)
def load(path: str) -> Encoder:
    """The encoder of a worker, with its cache."""
    return Encoder(path)


MANIFEST = pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("tokens", pa.int64())])


def _write(folder: str, tokenizer: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, out, uri = None, None, f"{folder}/shard-{part:06d}-{uuid.uuid4().hex}.bpk"
        for b in common.slices(batches, 128):
            if out is None and b.num_rows:
                encoder, out = load(tokenizer), Writer(uri, width)
            for doc_id, ids in zip(b.column(0).to_pylist(), encoder.encode(b.column(1).to_pylist()) if encoder else [], strict=True):
                out.add(doc_id, ids)
        if out is not None:
            out.close()
            yield common.batch(MANIFEST, [part], [uri], [len(out.docs)], [out.tokens])
    return run


def write(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int) -> DataFrame:
    """Write ``docs`` (doc_id, text) as shards in ascending id order; the manifest: (part, path, n_docs, tokens, start)."""
    fs, path = common.filesystem(folder)
    fs.create_dir(f"{path}/shards")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("tie", F.xxhash64("text")).orderBy(F.asc_nulls_first("doc_id"), "tie").select("doc_id", "text"))
    found = common.written(ordered.mapInArrow(_write(f"{folder}/shards", tokenizer, width_of(vocabulary)), "part long, path string, n_docs long, tokens long"), f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return found.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


DIGESTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            shard, cache = Shard(path), {}
            for docs in shard.documents():
                sums = []
                for d in docs:
                    crc = 0
                    for ids in shard.pieces(int(d["first"]), int(d["count"]), cache):
                        crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    sums.append(crc)
                ids = pa.array(docs["id"].astype(np.int64), mask=docs["null"].astype(bool))
                yield common.batch(DIGESTS, ids, docs["first"].astype(np.int64) + start, docs["count"].astype(np.int64), sums)


def digests(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the shards."""
    shards = manifest.select("path", "start")
    return shards.repartition(max(1, shards.count()), "path").mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
