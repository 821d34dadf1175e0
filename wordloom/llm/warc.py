"""WARC archives: a writer with revisit records and a salvage reader.

``write`` stores one record per page in gzip members (one member per record).
Of the records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one
with the largest page id is the response and the others are revisits of it.

``read`` goes through archives record by record. Where a check fails (a member
that does not inflate, a version line, header block or length that is wrong, a
payload whose digest differs), it searches for the next gzip member or version
line that opens a valid record, goes on from there, and reports the bytes in
between as a quarantined gap. Compressed and plain archives, and archives that
mix both, are read; the file is taken in pieces, and at most one record is in
memory.

Archives get a name of their own per task attempt and count only once the
manifest names them.

Defined results: null html is an empty payload. Rows with equal page ids are
separate records. A null page id is written without an id and read back as
null; it is the response of its group only if no row of it has an id. Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import common

REVISIT_BYTES = 1000
PIECE = 1 << 16
LONGEST_HEAD = 1 << 16         # a header block longer than this is not one
VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
GZIP = b"\x1f\x8b\x08"


# --- writer -------------------------------------------------------------------
def digest_label(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_hex(label: str) -> str:
    """Bare lower-case hex of a ``sha1:`` label in base 32 or hex."""
    value = label.split(":", 1)[-1].strip()
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record: a response with its payload, or a revisit that names the response's page."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: {digest_label(payload)}", f"WARC-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    body = b"" if revisit else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n, uri = None, 0, f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        for b in common.slices(batches, 256):
            if out is None and b.num_rows:
                fs, path = common.filesystem(uri)
                out = fs.open_output_stream(path, compression=None)
            for page_id, url, html, revisit, target in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                out.write(member(record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), target, revisit)))
                n += 1
        if out is not None:
            out.close()
            yield common.batch(MANIFEST, [uri], [n])
    return run


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, revisit, refers_to): who of equal long payloads is kept whole.

    Only digests that occur more than once are joined back, on the digest; the
    grouping has a map-side part, and AQE can split the join for a hot digest.
    """
    keyed = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
             .withColumn("digest", F.when(F.octet_length("html") >= REVISIT_BYTES, F.unhex(F.sha1("html"))))
             .withColumn("tie", F.xxhash64("url")))
    groups = (keyed.where("digest is not null").groupBy("digest")
              .agg(F.max(F.struct("page_id", "tie")).alias("top"), F.count("*").alias("k")).where("k > 1").select("digest", "top"))
    own = F.struct("page_id", "tie")
    return (keyed.join(groups, "digest", "left")
            .select("page_id", "url", "html", F.coalesce(F.col("top").isNotNull() & ~own.eqNullSafe(F.col("top")), F.lit(False)).alias("revisit"), F.col("top.page_id").alias("target"))
            .withColumn("target", F.when(F.col("revisit"), F.col("target"))))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html) as archives; the manifest: (path, records)."""
    fs, path = common.filesystem(folder)
    fs.create_dir(f"{path}/archives")
    return common.written(revisits(pages).mapInArrow(_write(f"{folder}/archives"), "path string, records long"), f"{folder}/manifest")


# --- salvage reader -----------------------------------------------------------
class Broken(Exception):
    """A check of the record at hand failed."""


class _File:
    """A file read by position, a piece at a time."""

    def __init__(self, uri: str):
        fs, path = common.filesystem(uri)
        self.f = fs.open_input_file(path)
        self.size = self.f.size()

    def at(self, pos: int, n: int) -> bytes:
        return self.f.read_at(max(0, min(n, self.size - pos)), pos) if pos < self.size else b""

    def find(self, pos: int) -> int:
        """First place from ``pos`` on where a gzip member or a version line may begin, or the end."""
        while pos < self.size:
            piece = self.at(pos, PIECE)
            hits = [i for i in (piece.find(GZIP), piece.find(b"WARC/")) if i >= 0]
            if hits:
                return pos + min(hits)
            if pos + len(piece) >= self.size:
                return self.size
            pos += len(piece) - 4
        return self.size


def _inflated(f: _File, pos: int) -> Iterator[tuple[bytes, int]]:
    """(inflated bytes, place after them in the file) of the member at ``pos``."""
    z = zlib.decompressobj(31)
    while not z.eof:
        piece = f.at(pos, PIECE)
        if not piece:
            raise Broken("member ends early")
        try:
            out = z.decompress(piece)
        except zlib.error as e:
            raise Broken(f"member does not inflate: {e}") from None
        pos += len(piece) - len(z.unused_data)
        yield out, pos


def _plain(f: _File, pos: int) -> Iterator[tuple[bytes, int]]:
    while piece := f.at(pos, PIECE):
        pos += len(piece)
        yield piece, pos


def parse(f: _File, pos: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, body, place after) of the record at ``pos``; Broken where a check fails."""
    packed = f.at(pos, 3) == GZIP
    source = _inflated(f, pos) if packed else _plain(f, pos)
    data, end = bytearray(), pos

    def fill(n: int) -> bool:
        nonlocal end
        while len(data) < n:
            more = next(source, None)
            if more is None:
                return False
            data.extend(more[0])
            end = more[1]
        return True

    while (split := data.find(b"\r\n\r\n")) < 0:
        if len(data) > LONGEST_HEAD or not fill(len(data) + 1):
            raise Broken("no header block")
        if len(data) >= 10 and not VERSION.match(data):
            raise Broken("no version line")
    if not VERSION.match(data):
        raise Broken("no version line")
    head: dict[str, str] = {}
    for line in bytes(data[:split]).split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            raise Broken("a header line has no colon")
        head[k.decode("latin-1").strip().lower()] = v.decode("utf-8", "replace").strip()
    if not re.fullmatch(r"\d{1,18}", head.get("content-length", "")):
        raise Broken("no content length")
    size = int(head["content-length"])
    if not packed and pos + split + 8 + size > f.size:
        raise Broken("record ends early")
    # a wrong length is found out where it points to, before what lies between is held in memory
    if not packed and f.at(pos + split + 4 + size, 4) != b"\r\n\r\n":
        raise Broken("record does not end where its length says")
    if not fill(split + 8 + size):
        raise Broken("record ends early")
    body = bytes(data[split + 4: split + 4 + size])
    if bytes(data[split + 4 + size: split + 8 + size]) != b"\r\n\r\n":
        raise Broken("record does not end where its length says")
    if packed:
        if len(data) > split + 8 + size:
            raise Broken("member goes on after its record")
        while (more := next(source, None)) is not None:  # to the member's own checksum
            if more[0]:
                raise Broken("member goes on after its record")
            end = more[1]
    else:
        end = pos + split + 8 + size
    if head.get("warc-type") == "response" and "warc-payload-digest" in head:
        label = head["warc-payload-digest"]
        if label.startswith("sha1:") and digest_hex(label) != hashlib.sha1(body).hexdigest():
            raise Broken("payload digest differs")
    return head, body, end


def salvage(uri: str) -> Iterator[tuple[str, int, int, dict[str, str], bytes, str]]:
    """("record", begin, end, headers, body, "") and ("gap", begin, end, {}, b"", reason) over a whole archive."""
    f = _File(uri)
    pos, gap, why = 0, -1, ""
    while pos < f.size:
        try:
            head, body, end = parse(f, pos)
        except (Broken, ValueError) as e:
            if gap < 0:
                gap, why = pos, str(e)
            pos = f.find(pos + 1)
            continue
        if gap >= 0:
            yield "gap", gap, pos, {}, b"", why
            gap = -1
        yield "record", pos, end, head, body, ""
        pos = end
    if gap >= 0:
        yield "gap", gap, f.size, {}, b"", why


RECORDS = pa.schema([("path", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("reason", pa.string()), ("record_type", pa.string()),
                     ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
HELD = 1 << 22


def _page(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(m[1]) if m else None


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows, held = [], 0
                for kind, begin, end, head, body, why in salvage(uri):
                    label, size = head.get("warc-payload-digest"), head.get("warc-payload-length", "")
                    revisit = head.get("warc-type") == "revisit"
                    rows.append((uri, begin, end, kind, why or None, head.get("warc-type"), _page(head.get("warc-record-id")), _page(head.get("warc-refers-to")),
                                 None if kind == "gap" else int(size) if revisit and size.isdigit() else len(body),
                                 digest_hex(label) if label else None, body if with_payload and kind == "record" else None))
                    held += len(body) + 500
                    if held >= HELD:
                        yield common.batch(RECORDS, *zip(*rows, strict=True))
                        rows, held = [], 0
                if rows:
                    yield common.batch(RECORDS, *zip(*rows, strict=True))
    return run


def read(spark: SparkSession, archives: DataFrame, payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives named in column ``path``; an archive is a task's work."""
    paths = archives.select("path")
    schema = "path string, begin long, end long, kind string, reason string, record_type string, page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(_read(payload), schema)
