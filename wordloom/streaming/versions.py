"""Keyed state as a short list of Parquet segments (K8).

Every batch adds one segment with the keys it changed; a manifest names the
live segments and the batches they hold. When a level has ``FANOUT`` segments,
they are merged into one of the next level, one row per key, before the new
manifest is put in place. So at most ``FANOUT`` segments per level are read,
whatever the number of runs, and a segment is rewritten once per level.

A commit is the creation of the next manifest file, which happens whole or not
at all: a run that dies before it leaves folders that no manifest names, and
the state as it was. A batch that the manifest holds already is not added
again, so a replayed batch changes nothing. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import filesystem

FANOUT = 4
SEQ = "_batch"   # number of the batch that a row comes from


def newest(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge policy: the row of the last batch counts."""
    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (*keys, SEQ)]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest, SEQ), SEQ).alias("_s")).select(*keys, "_s.*").select(rows.columns)
    return merge


def summed(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge policy: the other columns are counts that add up."""
    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (*keys, SEQ)]
        return rows.groupBy(*keys).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in rest], F.max(SEQ).alias(SEQ)).select(rows.columns)
    return merge


@dataclass
class Segment:
    folder: str
    level: int
    rows: int


class Versions:
    """State under ``path`` with the columns of ``schema``; ``merge`` makes one row per key of rows with ``_batch``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, merge: Callable[[DataFrame], DataFrame], fanout: int = FANOUT):
        self.spark, self.path, self.merge, self.fanout = spark, path.rstrip("/"), merge, fanout
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.stored = StructType([*self.schema.fields]).add(SEQ, "long")

    # --- manifest -----------------------------------------------------------------
    def _numbers(self) -> list[int]:
        fs, root = filesystem(f"{self.path}/manifests")
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))

    def manifest(self) -> tuple[int, list[Segment], list[int]]:
        """(number, live segments, batches applied); of a state that has none yet (0, [], [])."""
        numbers = self._numbers()
        if not numbers:
            return 0, [], []
        fs, file = filesystem(f"{self.path}/manifests/{numbers[-1]}.json")
        with fs.open_input_stream(file) as f:
            m = json.loads(f.read())
        return numbers[-1], [Segment(**s) for s in m["segments"]], m["batches"]

    def _commit(self, number: int, segments: list[Segment], batches: list[int]) -> None:
        fs, root = filesystem(f"{self.path}/manifests")
        fs.create_dir(root)
        with fs.open_output_stream(f"{root}/{number}.tmp") as f:
            f.write(json.dumps({"segments": [vars(s) for s in segments], "batches": batches}).encode())
        fs.move(f"{root}/{number}.tmp", f"{root}/{number}.json")

    # --- segments -----------------------------------------------------------------
    def _rows(self, segments: list[Segment]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*[f"{self.path}/{s.folder}" for s in segments])

    def _write(self, rows: DataFrame, level: int) -> Segment:
        folder = f"segments/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        written = Segment(folder, level, 0)
        written.rows = self._rows([written]).count()   # from the files' footers
        return written

    def _compacted(self, segments: list[Segment]) -> list[Segment]:
        level = 0
        while any(s.level >= level for s in segments):
            full = [s for s in segments if s.level == level]
            if len(full) >= self.fanout:
                segments = [s for s in segments if s.level != level] + [self._write(self.merge(self._rows(full)), level + 1)]
            level += 1
        return segments

    # --- use ------------------------------------------------------------------------
    def read(self) -> DataFrame:
        """One row per key."""
        return self.merge(self._rows(self.manifest()[1])).select(self.schema.names)

    def add(self, changes: DataFrame, batch: int) -> bool:
        """Adds the rows of a batch, once; whether they are new."""
        number, segments, batches = self.manifest()
        if batch in _spans(batches):
            return False
        new = self._write(self.merge(changes.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], F.lit(batch).cast("long").alias(SEQ))), 0)
        segments = self._compacted(segments + ([new] if new.rows else []))
        self._commit(number + 1, segments, _with(batches, batch))
        return True

    def clean(self) -> int:
        """Removes folders and manifests that the newest manifest does not need (no reader may be at work); how many."""
        number, segments, _ = self.manifest()
        live, gone = {s.folder.removeprefix("segments/") for s in segments}, 0
        fs, root = filesystem(f"{self.path}/segments")
        for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if f.base_name not in live:
                fs.delete_dir(f.path)
                gone += 1
        fs, root = filesystem(f"{self.path}/manifests")
        for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if f.base_name != f"{number}.json":
                fs.delete_file(f.path)
                gone += 1
        return gone


class _spans:
    """The batches of a manifest, kept as closed ranges [from, to, from, to, ...]."""

    def __init__(self, flat: list[int]):
        self.ranges = list(zip(flat[::2], flat[1::2], strict=True))

    def __contains__(self, batch: int) -> bool:
        return any(a <= batch <= b for a, b in self.ranges)


def _with(flat: list[int], batch: int) -> list[int]:
    """The ranges with one more batch."""
    ranges = sorted([*_spans(flat).ranges, (batch, batch)])
    out: list[list[int]] = []
    for a, b in ranges:
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [x for r in out for x in r]
