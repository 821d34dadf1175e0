"""K1 K2 K4 K6 O6 sinks that commit: a write counts as a whole or not at all.

``df.write.format("committed")`` writes text outputs of three kinds:

* ``lines``: the column ``value``, a line each, in the order of the rows (K1, K2);
* ``batches``: the same rows as JSON arrays of ``batch_size`` elements a line,
  the rest of a partition as a shorter one (K4);
* ``files``: a file named ``file_name`` with the text ``body`` per row (K6).

Every task attempt writes to a folder of its own and reports it; the driver
then puts a manifest in place that names the folders of the attempts that
count, in partition order, so a sorted frame reads back in order (O6). A task
that is repeated after an executor was lost leaves a folder that no manifest
names, a write that fails leaves the manifest of the write before, and its
folders are removed. ``overwrite`` replaces what was there, ``append`` adds to it.

``read`` gives (part, pos, value) or, for files, (file_name, body): of several
files with one name the one of the last part that holds it counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import filesystem, ship_package

KINDS = {"lines": ["value"], "batches": ["value"], "files": ["file_name", "body"]}


def manifest(path: str) -> tuple[int, dict]:
    """Number and content of the newest manifest; (0, no parts) where there is none."""
    fs, root = filesystem(f"{path}/manifests")
    found = [f.base_name for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.base_name.endswith(".json")]
    if not found:
        return 0, {"kind": None, "parts": []}
    number = max(int(n.removesuffix(".json")) for n in found)
    with fs.open_input_stream(f"{root}/{number}.json") as f:
        return number, json.loads(f.read())


@dataclass
class Part(WriterCommitMessage):
    number: int
    folder: str
    rows: int


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, kind: str, batch_size: int, overwrite: bool):
        self.path, self.kind, self.batch_size, self.overwrite = path.rstrip("/"), kind, batch_size, overwrite

    # --- in a task ------------------------------------------------------------------
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        part = Part(TaskContext.get().partitionId(), f"data/{uuid.uuid4().hex}", 0)
        fs, root = filesystem(f"{self.path}/{part.folder}")
        fs.create_dir(root)
        if self.kind == "files":
            for b in iterator:
                for name, body in zip(b["file_name"].to_pylist(), b["body"].to_pylist(), strict=True):
                    with fs.open_output_stream(f"{root}/{name}") as f:
                        f.write((body or "").encode())
                    part.rows += 1
            return part
        with fs.open_output_stream(f"{root}/part.txt") as f:
            for lines in self._lines(iterator, part):
                f.write("".join(x + "\n" for x in lines).encode())
        return part

    def _lines(self, iterator: Iterator[pa.RecordBatch], part: Part) -> Iterator[list[str]]:
        held: list[str] = []
        for b in iterator:
            rows = [v if v is not None else "" for v in b["value"].to_pylist()]
            part.rows += len(rows)
            if self.kind == "lines":
                yield rows
                continue
            held += rows
            full = len(held) // self.batch_size * self.batch_size
            yield ["[" + ",".join(held[k: k + self.batch_size]) + "]" for k in range(0, full, self.batch_size)]
            held = held[full:]
        if held:
            yield ["[" + ",".join(held) + "]"]

    # --- on the driver ---------------------------------------------------------------
    def commit(self, messages: list[Part | None]) -> None:
        number, before = manifest(self.path)
        kept = [] if self.overwrite else before["parts"]
        new = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.number)
        content = {"kind": self.kind, "parts": kept + [{"folder": m.folder, "rows": m.rows} for m in new]}
        fs, root = filesystem(f"{self.path}/manifests")
        fs.create_dir(root)
        with fs.open_output_stream(f"{root}/{number + 1}.tmp") as f:
            f.write(json.dumps(content).encode())
        fs.move(f"{root}/{number + 1}.tmp", f"{root}/{number + 1}.json")

    def abort(self, messages: list[Part | None]) -> None:
        fs, root = filesystem(self.path)
        for m in messages:
            if m is not None:
                fs.delete_dir(f"{root}/{m.folder}")


class CommittedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed"

    def writer(self, schema: StructType, overwrite: bool) -> CommittedWriter:
        kind = self.options.get("kind", "lines")
        if kind not in KINDS or not set(KINDS[kind]) <= set(schema.names):
            raise ValueError(f"{kind} needs the columns {KINDS.get(kind)}")
        return CommittedWriter(self.options["path"], kind, int(self.options.get("batch_size", "100")), overwrite)


def write(df: DataFrame, path: str, kind: str = "lines", mode: str = "overwrite", batch_size: int = 100) -> None:
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(CommittedSource)
    if kind == "files":   # one file per name: the last by ``ord`` where that column is
        cols = ["body", *(["ord"] if "ord" in df.columns else [])]
        df = df.groupBy("file_name").agg(F.max(F.struct(*reversed(cols))).alias("s")).select("file_name", "s.body")
    df.select(*KINDS[kind]).write.format("committed").option("kind", kind).option("batch_size", batch_size).mode(mode).save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """What the newest manifest names: (part, pos, value), or (file_name, body)."""
    kind, parts = manifest(path)[1].values()
    if not parts:
        return spark.createDataFrame([], "file_name string, body string" if kind == "files" else "part long, pos long, value string")
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/(data/[0-9a-f]{32})/", 1)
    number = F.element_at(F.map_from_arrays(F.array(*[F.lit(p["folder"]) for p in parts]), F.array(*[F.lit(k).cast("long") for k in range(len(parts))])), folder)
    folders = [f"{path}/{p['folder']}" for p in parts]
    if kind == "files":
        whole = spark.read.text(folders, wholetext=True).select(number.alias("part"), F.url_decode(F.replace(F.element_at(F.split("_metadata.file_path", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("file_name"), F.col("value").alias("body"))
        return whole.groupBy("file_name").agg(F.max_by("body", "part").alias("body"))
    # a line's place in its file: range and running number
    return spark.read.text(folders).select(number.alias("part"), F.struct(F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("i")).alias("pos"), "value")


def clean(path: str) -> int:
    """Removes folders that the newest manifest does not name (no writer or reader may be at work); how many."""
    live = {p["folder"].removeprefix("data/") for p in manifest(path)[1]["parts"]}
    fs, root = filesystem(f"{path}/data")
    gone = [f.path for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.base_name not in live]
    for f in gone:
        fs.delete_dir(f)
    return len(gone)
