"""SparkSession helpers.

Cluster jobs receive a session from the caller; these helpers only fill in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

# Settings the library relies on. Applied only where the session has no value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wordloom") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no server ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory())
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage; it
    is read, never replaced. Only when it is unset *and* the master is local
    (tests, benchmarks) a scratch folder is created and registered; on a
    cluster an unset value is an error, never a machine-local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="wordloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        pass
    return d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions of the package that run inside tasks are found by name there, so
    the workers must be able to import it wherever the driver was started.
    """
    sc = spark.sparkContext
    if getattr(sc, "_wordloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="wordloom-pkg-")) / "wordloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    sc.addPyFile(str(target))
    sc._wordloom_shipped = True


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder for what one run writes; removed when the driver exits."""
    if not _run_folders:
        atexit.register(_remove_run_folders)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _run_folders.append(folder)
    return folder


_run_folders: list[str] = []


def _remove_run_folders() -> None:
    for folder in _run_folders:
        try:
            fs, path = filesystem(folder)
            if fs.get_file_info(path).type == pafs.FileType.Directory:
                fs.delete_dir(path)
        except Exception as e:  # noqa: BLE001 - the driver is going down; the folder is left to the operator
            print(f"left {folder}: {e}")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it (``file:``, ``hdfs:``, ``s3:`` or a plain path)."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def apply_defaults(spark: SparkSession) -> None:
    """Set library defaults on a given session where they are unset."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def driver_memory(cap_mb: int = 16384) -> str:
    """Local-mode heap: 60% of physical memory, at most ``cap_mb``."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // (1024 * 1024)
    except (ValueError, OSError, AttributeError):
        return f"{cap_mb}m"
    return f"{max(1024, min(cap_mb, int(total * 0.6)))}m"
