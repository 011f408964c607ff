"""Session settings, job options and the shared work folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# The defaults a user of the migration job already knows.
DEFAULT_SLICES = 8
DEFAULT_BATCH_SIZE = 2000
DEFAULT_TIME_COLUMN = "ts"
RESTART_ATTEMPTS = 3
RESTART_DELAY_S = 10.0
MILESTONE_BATCHES = 10

CHECKPOINT_CONF = "spark.checkpoint.dir"


@dataclass(frozen=True)
class MoveOptions:
    """What a migration needs to know beyond its source and its target."""

    measurement: str
    ts_col: str = DEFAULT_TIME_COLUMN
    start: str | None = None
    end: str | None = None
    num_slices: int = DEFAULT_SLICES
    batch_size: int = DEFAULT_BATCH_SIZE
    columns: tuple[str, ...] | None = None
    decimal: str = "long"
    nested: str = "json"
    merge_by: tuple[str, ...] = ()
    compat: bool = False
    even_slices: bool = False
    lenient: bool = False

    def __post_init__(self) -> None:
        if not self.measurement:
            raise ValueError("measurement must not be empty")
        if self.measurement.startswith("#"):
            raise ValueError("a measurement that begins with # would make every line a comment")
        if self.num_slices < 1 or self.batch_size < 1:
            raise ValueError("num_slices and batch_size must be positive")


def build_session(app_name: str = "chronoferry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Wall-clock columns and text bounds are read in the session zone; pin it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by the session, or a local one when running locally."""
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    folder = _LOCAL_FOLDERS.get(spark.sparkContext.applicationId)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="chronoferry-")
        _LOCAL_FOLDERS[spark.sparkContext.applicationId] = folder
    return folder


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure that checkpoints have a shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_folder(spark))


_LOCAL_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; they may not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="chronoferry-"), "chronoferry-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def pickle_whole(*names: str) -> None:
    """Let classes of these modules travel with their code. Spark plans streaming sources and sinks of Python in
    processes beside the driver that don't get the package."""
    for name in names:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the work folder that no earlier run has used."""
    return os.path.join(work_folder(spark), f"{label}-{uuid.uuid4().hex}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
