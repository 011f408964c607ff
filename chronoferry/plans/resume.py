"""A copy to files that can be stopped anywhere and goes on where it stopped.

The range and its slices are found once and written down. Every slice is a job of its own: its lines go to
a folder that is renamed when they are complete, and then a file in `_manifest` says that the slice is done.
A run plans only the slices without such a file; what a stopped run left of a slice is done anew.

    target/_manifest/plan.json       range, slices, and the options that shape the lines
    target/_manifest/slice-00003     what the slice held
    target/_manifest/rejected        how many rows have no usable time
    target/part_id=3/                its lines

Slices read only their part of the table where it is stored by time; a table that isn't is scanned once for
each slice, so take few slices there.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from chronoferry.config import MILESTONE_BATCHES, MoveOptions
from chronoferry.functions.columns import project
from chronoferry.functions.timestamps import instant_text
from chronoferry.operators.logs import progress_messages
from chronoferry.operators.merge import Packing, find_packing
from chronoferry.operators.points import rejected_rows, to_points
from chronoferry.operators.ranges import TimeRange, find_range
from chronoferry.operators.slices import slice_ranges, weighted_slices
from chronoferry.plans.migrate import needed_columns, observed_lines, reject
from chronoferry.sinks import Sink, line_files
from chronoferry.sinks.folder import SharedFolder
from chronoferry.sources import jdbc
from chronoferry.sources.files import scan
from chronoferry.sources.jdbc import JdbcSource

log = logging.getLogger(__name__)

MANIFEST, PLAN, REJECTED = "_manifest", "_manifest/plan.json", "rejected"
STAGING = "_staging"


@dataclass(frozen=True)
class SliceDone:
    """What a committed slice held."""

    part_id: int
    lo_us: int
    hi_us: int
    read: int
    points: int
    lines: int
    lost: int


@dataclass(frozen=True)
class ResumeReport:
    """All committed slices, and the numbers of those that this run copied."""

    range: TimeRange | None
    slices: dict[int, SliceDone]
    copied: tuple[int, ...]
    rejected: int = 0

    @property
    def read(self) -> int:
        """Rows that this run read."""
        return sum(self.slices[k].read for k in self.copied)

    @property
    def written(self) -> int:
        """Lines of all runs."""
        return sum(s.lines for s in self.slices.values())


@dataclass(frozen=True)
class Plan:
    range: TimeRange | None
    slices: list[TimeRange]


def migrate_resumable(
    df: DataFrame,
    target: str,
    options: MoveOptions,
    compression: str = "none",
    at_once: int = 1,
    log_folder: str | None = None,
    rejects: str | None = None,
) -> ResumeReport:
    """Copy a table, slice by slice, of equal width or with `even_slices` of about equal row counts.

    `at_once` slices run side by side. With `log_folder` the job writes its progress there: for every slice
    that is done a line each ten batches and one at its end, and one for a slice that failed.
    Rows without a usable time are counted by the first run that gets so far, and written below `rejects` as JSON.
    The first failure ends the run after the slices that are under way; another run goes on.
    """
    spark = df.sparkSession

    def cut() -> Plan:
        rng = find_range(df, options.ts_col, options.start, options.end, options.compat, options.lenient)
        if rng is None:
            return Plan(None, [])
        if options.even_slices:
            return Plan(rng, weighted_slices(df, rng, options.ts_col, options.num_slices))
        return Plan(rng, slice_ranges(rng, options.num_slices))

    def read(rng: TimeRange) -> DataFrame:
        return scan(df, rng, options.ts_col, needed_columns(options))

    def refuse() -> int:
        return reject(rejected_rows(df, options.ts_col), _json_files(rejects))

    return _run(spark, target, options, cut, read, refuse, compression, at_once, log_folder)


def migrate_jdbc_resumable(
    spark: SparkSession,
    source: JdbcSource,
    target: str,
    options: MoveOptions,
    compression: str = "none",
    at_once: int = 1,
    log_folder: str | None = None,
    rejects: str | None = None,
    tasks_per_slice: int = 1,
) -> ResumeReport:
    """The same for a JDBC table; a slice is read by `tasks_per_slice` connections."""

    def cut() -> Plan:
        rng = jdbc.find_jdbc_range(spark, source, options.start, options.end, options.compat, options.lenient)
        if rng is None:
            return Plan(None, [])
        if options.even_slices:
            return Plan(rng, jdbc.even_jdbc_slices(spark, source, rng, options.num_slices))
        return Plan(rng, slice_ranges(rng, options.num_slices))

    def read(rng: TimeRange) -> DataFrame:
        return project(jdbc.read_jdbc(spark, source, slice_ranges(rng, tasks_per_slice)), needed_columns(options))

    def refuse() -> int:
        if rejects is None:
            return jdbc.count_untimed(spark, source)
        return reject(rejected_rows(jdbc.read_untimed(spark, source), options.ts_col), _json_files(rejects))

    return _run(spark, target, options, cut, read, refuse, compression, at_once, log_folder)


def copied_lines(spark: SparkSession, target: str) -> DataFrame:
    """The lines of all committed slices, and of no others."""
    folder = SharedFolder(spark, target)
    paths = [folder.at(f"part_id={k}") for k in _committed(folder)]
    if not paths:
        return spark.createDataFrame([], "line string")
    return spark.read.schema("line string").text(paths)


def _run(
    spark: SparkSession,
    target: str,
    options: MoveOptions,
    cut: Callable[[], Plan],
    read: Callable[[TimeRange], DataFrame],
    refuse: Callable[[], int],
    compression: str,
    at_once: int,
    log_folder: str | None,
) -> ResumeReport:
    folder = SharedFolder(spark, target)
    plan = _plan(folder, options, cut)
    if REJECTED not in folder.names(MANIFEST):
        folder.write(f"{MANIFEST}/{REJECTED}", [str(refuse())])
    rejected = int(folder.read(f"{MANIFEST}/{REJECTED}"))
    if plan.range is None:
        return ResumeReport(None, {}, (), rejected)
    done = _committed(folder)
    pending = [k for k in range(len(plan.slices)) if k not in done]
    packing = _packing(read(plan.range), options) if pending and options.merge_by else None
    notes = SharedFolder(spark, log_folder) if log_folder else None
    failed = Event()

    def copy(k: int) -> None:
        if failed.is_set():
            return
        slice_ = plan.slices[k]
        times = instant_text(slice_.lo_us), instant_text(slice_.hi_us)
        try:
            entry = _copy_slice(folder, k, slice_, read(slice_), options, packing, compression)
        except Exception as failure:
            failed.set()
            if notes:
                text = f"ERROR Error in time partition {times[0]} to {times[1]}: {type(failure).__name__}"
                notes.write(f"slice-{k:05d}-{uuid.uuid4().hex}.log", [text])
            raise
        log.info("slice %d of %d is done: %d rows", k, len(plan.slices), entry.read)
        if notes:
            notes.write(f"slice-{k:05d}.log", progress_messages(entry.read, options.batch_size * MILESTONE_BATCHES, *times))

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(copy), k) for k in pending]
    for run in runs:
        run.result()
    return ResumeReport(plan.range, _committed(folder), tuple(pending), rejected)


def _copy_slice(
    folder: SharedFolder,
    k: int,
    rng: TimeRange,
    rows: DataFrame,
    options: MoveOptions,
    packing: Packing | None,
    compression: str,
) -> SliceDone:
    lines, seen = observed_lines(rows, options, packing)
    staged = f"{STAGING}/{k}-{uuid.uuid4().hex}"
    line_files(folder.at(staged), compression)(lines)
    folder.publish(staged, f"part_id={k}")
    counts = seen.get
    entry = SliceDone(k, rng.lo_us, rng.hi_us, counts["read"], counts["points"], counts["lines"], counts["lost"])
    folder.write(f"{MANIFEST}/slice-{k:05d}", [json.dumps(asdict(entry))])
    return entry


def _plan(folder: SharedFolder, options: MoveOptions, cut: Callable[[], Plan]) -> Plan:
    """The plan of the first run, which later ones keep: a table that grows meanwhile has the same slices."""
    # What a line looks like and which slice it is in; a slice of another shape must not stand beside.
    shape = json.loads(json.dumps({k: v for k, v in asdict(options).items() if k != "batch_size"}))
    if "plan.json" in folder.names(MANIFEST):
        written = json.loads(folder.read(PLAN))
        if written["options"] != shape:
            wrong = sorted(k for k in shape if shape[k] != written["options"].get(k))
            raise ValueError(f"{folder.root} was begun with other options: {', '.join(wrong)}")
        plan = Plan(None, [])
        if written["range"] is not None:
            plan = Plan(TimeRange(*written["range"]), [TimeRange(*edges) for edges in written["slices"]])
        return plan
    plan = cut()
    rng = None if plan.range is None else (plan.range.lo_us, plan.range.hi_us)
    slices = [(s.lo_us, s.hi_us) for s in plan.slices]
    folder.write(PLAN, [json.dumps({"options": shape, "range": rng, "slices": slices})])
    return plan


def _committed(folder: SharedFolder) -> dict[int, SliceDone]:
    names = [name for name in folder.names(MANIFEST) if name.startswith("slice-")]
    entries = (SliceDone(**json.loads(folder.read(f"{MANIFEST}/{name}"))) for name in names)
    return {entry.part_id: entry for entry in entries}


def _json_files(path: str | None) -> Sink | None:
    """A sink that replaces what a run left that died while writing."""
    return None if path is None else lambda rows: rows.write.mode("overwrite").json(path)


def _packing(rows: DataFrame, options: MoveOptions) -> Packing | None:
    return find_packing(to_points(rows, options.measurement, options.ts_col, options.decimal, options.nested, options.merge_by))
