"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_COPIES   how many times `lineitem` is repeated in the growth run (default 10, 0 leaves it out)

Every query runs twice and the second run counts, so that compiling is not measured.
Results go to the noop sink, which computes all rows and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from functools import reduce

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from chronoferry.config import MoveOptions, build_session, fresh_folder, use_utc  # noqa: E402
from chronoferry.functions.line import to_lines  # noqa: E402
from chronoferry.operators.points import to_points  # noqa: E402
from chronoferry.plans.migrate import migrate  # noqa: E402
from chronoferry.plans.queries import LINE_KEYS, QUERIES  # noqa: E402
from chronoferry.sinks import line_files  # noqa: E402

# Query -> the table whose rows it works through.
HEADLINE = {
    "range_full": "events",
    "range_full_compat": "lineitem",
    "range_from": "orders",
    "partition_counts": "lineitem",
    "range_scan": "events",
    "full_scan": "orders",
    "page_fetch": "lineitem",
    "page_index": "events",
    "page_index_ties": "lineitem",
    "page_batches": "events",
    "points_long": "events",
    "points_long_lineitem": "lineitem",
    "points_wide": "events",
    "points_decimal": "lineitem",
    "points_binary": "documents",
    "rejects": "events",
    "line_protocol": "events",
    "line_protocol_lineitem": "lineitem",
    "point_merge": "lineitem",
    "sink_roundtrip": "events",
    "migrate_events": "events",
    "migrate_merged": "lineitem",
    "progress_totals": "lineitem",
    "log_latest_progress": "events",
    "log_problems": "events",
    "stream_migrate": "events",
}


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(run: Callable[[], None]) -> float:
    run()
    began = time.perf_counter()
    run()
    return time.perf_counter() - began


def growth(spark: SparkSession, sf_dir: str, copies: int) -> dict[str, float]:
    """The copy of `lineitem` once and repeated: time should grow no faster than rows."""
    once = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    seconds = {}
    for n in (1, copies):
        folder = fresh_folder(spark, "grown")
        reduce(DataFrame.unionAll, [once] * n).write.parquet(folder)
        rows = spark.read.parquet(folder)
        seconds[f"lines_x{n}"] = timed(lambda: drain(to_lines(to_points(rows, "lineitem", "l_shipdate"))))
        for label, keys in (("migrate", ()), ("migrate_merged", tuple(LINE_KEYS))):
            options = MoveOptions("lineitem", ts_col="l_shipdate", merge_by=keys)
            sink = lambda lines: line_files(fresh_folder(spark, "out"))(lines)
            seconds[f"{label}_x{n}"] = timed(lambda: migrate(rows, sink, options))
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "10"))
    spark = build_session(
        "chronoferry-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="chronoferry-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)
    counts = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in sorted(set(HEADLINE.values()))}
    seconds = {name: timed(lambda: drain(QUERIES[name](spark, sf_dir))) for name in HEADLINE}
    grown = growth(spark, sf_dir, copies) if copies else {}
    report = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()},
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
        "rows_in": {k: counts[t] for k, t in HEADLINE.items()},
        "rows_per_sec": {k: round(counts[t] / seconds[k]) for k, t in HEADLINE.items()},
        "growth": {k: round(v, 3) for k, v in grown.items()},
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
