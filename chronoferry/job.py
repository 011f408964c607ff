"""The migration as a job for `spark-submit`.

    spark-submit --py-files chronoferry.zip chronoferry/job.py \\
        --source-files hdfs:///tables/sensors --measurement sensors --target-files hdfs:///lines/sensors
    spark-submit ... chronoferry/job.py \\
        --source-jdbc-url jdbc:... --source-table db.sensors --source-username me --source-password-file pw \\
        --measurement sensors --target-url http://host:8086 --target-token-file token \\
        --target-org org --target-bucket bucket --parallelism 2000
    spark-submit ... chronoferry/job.py --source-files ... --target-files ... --resumable --log-folder hdfs:///logs

With `--resumable` the same command goes on where a stopped job stopped. Passwords and tokens are read from files, so that they stand in no process list or log.
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import asdict

from chronoferry.config import (
    DEFAULT_BATCH_SIZE,
    DEFAULT_SLICES,
    DEFAULT_TIME_COLUMN,
    RESTART_ATTEMPTS,
    RESTART_DELAY_S,
    MoveOptions,
    build_session,
)
from chronoferry.plans.migrate import MoveReport, migrate, migrate_jdbc
from chronoferry.plans.resume import ResumeReport, migrate_jdbc_resumable, migrate_resumable
from chronoferry.restart import restarted
from chronoferry.sinks import Sink, line_endpoint, line_files
from chronoferry.sinks.transport import BACKOFF_BASE, MAX_ATTEMPTS, MAX_DELAY_S, RETRY_DELAY_S
from chronoferry.sources import JdbcSource, read_files

log = logging.getLogger(__name__)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Move a time-series table into a tag/field store.")
    source = parser.add_argument_group("source")
    which = source.add_mutually_exclusive_group(required=True)
    which.add_argument("--source-files", help="path of a table in files")
    which.add_argument("--source-jdbc-url")
    source.add_argument("--source-format", default="parquet")
    source.add_argument("--source-table")
    source.add_argument("--source-username")
    source.add_argument("--source-password-file")
    source.add_argument("--source-driver")
    source.add_argument("--source-quote", help="sign around column names, if Spark has no dialect for the address")
    source.add_argument("--source-literal", help="form of an instant with {} for its text, likewise")
    source.add_argument("--time-column", default=DEFAULT_TIME_COLUMN)
    target = parser.add_argument_group("target")
    where = target.add_mutually_exclusive_group(required=True)
    where.add_argument("--target-files", help="path for text files of lines")
    where.add_argument("--target-url")
    target.add_argument("--target-token-file")
    target.add_argument("--target-org")
    target.add_argument("--target-bucket")
    target.add_argument("--compression", default="none", help="of line files")
    target.add_argument("--overwrite", action="store_true", help="replace line files that are there")
    target.add_argument("--writers", type=int, help="most connections to the endpoint at the same time")
    target.add_argument("--gzip", action="store_true", help="zip what is sent to the endpoint")
    target.add_argument("--max-retries", type=int, default=MAX_ATTEMPTS, help="attempts for each body, the first among them")
    target.add_argument("--retry-delay", type=float, default=RETRY_DELAY_S, help="seconds before the second attempt")
    target.add_argument("--max-delay", type=float, default=MAX_DELAY_S)
    target.add_argument("--backoff-base", type=float, default=BACKOFF_BASE)
    target.add_argument("--measurement", required=True)
    parser.add_argument("--parallelism", type=int, default=DEFAULT_SLICES, help="time slices")
    parser.add_argument("--batch-size", type=int, default=DEFAULT_BATCH_SIZE)
    parser.add_argument("--start-time", help="yyyy-MM-dd HH:mm:ss.SSS, inclusive")
    parser.add_argument("--end-time", help="yyyy-MM-dd HH:mm:ss.SSS, exclusive")
    parser.add_argument("--lenient", action="store_true", help="leave out bounds that can't be read, with a warning")
    parser.add_argument("--merge-by", action="append", default=[], help="order column for merging equal points")
    parser.add_argument("--even-slices", action="store_true", help="cut JDBC or resumable slices by row counts")
    parser.add_argument("--rejects", help="path for rows without a usable time")
    parser.add_argument("--column", action="append", default=[], help="copy this column and the others named so; default all")
    parser.add_argument("--decimal", choices=["long", "double"], default="long", help="what decimals become")
    parser.add_argument("--nested", choices=["json", "reject"], default="json", help="what arrays, maps and structs become")
    parser.add_argument("--compat", action="store_true", help="treat an end found in the data as exclusive, in milliseconds")
    again = parser.add_argument_group("going on after a failure (file targets)")
    again.add_argument("--resumable", action="store_true", help="copy slice by slice and note which are done")
    again.add_argument("--at-once", type=int, default=1, help="slices side by side")
    again.add_argument("--tasks-per-slice", type=int, default=1, help="connections for a JDBC slice")
    again.add_argument("--log-folder", help="where progress lines go")
    again.add_argument("--restarts", type=int, default=RESTART_ATTEMPTS)
    again.add_argument("--restart-delay", type=float, default=RESTART_DELAY_S)
    args = parser.parse_args(argv)
    if args.source_jdbc_url and not args.source_table:
        parser.error("--source-jdbc-url needs --source-table")
    if args.target_url and not (args.target_token_file and args.target_org and args.target_bucket):
        parser.error("--target-url needs --target-token-file, --target-org and --target-bucket")
    if args.resumable and not args.target_files:
        parser.error("--resumable needs --target-files; an endpoint takes equal points again without harm")
    return args


def options_of(args: argparse.Namespace) -> MoveOptions:
    return MoveOptions(
        measurement=args.measurement,
        ts_col=args.time_column,
        # An empty bound is an absent one.
        start=args.start_time or None,
        end=args.end_time or None,
        num_slices=args.parallelism,
        batch_size=args.batch_size,
        columns=(args.time_column, *(c for c in args.column if c != args.time_column)) if args.column else None,
        decimal=args.decimal,
        nested=args.nested,
        merge_by=tuple(args.merge_by),
        compat=args.compat,
        even_slices=args.even_slices,
        lenient=args.lenient,
    )


def run(args: argparse.Namespace) -> MoveReport | ResumeReport:
    spark = build_session(f"chronoferry: {args.measurement}")
    options = options_of(args)
    source = None
    if args.source_jdbc_url:
        source = JdbcSource(
            url=args.source_jdbc_url,
            table=args.source_table,
            user=args.source_username,
            password=_secret(args.source_password_file),
            driver=args.source_driver,
            ts_col=args.time_column,
            fetch_size=args.batch_size,
            quote=args.source_quote,
            literal=args.source_literal,
        )
    if args.resumable:
        how = {
            "compression": args.compression, "at_once": args.at_once, "log_folder": args.log_folder, "rejects": args.rejects,
        }

        def copy() -> ResumeReport:
            if source:
                return migrate_jdbc_resumable(
                    spark, source, args.target_files, options, tasks_per_slice=args.tasks_per_slice, **how
                )
            return migrate_resumable(read_files(spark, args.source_files, args.source_format), args.target_files, options, **how)

        return restarted(copy, args.restarts, args.restart_delay)
    rejects = (lambda rows: rows.write.mode("errorifexists").json(args.rejects)) if args.rejects else None
    if source:
        return migrate_jdbc(spark, source, sink_of(args), options, rejects)
    return migrate(read_files(spark, args.source_files, args.source_format), sink_of(args), options, rejects)


def sink_of(args: argparse.Namespace) -> Sink:
    if args.target_files:
        return line_files(args.target_files, args.compression, "overwrite" if args.overwrite else "errorifexists")
    return line_endpoint(
        args.target_url,
        _secret(args.target_token_file),
        args.target_org,
        args.target_bucket,
        args.batch_size,
        args.writers,
        gzip=args.gzip,
        max_retries=args.max_retries,
        retry_delay_s=args.retry_delay,
        max_delay_s=args.max_delay,
        backoff_base=args.backoff_base,
    )


def _secret(path: str | None) -> str | None:
    if path is None:
        return None
    with open(path, encoding="utf-8") as content:
        return content.read().strip()


def main(argv: list[str] | None = None) -> MoveReport | ResumeReport:
    report = run(arguments(argv))
    log.info("%s", report)
    print(asdict(report))
    return report


if __name__ == "__main__":
    main()
