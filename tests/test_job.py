import json

import pytest
from pyspark.sql import functions as F
from support import SMALL

from chronoferry import job
from chronoferry.operators.ranges import TimeRange


def test_files_to_files(spark, events, tmp_path):
    out = str(tmp_path / "lines")
    report = job.main(
        ["--source-files", f"{SMALL}/events.parquet", "--target-files", out, "--measurement", "e",
         "--start-time", "2024-01-08 00:00:00.000", "--end-time", "", "--parallelism", "3"]
    )
    assert report.written == spark.read.text(out).count() == events.where("ts >= '2024-01-08'").count()
    assert len(report.slices) == 3


def test_rejects_and_merge(spark, lineitem, tmp_path):
    lineitem.withColumn("l_shipdate", F.when(F.col("l_tax") > 0.01, F.col("l_shipdate"))).write.parquet(str(tmp_path / "in"))
    report = job.main(
        ["--source-files", str(tmp_path / "in"), "--target-files", str(tmp_path / "out"), "--measurement", "l",
         "--time-column", "l_shipdate", "--merge-by", "l_orderkey", "--merge-by", "l_linenumber",
         "--merge-by", "l_partkey", "--merge-by", "l_suppkey", "--rejects", str(tmp_path / "rejects")]
    )
    rejected = spark.read.json(str(tmp_path / "rejects"))
    assert report.rejected == rejected.count() == lineitem.where("l_tax <= 0.01").count()
    assert report.read == lineitem.where("l_tax > 0.01").count() and report.merged > 0
    assert json.loads(rejected.first().row_json)["l_shipdate"] is None


def test_jdbc_arguments(spark, events, tmp_path, monkeypatch):
    (tmp_path / "pw").write_text("secret\n")
    seen = []

    def stub(spark, source, sink, options, rejects):
        seen.append((source, options))
        return job.MoveReport(TimeRange(0, 1))

    monkeypatch.setattr(job, "migrate_jdbc", stub)
    job.main(
        ["--source-jdbc-url", "jdbc:x://h/d", "--source-table", "d.t", "--source-username", "u",
         "--source-password-file", str(tmp_path / "pw"), "--target-url", "http://t", "--target-token-file",
         str(tmp_path / "pw"), "--target-org", "o", "--target-bucket", "b", "--measurement", "m"]
    )
    source, options = seen[0]
    assert (source.user, source.password, source.fetch_size) == ("u", "secret", 2000)
    assert (options.num_slices, options.batch_size, options.start) == (8, 2000, None)


@pytest.mark.parametrize(
    "argv",
    [
        [],
        ["--source-files", "x", "--measurement", "m"],
        ["--source-jdbc-url", "x", "--target-files", "y", "--measurement", "m"],
        ["--source-files", "x", "--target-url", "y", "--measurement", "m"],
        ["--source-files", "x", "--target-files", "y"],
        ["--source-files", "x", "--target-url", "u", "--target-token-file", "t", "--target-org", "o", "--target-bucket", "b",
         "--measurement", "m", "--resumable"],
        ["--source-files", "x", "--target-files", "y", "--measurement", "m", "--decimal", "text"],
    ],
)
def test_missing_arguments(argv, capsys):
    with pytest.raises(SystemExit):
        job.arguments(argv)


def test_resumable_job_with_its_options(spark, events, tmp_path):
    out, notes = str(tmp_path / "out"), str(tmp_path / "logs")
    command = ["--source-files", f"{SMALL}/events.parquet", "--target-files", out, "--measurement", "e", "--resumable",
               "--parallelism", "4", "--batch-size", "10", "--at-once", "2", "--log-folder", notes, "--compression", "gzip",
               "--column", "value", "--column", "event_type", "--even-slices", "--restart-delay", "0"]
    report = job.main(command)
    assert report.copied == (0, 1, 2, 3) and report.written == events.count()
    assert job.main(command).copied == ()
    lines = spark.read.text(out)
    assert lines.count() == events.count() and "user_id" not in lines.first().value
    assert spark.read.text(notes).where("value LIKE '%Completed%'").count() == 4
    with pytest.raises(ValueError, match="other options: compat"):
        job.main([*command, "--compat", "--restarts", "0"])


def test_sink_options(tmp_path, monkeypatch):
    (tmp_path / "token").write_text("t")
    seen = {}
    monkeypatch.setattr(job, "line_endpoint", lambda *a, **o: seen.update(o, writers=a[5]))
    job.sink_of(job.arguments(
        ["--source-files", "x", "--target-url", "http://t", "--target-token-file", str(tmp_path / "token"), "--target-org", "o",
         "--target-bucket", "b", "--measurement", "m", "--writers", "7", "--max-retries", "2", "--retry-delay", "0.5", "--gzip"]
    ))
    assert seen == {"writers": 7, "gzip": True, "max_retries": 2, "retry_delay_s": 0.5, "max_delay_s": 30.0, "backoff_base": 2.0}
