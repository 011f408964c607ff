import pytest
from support import SMALL
from transports import bodies

from chronoferry.functions.line import to_lines
from chronoferry.operators.points import to_points
from chronoferry.plans import queries
from chronoferry.streaming import append_matches, copy_to_endpoint, copy_to_files, run_to_end, stream_files


@pytest.fixture()
def folder(events, tmp_path):
    events.repartition(5).write.parquet(str(tmp_path / "in"))
    return tmp_path


def points_stream(spark, events, folder, **how):
    return to_points(stream_files(spark, str(folder / "in"), events.schema, **how), "events")


def test_copy_in_several_batches_equals_the_batch_job(spark, events, folder):
    stream = points_stream(spark, events, folder, files_per_batch=2)
    query = copy_to_files(stream, str(folder / "out"), str(folder / "checkpoint"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    got = spark.read.parquet(str(folder / "out"))
    expected = to_points(events, "events")
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()


def test_a_second_run_copies_only_what_is_new(spark, events, folder):
    def run():
        stream = points_stream(spark, events, folder)
        run_to_end(lambda: copy_to_files(to_lines(stream), str(folder / "out"), str(folder / "checkpoint"), "text"))
        return spark.read.text(str(folder / "out")).count()

    assert run() == run() == events.count()
    events.limit(7).write.mode("append").parquet(str(folder / "in"))
    assert run() == events.count() + 7


def test_a_failed_run_goes_on_from_its_checkpoint(spark, events, folder):
    attempts = []

    def start():
        attempts.append(1)
        if len(attempts) == 1:
            raise RuntimeError("lost")
        stream = points_stream(spark, events, folder)
        return copy_to_files(stream, str(folder / "out"), str(folder / "checkpoint"))

    run_to_end(start, attempts=3, delay_s=0)
    assert len(attempts) == 2 and spark.read.parquet(str(folder / "out")).count() == events.count()
    with pytest.raises(RuntimeError):
        run_to_end(lambda: (_ for _ in ()).throw(RuntimeError("always")), attempts=2, delay_s=0)


def test_stream_to_an_endpoint(spark, events, folder):
    target = folder / "target"
    query = copy_to_endpoint(
        points_stream(spark, events, folder, files_per_batch=3),
        str(folder / "checkpoint"),
        transport="transports:Folder",
        url=str(target),
        batch_size=20,
        retry_delay_s=0,
        fail_sends=2,
    )
    query.awaitTermination()
    assert sorted(sum(bodies(target), [])) == sorted(r.line for r in to_lines(to_points(events, "events")).collect())


def test_followed_logs_are_appended_once(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "1.log").write_text("good\nan Error\nbad WARN\n")

    def run():
        append_matches(spark, str(logs), "(?i)error|warn", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())

    assert run() == ["an Error", "bad WARN"]
    (logs / "2.log").write_text("another error\nfine\n")
    assert run() == ["an Error", "another error", "bad WARN"]
    assert run() == ["an Error", "another error", "bad WARN"]


def test_files_of_a_merged_stream_do_not_grow_with_the_table(spark, monkeypatch):
    expected = queries.QUERIES["stream_merge"](spark, SMALL).exceptAll
    made = []
    monkeypatch.setattr(queries, "STREAM_FILE_ROWS", 300)
    monkeypatch.setattr(queries, "stream_files", lambda s, path, *a, **how: made.append((path, how)) or stream_files(s, path, *a, **how))
    got = queries.QUERIES["stream_merge"](spark, SMALL)
    assert expected(got).count() == 0
    path, how = made[0]
    counts = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]
    assert how["files_per_batch"] > 2 and max(counts) <= 400
