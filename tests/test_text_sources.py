"""Text files in pieces, growing files, and lines read back as a table."""

import os
import random

import pytest
from pyspark.sql import functions as F
from support import plan_of

from chronoferry.functions.line import parse_lines, to_lines
from chronoferry.operators.points import layout_of_points, to_points
from chronoferry.sinks import line_files
from chronoferry.sources import pieces
from chronoferry.sources.growing import GrowingReader, growing_lines
from chronoferry.sources.lines import LineReader, scan_lines, split_line
from chronoferry.streaming import append_growing


@pytest.mark.parametrize("seed", range(20))
def test_any_cut_gives_every_line_once(tmp_path, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(pieces, "BLOCK", rng.choice([1, 3, 1000]))
    monkeypatch.setattr(pieces, "_LOOK_BACK", rng.choice([1, 4, 1000]))
    lines = ["x" * rng.choice([0, 1, 2, 7, 30]) + rng.choice(["", "é", "\r"]) for _ in range(rng.randint(0, 30))]
    whole = "".join(f"{line}\n" for line in lines)
    tail = rng.choice(["", "half"])
    path = tmp_path / "a.log"
    path.write_bytes((whole + tail).encode())
    system, _ = pieces.open_folder(str(tmp_path))
    size = path.stat().st_size
    edges = sorted({0, size, *(rng.randint(0, size) for _ in range(rng.randint(0, 6)))})
    for open_end in (False, True):
        read = []
        for a, b in zip(edges, edges[1:]):
            for piece in pieces.cut(str(path), a, b, open_end and b == size, rng.choice([1, 5, 100])):
                read += [line for some in pieces.read_lines(system, piece) for line in some]
        want = [line.removesuffix("\r") for line in lines] + ([tail] if open_end and tail else [])
        assert [line.decode() for line in read] == want


def test_sizes_leave_out_hidden_names(tmp_path):
    for name in ("a.log", "b.txt", "_c.log", ".d.log", "sub/e.log", "_hid/f.log"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("12345")
    assert sorted(pieces.sizes(str(tmp_path), "*.log")) == [f"{tmp_path}/a.log", f"{tmp_path}/sub/e.log"]
    assert pieces.sizes(f"file://{tmp_path}/b.txt") == {f"{tmp_path}/b.txt": 5}
    assert pieces.sizes(str(tmp_path / "none")) == {}


def test_growing_files(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "1.log").write_text("good\nan Error\nbad WA")
    (logs / "1.log.old").write_text("an old error\n")

    def run():
        append_growing(spark, str(logs), "(?i)error|warn", f"{tmp_path}/out", f"{tmp_path}/cp", names="*.log").awaitTermination()
        return sorted(r.value for r in spark.read.text(f"{tmp_path}/out").collect())

    assert run() == ["an Error"]
    assert run() == ["an Error"]
    with open(logs / "1.log", "a") as file:
        file.write("RN\nfine\nno error yet")
    (logs / "2.log").write_text("WARN two\r\n")
    assert run() == ["WARN two", "an Error", "bad WARN"]
    with open(logs / "1.log", "a") as file:
        file.write("\n")
    assert run() == ["WARN two", "an Error", "bad WARN", "no error yet"]
    # A file that is shorter now was begun anew.
    (logs / "2.log").write_text("error\n")
    assert run() == ["WARN two", "an Error", "bad WARN", "error", "no error yet"]


def test_growing_folder_that_is_not_there_yet(spark, tmp_path):
    reader = GrowingReader({"path": str(tmp_path / "none")})
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []
    assert growing_lines(spark, str(tmp_path / "none")).columns == ["file", "value"]


def test_large_additions_are_many_pieces(tmp_path):
    reader = GrowingReader({"path": str(tmp_path)})
    parts = reader.partitions({"a": 10}, {"a": 10 + 3 * pieces.PIECE_BYTES, "b": 5, "c": 0})
    assert [(p.path, p.start, p.end) for p in parts] == [
        *(("a", 10 + k * pieces.PIECE_BYTES, 10 + (k + 1) * pieces.PIECE_BYTES) for k in range(3)), ("b", 0, 5)]


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_lines_are_read_as_they_were_written(spark, tmp_path):
    texts = ["plain", "a b", "a,b=c", "\\", "\\\\", "\\,", "a\\", " \\= ", "é", "x\\ny", '"', "", None, ",", "=", "\\\\ \\"]
    rows = [(k * 1000, t, u, k, k * 0.5 if k % 3 else None) for k, t in enumerate(texts) for u in ("t", t)]
    frame = spark.createDataFrame(rows, "ms bigint, `tag, one` string, `t=2` string, `whole number` bigint, double double")
    frame = frame.withColumn("ts", F.timestamp_millis("ms")).drop("ms")
    built = to_points(frame, "a measurement, all")
    line_files(str(tmp_path / "out"))(to_lines(built))
    layout = layout_of_points(built)
    got = scan_lines(spark, str(tmp_path / "out"), layout)
    want = parse_lines(spark.read.schema("line string").text(str(tmp_path / "out")), layout)
    assert rows_of(got) == rows_of(want.select("measurement", "ts_ms", "tags.*", "fields.*"))
    assert got.count() == len(rows)


def test_time_filters_reach_the_reader(spark, events, tmp_path):
    built = to_points(events, "e")
    line_files(str(tmp_path / "out"))(to_lines(built.repartition(3)))
    layout = layout_of_points(built)
    got = scan_lines(spark, str(tmp_path / "out"), layout)
    lo, hi = (r.ms for r in built.selectExpr("percentile_approx(ts_ms, 0.3) AS ms").union(built.selectExpr("percentile_approx(ts_ms, 0.6)")).collect())
    for test in (f"ts_ms >= {lo} AND ts_ms < {hi}", f"ts_ms > {lo}", f"ts_ms <= {hi}", f"ts_ms = {lo}", f"ts_ms > {hi} AND ts_ms < {lo}", f"ts_ms >= {lo} AND value > 50"):
        part = got.where(test)
        assert part.count() == built.select("ts_ms", "fields.value").where(test).count(), test
    within = got.where(f"ts_ms >= {lo} AND ts_ms < {hi}")
    assert str(lo) not in plan_of(within)  # nothing is left to filter
    shown = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(within._jdf.queryExecution(), "formatted")
    pushed = next(line for line in shown.splitlines() if "PushedFilters" in line)
    assert str(lo) in pushed and str(hi) in pushed


def test_lines_outside_are_not_parsed(spark, events, tmp_path, monkeypatch):
    """The reader alone, since tasks run in other processes."""
    from pyspark.sql.datasource import GreaterThanOrEqual, IsNotNull, LessThan

    from chronoferry.sources import lines as module

    path = tmp_path / "a"
    path.write_text("".join(f"m,t=x v={k}i {k}\n" for k in range(100)))
    schema = spark.createDataFrame([], "measurement string, ts_ms bigint, t string, v bigint").schema
    reader = LineReader({"path": str(path)}, schema)
    left = list(reader.pushFilters([IsNotNull(("ts_ms",)), GreaterThanOrEqual(("ts_ms",), 10), LessThan(("ts_ms",), 20), GreaterThanOrEqual(("v",), 1)]))
    assert [type(f).__name__ for f in left] == ["IsNotNull", "GreaterThanOrEqual"]
    parsed = []
    monkeypatch.setattr(module, "split_line", lambda line: parsed.append(line) or split_line(line))
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert len(parsed) == sum(b.num_rows for b in batches) == 10
    assert batches[0].column("v").to_pylist() == list(range(10, 20))


def test_what_cannot_be_read_is_refused(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(b"x")
    schema = spark.createDataFrame([], "measurement string, ts_ms bigint, v bigint").schema
    with pytest.raises(ValueError, match="compressed"):
        LineReader({"path": str(tmp_path)}, schema).partitions()
    assert os.listdir(tmp_path) == ["a.gz"]
