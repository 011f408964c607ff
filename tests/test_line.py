import datetime as dt
import re

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from support import plan_of
from pyspark.sql import functions as F

from chronoferry.functions.line import escape_column, escape_text, parse_lines, to_lines
from chronoferry.operators.points import layout_of_points, to_points

AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
MS = 1_704_067_200_000


def lines(df, measurement="m"):
    return [r.line for r in to_lines(to_points(df, measurement)).collect()]


def test_names_and_values_are_escaped(spark):
    df = spark.createDataFrame([(AT, "a,b=c d", 1)], "ts timestamp, `t,a=g s` string, `f,i=e d` int")
    assert lines(df, "m,e=a s") == [
        rf"m\,e=a\ s,t\,a\=g\ s=a\,b\=c\ d f\,i\=e\ d=1i {MS}"
    ]


def test_special_tag_values(spark):
    values = ["", None, "ünï", 'say "hi"', "two\nlines\r\there", "C:\\dir", "ends\\", "a\\,b", "a\\\\ b"]
    df = spark.createDataFrame([(AT, v, i) for i, v in enumerate(values)], "ts timestamp, t string, n int")
    got = {int(re.search(r" n=(\d+)i", line).group(1)): line.rsplit(" n=", 1)[0] for line in lines(df)}
    assert got == {
        0: "m",
        1: "m",
        2: "m,t=ünï",
        3: 'm,t=say\\ "hi"',
        4: "m,t=two\\nlines\\r\\there",
        5: "m,t=C:\\dir",
        6: "m,t=ends\\\\",
        7: "m,t=a\\\\\\,b",
        8: "m,t=a\\\\\\\\\\ b",
    }


def test_doubles(spark):
    values = [1.5, -0.0, 1e10, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(AT, v) for v in values], "ts timestamp, v double")
    assert lines(df) == [f"m v=1.5 {MS}", f"m v=-0.0 {MS}", f"m v=1.0E10 {MS}"]
    with_int = df.withColumn("n", F.lit(3))
    assert lines(with_int)[3:] == [f"m n=3i {MS}"] * 4


def test_tags_and_fields_stand_in_name_order(spark):
    df = spark.createDataFrame([(AT, 1, "x", 2.5, "y", 3)], "ts timestamp, z int, b string, m double, a string, c int")
    assert lines(df) == [f"m,a=y,b=x c=3i,m=2.5,z=1i {MS}"]


def test_a_table_without_fields_has_no_lines(spark):
    df = spark.createDataFrame([(AT, "x")], "ts timestamp, t string")
    assert lines(df) == []
    assert lines(spark.createDataFrame([(AT,)], "ts timestamp")) == []


# Line breaks and tabs are written as two characters and stay so; surrogates are no text.
texts = st.lists(
    st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\n\r\t\0"), min_size=1, max_size=12)
    | st.text(st.sampled_from(list("\\,= ab")), min_size=1, max_size=8),
    min_size=40,
    max_size=80,
)


@settings(max_examples=8, deadline=None, phases=[Phase.generate])
@given(texts, texts)
def test_lines_parse_back_to_the_point(spark, tags, others):
    rows = [(AT, a, b, i, i * 0.37) for i, (a, b) in enumerate(zip(tags, others))]
    df = spark.createDataFrame(rows, "ts timestamp, `tag one` string, b string, `n=1` int, x double")
    points = to_points(df, "some, measurement")
    back = parse_lines(to_lines(points), layout_of_points(points))
    key = lambda r: r.fields["n=1"]
    assert sorted(back.collect(), key=key) == sorted(points.collect(), key=key)


@settings(max_examples=5, deadline=None, phases=[Phase.generate])
@given(texts)
def test_names_and_columns_escape_alike(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", escape_column(F.col("v")).alias("e")).collect():
        assert r.e == escape_text(r.v)


def test_absent_members_parse_to_null(spark):
    df = spark.createDataFrame([(AT, None, 1, None), (AT, "t", None, 2.0)], "ts timestamp, t string, n int, v double")
    points = to_points(df, "m")
    back = parse_lines(to_lines(points), layout_of_points(points))
    assert back.exceptAll(points).count() == 0 and back.count() == 2


def test_values_are_formatted_once(events):
    plan = plan_of(to_lines(to_points(events, "events")))
    condition = re.search(r"Filter (.*)", plan).group(1)
    assert "concat" not in condition


def test_long_texts_with_many_escapes(spark):
    text = "word, = \\ " * 50_000
    df = spark.createDataFrame([(AT, text, 1)], "ts timestamp, t string, n int")
    points = to_points(df, "m")
    (back,) = parse_lines(to_lines(points), layout_of_points(points)).collect()
    assert back.tags.t == text
