"""Numbered pages of a table in time order.

A plain copy needs none of this. It serves users who want the batches that a
paged read would hand out: page `k` of a slice holds its rows `k*size` to
`(k+1)*size - 1` in the order of the time column and the given keys. The keys
must make the order total, otherwise a page is not well defined.

A window over a slice would sort the slice in one task. Here the order is cut into
groups by bounds out of a hashed sample of it, which is the same whenever it is taken;
rows are counted per group, and a row's number is its place in its group plus the rows
of the groups in front. So a slice, or even a single instant, that holds much of the
table is spread over many tasks, and no rows are stored on the way.

Inside, a row is its slice `s`, its order `o` (time and keys) and its record `r`, so no
column of the table can clash with a helper.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

from chronoferry.config import DEFAULT_BATCH_SIZE, ship_package, use_checkpoints
from chronoferry.functions.columns import named, time_value
from chronoferry.functions.timestamps import epoch_ms, epoch_us
from chronoferry.operators.progress import slice_totals
from chronoferry.operators.ranges import TimeRange, in_range
from chronoferry.operators.slices import slice_of, whole_div

# A page is looked for in this many time slices, and in as many of the slices found, and so on.
FETCH_SLICES = 1000

# Groups for each shuffle partition; several even out what the sample misjudges.
GROUPS_PER_PARTITION = 4

# A group is not made smaller than this by default: it is what one task sorts without effort.
GROUP_ROWS = 50_000

# Sampled rows for each group.
SAMPLE_PER_GROUP = 30


def fetch_page(
    df: DataFrame, rng: TimeRange | None, ts_col: str, keys: list[str], limit: int, offset: int
) -> DataFrame:
    """Rows `offset` to `offset + limit - 1` of the range in `(time, keys)` order, all columns.

    `ORDER BY ... LIMIT` over the whole range would send `offset + limit` rows of
    every task to a single one. So rows are counted per time slice, from the time column
    alone, and the slices that the page touches are cut again until they get no
    narrower. The times and keys of that stretch are numbered, and the rows of the
    page are read by them.
    """
    before = held = 0
    stretch = rng
    while stretch is not None:
        found = _slices_of_page(df, stretch, ts_col, limit, offset - before)
        if found is None:
            stretch = None
            break
        narrower, ahead, held = found
        before += ahead
        if narrower == stretch or held < 2 * limit:
            stretch = narrower
            break
        stretch = narrower
    if stretch is None:
        return in_range(df, None, ts_col)
    numbered = _numbered(_rows(df, stretch, ts_col, keys, 1), _sampled_guide(_rows(df, stretch, ts_col, keys, 1), held))
    page = numbered.where((F.col("rn") >= offset - before) & (F.col("rn") < offset - before + limit)).select("o")
    rows = _rows(df, stretch, ts_col, keys, 1, record=True)
    return rows.join(page, rows["o"].eqNullSafe(page["o"]), "left_semi").select("r.*")


def _slices_of_page(
    df: DataFrame, rng: TimeRange, ts_col: str, limit: int, offset: int
) -> tuple[TimeRange, int, int] | None:
    """The stretch of time that holds a page, the rows before it, and the rows in it."""
    totals = slice_totals(df, rng, ts_col, FETCH_SLICES)
    # One row per slice, so this window without partitions is small whatever the table holds.
    upto = F.sum("total").over(Window.orderBy("part_id"))
    row = (
        totals.withColumn("upto", upto)
        .withColumn("before", F.col("upto") - F.col("total"))
        .where((F.col("upto") > offset) & (F.col("before") < offset + limit) & (F.col("total") > 0))
        .agg(F.min("lo_us"), F.max("hi_us"), F.min("before"), F.sum("total"))
        .first()
    )
    return None if row[0] is None else (TimeRange(row[0], row[1]), row[2], row[3])


def number_rows(
    df: DataFrame, rng: TimeRange | None, ts_col: str, keys: list[str], num_slices: int, batch_size: int
) -> DataFrame:
    """Rows of the range with `part_id`, `rn` (from 0 in every slice) and `page_no`."""
    added = {"part_id": F.col("s"), "rn": F.col("rn"), "page_no": whole_div(F.col("rn"), batch_size)}
    taken = sorted(added.keys() & set(df.columns))
    if taken:
        raise ValueError(f"the table already has columns named {taken}; page_batches keeps records apart from them")
    guide = _sampled_guide(_rows(df, rng, ts_col, keys, num_slices))
    numbered = _numbered(_rows(df, rng, ts_col, keys, num_slices, record=True), guide)
    return numbered.select("r.*", *(value.alias(name) for name, value in added.items()))


def page_index(
    df: DataFrame,
    rng: TimeRange | None,
    ts_col: str = "ts",
    keys: list[str] | None = None,
    num_slices: int = 8,
    batch_size: int = DEFAULT_BATCH_SIZE,
    group_rows: int | None = None,
) -> DataFrame:
    """`part_id, page_no, n, first_ms, last_ms` of every page; only time and keys are read."""
    narrow = _rows(df, rng, ts_col, _required(keys), num_slices)
    ms = epoch_ms(F.col("o.t"))
    return (
        _numbered(narrow, _sampled_guide(narrow, group_rows=group_rows))
        .groupBy(F.col("s").alias("part_id"), whole_div(F.col("rn"), batch_size).alias("page_no"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms"))
    )


def page_batches(
    df: DataFrame,
    rng: TimeRange | None,
    ts_col: str = "ts",
    keys: list[str] | None = None,
    num_slices: int = 8,
    batch_size: int = DEFAULT_BATCH_SIZE,
    group_rows: int | None = None,
) -> DataFrame:
    """`part_id, page_no, batch`: the records of each page as one ordered array of structs.

    An array never holds more than `batch_size` records. Times and keys are numbered first, so that
    groups can begin where pages do; whole rows then move once, to the task of their group, which
    numbers them and builds its pages.
    """
    keys = _required(keys)
    narrow = _rows(df, rng, ts_col, keys, num_slices)
    total = narrow.count()
    size = max(1, -(-total // (_groups(df, total, group_rows) * batch_size))) * batch_size
    guide = _page_guide(_numbered(narrow, _sampled_guide(narrow, total, group_rows)), size, max(1, -(-total // size)))
    numbered = _numbered(_rows(df, rng, ts_col, keys, num_slices, record=True), guide)
    return (
        numbered.groupBy("s", "g", whole_div(F.col("rn"), batch_size).alias("page_no"))
        .agg(F.array_sort(F.collect_list(F.struct("rn", "r"))).alias("numbered"))
        .select(F.col("s").alias("part_id"), "page_no", F.transform("numbered", lambda x: x["r"]).alias("batch"))
    )


def first_pages(
    df: DataFrame, rng: TimeRange, ts_col: str, keys: list[str], size: int, most: int, total: int | None = None
) -> tuple[DataFrame, Row | None]:
    """The first `most` pages of a range, all columns and `page_no` from 0, and the last row in them: its time
    `at` in microseconds and its `keys` as text, or None if no rows follow.

    A page ends with the row that makes it `size` rows long, and with all that time and keys don't tell apart
    from it. Where no end has such rows, a row's number says its page. Otherwise every page depends on the one
    before: see `_cut_groups`. `total` is the number of rows in the range, if it is known.
    """
    if "page_no" in df.columns:
        raise ValueError("the table already has a column named page_no; page_batches keeps records apart from it")
    narrow = _rows(df, rng, ts_col, keys, 1)
    guide = _sampled_guide(narrow, total)
    rows = _rows(df, rng, ts_col, keys, 1, record=True)
    group = _in_group(narrow)
    number = F.col("start") + F.row_number().over(group) - 1
    # True for a row that is followed by one like it; groups never part these.
    marks = _started(narrow, guide).select(
        "g", "o", number.alias("rn"), F.lead("o").over(group).eqNullSafe(F.col("o")).alias("tied")
    )
    # The ends of pages, if no rows are alike, and the row after the last of them.
    few = marks.where((F.col("rn") % size == size - 1) | (F.col("rn") == most * size))
    end = few.agg(
        F.count_if(F.col("tied") & (F.col("rn") % size == size - 1)).alias("tied"),
        F.max(F.when(F.col("rn") == most * size - 1, F.col("o"))).alias("last"),
        F.max("rn").alias("rn"),
    ).select("tied", "rn", *_place_of("last", keys)).first()
    if not end["tied"]:
        page_no = whole_div(F.col("rn"), size)
        paged = _numbered(rows, guide).where(F.col("rn") < most * size)
        return paged.select("r.*", page_no.alias("page_no")), end if (end["rn"] or 0) >= most * size else None
    cuts = _cut_groups(marks, size)
    paged = _cut(narrow, guide, cuts)
    end = paged.where(F.col("page_no") >= most - 1).agg(
        F.max(F.when(F.col("page_no") < most, F.col("o"))).alias("last"), F.max("page_no").alias("rn")
    ).select("rn", *_place_of("last", keys)).first()
    page = _cut(rows, guide, cuts).where(F.col("page_no") < most).select("r.*", "page_no")
    return page, end if (end["rn"] or 0) >= most else None


def _place_of(order: str, keys: list[str]) -> list[Column]:
    texts = F.array(*(F.col(order)[f"k{i}"].cast("string") for i in range(len(keys))))
    return [epoch_us(F.col(order)["t"]).alias("at"), texts.alias("keys")]


def _cut(rows: DataFrame, guide: _Guide | None, cuts: DataFrame) -> DataFrame:
    """Rows with `page_no`, by the ends of pages in their group: those that are at or before their like."""
    before = F.col("start") + F.rank().over(_in_group(rows)) - 1
    ranked = _started(rows, guide).withColumn("before", before)
    # One row for each group.
    found = ranked.join(F.broadcast(cuts), "g")
    return found.withColumn("page_no", F.col("page") + F.size(F.filter("ends", lambda e: e <= F.col("before"))))


def _cut_groups(marks: DataFrame, size: int) -> DataFrame:
    """`g, page, ends`: the page that is open before each group, and the numbers of rows up to the ends in it.

    A group doesn't know how full the page is that it begins in. So it says for each number of rows in it, below
    `size`, how many it leaves in the open page and how many pages it ends; the driver follows these from group to
    group, one at a time, and each group then cuts its pages.
    """
    spark = marks.sparkSession
    use_checkpoints(spark)
    ship_package(spark)
    upto = F.sort_array(F.collect_list(F.when(~F.col("tied"), F.col("rn") + 1)))
    groups = marks.groupBy("g").agg(F.min("rn").alias("front"), upto.alias("upto")).checkpoint()

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, front, upto in _groups_of(batches):
            begins, ended = front - np.arange(size), np.zeros(size, np.int64)
            while True:
                at = np.searchsorted(upto, begins + size)
                hit = at < len(upto)
                if not hit.any():
                    break
                begins[hit] = upto[at[hit]]
                ended[hit] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([g], pa.int32()), pa.array([upto[-1] - begins], pa.list_(pa.int64())), pa.array([ended], pa.list_(pa.int64()))],
                ["g", "open", "ended"],
            )

    entries, held, page = [], 0, 0
    for row in groups.mapInArrow(answers, "g int, open array<long>, ended array<long>").orderBy("g").toLocalIterator():
        entries.append((row.g, held, page))
        held, page = row.open[held], page + row.ended[held]

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, front, upto in _groups_of(batches):
            held, page = entry[g]
            ends, begin = [], front - held
            while (at := int(np.searchsorted(upto, begin + size))) < len(upto):
                begin = int(upto[at])
                ends.append(begin)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g], pa.int32()), pa.array([page], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], ["g", "page", "ends"]
            )

    entry = {g: (held, page) for g, held, page in entries}
    return groups.mapInArrow(cuts, "g int, page long, ends array<long>")


def _groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch["g"][k].as_py(), batch["front"][k].as_py(), batch["upto"][k].values.to_numpy()


def explode_batches(batches: DataFrame) -> DataFrame:
    """The records of batches as rows again."""
    return batches.select(F.inline("batch"))


def _rows(
    df: DataFrame, rng: TimeRange | None, ts_col: str, keys: list[str], num_slices: int, record: bool = False
) -> DataFrame:
    """Rows of the range as slice, order and, if asked, record."""
    ts = time_value(df, ts_col)
    part = F.lit(0) if rng is None else slice_of(epoch_us(ts), rng, num_slices)
    order = F.struct(ts.alias("t"), *(named(k).alias(f"k{i}") for i, k in enumerate(keys)))
    records = [F.struct(*(named(c) for c in df.columns)).alias("r")] if record else []
    return in_range(df, rng, ts_col).select(part.cast("bigint").alias("s"), order.alias("o"), *records)


def _groups(df: DataFrame, total: int, group_rows: int | None = None) -> int:
    most = GROUPS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, -(-total // (group_rows or GROUP_ROWS))))


@dataclass(frozen=True)
class _Guide:
    """Groups of every slice: `s, bounds, starts`, one row per slice.

    `bounds` are the orders at which a next group begins, `starts` the groups that have rows, each with the
    rows in front of it. There are about as many as groups are wanted. Looking up takes `depth` steps; what
    would need more of them stays in the last group that they reach.
    """

    table: DataFrame
    depth: int


def _sampled_guide(narrow: DataFrame, total: int | None = None, group_rows: int | None = None) -> _Guide | None:
    """Groups of about equal size, by a sample with SAMPLE_PER_GROUP rows for each; none where a slice is one group."""
    total = narrow.count() if total is None else total
    wanted = _groups(narrow, total, group_rows)
    if wanted == 1:
        return None
    use_checkpoints(narrow.sparkSession)
    rate = max(1, total // (wanted * SAMPLE_PER_GROUP))
    sample = narrow.where(F.pmod(F.xxhash64("o"), F.lit(rate)) == 0)
    thinned = F.filter(
        F.sort_array(F.collect_list("o")), lambda _, i: i % SAMPLE_PER_GROUP == SAMPLE_PER_GROUP - 1
    )
    bounds = sample.groupBy("s").agg(thinned.alias("bounds")).checkpoint()
    depth = (2 * wanted).bit_length()
    counts = _grouped(narrow.select("s", "o"), _Guide(bounds, depth)).groupBy("s", "g").agg(F.count(F.lit(1)).alias("n"))
    front = F.sum("n").over(Window.partitionBy("s").orderBy("g")) - F.col("n")
    starts = counts.select("s", "g", front.alias("front")).groupBy("s").agg(
        F.sort_array(F.collect_list(F.struct("g", "front"))).alias("starts")
    )
    return _Guide(starts.join(bounds, "s", "left").select("s", "bounds", "starts").checkpoint(), depth)


def _page_guide(numbered: DataFrame, size: int, wanted: int) -> _Guide | None:
    """Groups of exactly `size` rows: `wanted` of them, if all are in one slice."""
    if wanted == 1:
        return None
    first = numbered.where((F.col("rn") % size == 0) & (F.col("rn") > 0))
    bounds = first.groupBy("s").agg(F.sort_array(F.collect_list("o")).alias("bounds"))
    every = F.sequence(F.lit(0), F.size("bounds"))
    starts = F.transform(every, lambda g: F.struct(g.alias("g"), (g.cast("bigint") * size).alias("front")))
    return _Guide(bounds.select("s", "bounds", starts.alias("starts")).checkpoint(), wanted.bit_length())


def _grouped(rows: DataFrame, guide: _Guide | None) -> DataFrame:
    """Rows with the number `g` of their group in their slice: how many bounds they have reached."""
    if guide is None:
        return rows.withColumn("g", F.lit(0))
    # One row per slice and about one bound per group: bounded by the session's settings.
    found = rows.join(F.broadcast(guide.table), "s", "left").withColumn("g", F.lit(0))
    for step in (1 << k for k in reversed(range(guide.depth))):
        # Beyond the last bound there is NULL, which is not reached.
        reached = F.get("bounds", F.col("g") + (step - 1)) <= F.col("o")
        found = found.withColumn("g", F.when(reached, F.col("g") + step).otherwise(F.col("g")))
    return found.drop("bounds")


def _started(rows: DataFrame, guide: _Guide | None) -> DataFrame:
    """Rows with `g` and `start`, the number of rows in front of their group."""
    start = F.lit(0).cast("bigint")
    if guide is not None:
        # The first group has no rows if its slice begins with a bound; no other is empty.
        start = F.coalesce(F.get("starts", F.col("g") - F.col("starts")[0]["g"])["front"], start)
    return _grouped(rows, guide).select(*rows.columns, "g", start.alias("start"))


def _in_group(rows: DataFrame) -> WindowSpec:
    # By its members and not as a struct, whose comparison takes longer.
    return Window.partitionBy("s", "g").orderBy(*(f"o.{name}" for name in rows.schema["o"].dataType.fieldNames()))


def _numbered(rows: DataFrame, guide: _Guide | None) -> DataFrame:
    """Rows with `g` and with `rn`, their number in their slice; they move once, to the task of their group."""
    place = F.row_number().over(_in_group(rows)) - 1
    return _started(rows, guide).withColumn("rn", F.col("start") + place).drop("start")


def _required(keys: list[str] | None) -> list[str]:
    if not keys:
        raise ValueError("pages need tie-breaking keys that make the row order total")
    return keys
