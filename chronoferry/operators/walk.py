"""Pages by key: each page begins where the last one ended, whatever lies before it.

An offset has to be counted; a token says the last row's time and keys. The next page is looked for in
a stretch of time after it that held a page before, and in a wider one if it holds less. So a page reads a
pruned range of the table, and the millionth costs what the first one does.

A page at a time takes jobs for each page. Who walks a whole table asks for many pages after a token at once: they
are cut in one sort of their stretch.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.config import DEFAULT_BATCH_SIZE
from chronoferry.functions.columns import named, time_value
from chronoferry.functions.timestamps import epoch_us
from chronoferry.operators.paging import first_pages
from chronoferry.operators.progress import slice_totals
from chronoferry.operators.ranges import TimeRange, between, in_range

# The first page is looked for in this part of the range.
FIRST_PART = 1000
# Many pages are looked for in as many slices of the range.
SLICES = 1000
# A stretch is this much wider than the last page was, and this much wider again when it held too little.
ROOM, WIDEN = 2, 8


@dataclass(frozen=True)
class PageToken:
    """The last row of a page: its time, its keys as text, and how much time the page took up."""

    ts_us: int
    keys: tuple[str | None, ...]
    span_us: int

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def parse(text: str) -> PageToken:
        values = json.loads(text)
        return PageToken(values["ts_us"], tuple(values["keys"]), values["span_us"])


def page_after(
    df: DataFrame,
    rng: TimeRange | None,
    ts_col: str,
    keys: list[str],
    limit: int = DEFAULT_BATCH_SIZE,
    token: PageToken | None = None,
    pages: int | None = None,
) -> tuple[DataFrame, PageToken | None]:
    """The next `limit` rows in the order of time and keys, and the token for those after them; None if there are none.

    Finding a page sorts times and keys of its stretch alone, and keeps `limit` of them in each task. The page
    itself is a filter over the table. Rows are not sorted in it, and rows with equal time and keys, which
    make no total order, come together: such a page is longer. NULL keys come first.

    With `pages`, the next that many pages come at once, each row with the number of its page among them, from 0,
    in the column `page_no`; the token is that of the last one.
    """
    if rng is None:
        none = in_range(df, None, ts_col)
        return none if pages is None else none.withColumn("page_no", F.lit(0).cast("bigint")), None
    order = _order(df, ts_col, keys)
    after = None if token is None else order > _place(df, ts_col, keys, token)
    lo_us = rng.lo_us if token is None else token.ts_us
    if pages is not None:
        return _pages_after(df if after is None else df.where(after), TimeRange(lo_us, rng.hi_us), ts_col, keys, limit, pages)
    span = max((rng.hi_us - rng.lo_us) // FIRST_PART if token is None else token.span_us * ROOM, 1000)
    while True:
        hi_us = min(rng.hi_us, lo_us + span)
        stretch = df.where(between(df, ts_col, lo_us, hi_us))
        rows = stretch if after is None else stretch.where(after)
        # The last row of the page and the one after it.
        two = rows.select(order.alias("o")).orderBy("o").offset(limit - 1).limit(2)
        texts = F.array(*(F.col("last")[f"key_{k}"].cast("string") for k in range(len(keys))))
        found = two.agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("last")).select("n", "last.at", texts.alias("keys")).first()
        if found["n"] == 2:
            next_token = PageToken(found["at"], tuple(found["keys"]), max(found["at"] - lo_us, 1))
            ends = order <= _place(df, ts_col, keys, next_token)
            # The bound on the time column alone is what reaches the files.
            return rows.where(between(df, ts_col, lo_us, found["at"] + 1) & ends), next_token
        if hi_us >= rng.hi_us:
            return rows, None
        span *= WIDEN


def _pages_after(
    rest: DataFrame, rng: TimeRange, ts_col: str, keys: list[str], limit: int, pages: int
) -> tuple[DataFrame, PageToken | None]:
    # Slices up to the one whose rows are more than those of the pages, so that the one after them is there.
    totals = slice_totals(rest, rng, ts_col, min(SLICES, rng.hi_us - rng.lo_us))
    # One row per slice, so this window without partitions is small whatever the table holds.
    upto = totals.withColumn("upto", F.sum("total").over(Window.orderBy("part_id")))
    enough = F.min(F.when(F.col("upto") > pages * limit, F.struct("hi_us", "upto")))
    found = upto.agg(enough["hi_us"].alias("hi_us"), enough["upto"].alias("rows"), F.sum("total").alias("all")).first()
    whole = {rng.hi_us: found["all"]}
    # Pages with rows that come together may need more.
    for hi_us, total in ({found["hi_us"]: found["rows"]} | whole if found["rows"] else whole).items():
        rows, last = first_pages(rest, TimeRange(rng.lo_us, hi_us), ts_col, keys, limit, pages, total)
        if last is not None:
            return rows, PageToken(last["at"], tuple(last["keys"]), max((last["at"] - rng.lo_us) // pages, 1))
    return rows, None


def _order(df: DataFrame, ts_col: str, keys: list[str]) -> Column:
    for key in keys:
        if isinstance(df.schema[key].dataType, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            raise ValueError(f"column {key!r} has no text that it could be read from again")
    at = epoch_us(time_value(df, ts_col)).alias("at")
    return F.struct(at, *(named(key).alias(f"key_{k}") for k, key in enumerate(keys)))


def _place(df: DataFrame, ts_col: str, keys: list[str], token: PageToken) -> Column:
    values = (F.lit(text).cast(df.schema[key].dataType) for key, text in zip(keys, token.keys, strict=True))
    at = F.lit(token.ts_us).cast("bigint").alias("at")
    return F.struct(at, *(value.alias(f"key_{k}") for k, value in enumerate(values)))
