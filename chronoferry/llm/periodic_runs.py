"""Stretches of repeated words, by recompression.

The words of a batch of texts become a run-length grammar: by turns, neighbouring equal symbols become
blocks and chosen neighbouring pairs become one symbol, until one symbol is left. Equal symbols of a level
stand for equal words, so how far two places go on alike is found by climbing the levels and coming down
again, a step or two on each. A run of period q and at least e times its length holds a multiple of
(e-1)*q that is a period away from its end; those grid points alone are asked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoferry.llm.common import chunks, columns_as, prepare, utf8

EXPONENT = 4
MIN_LENGTH = 6
# Bytes of text whose words share a grammar; a longer text has one of its own.
TEXT_BYTES = 2 << 20
# Partitions of the symbols that are tried for a level; the one that joins most pairs is taken.
TRIES = 3


class Level(NamedTuple):
    """The step from a level to the one above it. `symbols` ends with -1, which no symbol equals; `first` has
    the first child of each symbol above, `parent` the symbol above each symbol; both have one more for the end."""

    symbols: np.ndarray
    first: np.ndarray
    parent: np.ndarray
    blocks: bool


class Grammar:
    """The grammar of a sequence of numbers from 0."""

    def __init__(self, sequence: np.ndarray) -> None:
        self.levels: list[Level] = []
        # Fixed seed: the same words always have the same grammar.
        rng = np.random.default_rng(0)
        now, blocks = sequence.astype(np.int32), True
        while len(now) > 1:
            starts, keys = _blocks(now) if blocks else _pairs(now, rng)
            if len(starts) < len(now):
                self._rise(now, starts, blocks)
                now = pd.factorize(keys)[0].astype(np.int32)
            blocks = not blocks

    def _rise(self, now: np.ndarray, starts: np.ndarray, blocks: bool) -> None:
        begins = np.zeros(len(now) + 1, np.int32)
        begins[starts] = 1
        begins[-1] = 1
        parent = np.cumsum(begins, dtype=np.int32) - 1
        first = np.append(starts, len(now)).astype(np.int32)
        self.levels.append(Level(np.append(now, np.int32(-1)), first, parent, blocks))

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from places i and j on are equal, for i < j."""
        p, q, height = i.astype(np.int64), j.astype(np.int64), np.full(len(i), len(self.levels))
        going = np.arange(len(i))
        for number, (symbols, first, parent, blocks) in enumerate(self.levels):
            a, b = p[going], q[going]
            inside = np.flatnonzero((first[parent[a]] != a) | (first[parent[b]] != b))
            if len(inside):
                x, y = a[inside], b[inside]
                alike = np.flatnonzero(symbols[x] == symbols[y])
                ends = np.ones(len(inside), bool)
                x, y = x[alike], y[alike]
                if blocks:
                    left, right = first[parent[x] + 1] - x, first[parent[y] + 1] - y
                    step = np.minimum(left, right)
                    ends[alike] = left != right
                else:
                    step = 1
                    ends[alike] = False
                a[inside[alike]] = x + step
                b[inside[alike]] = y + step
                done = inside[ends]
                p[going[done]], q[going[done]], height[going[done]] = a[done], b[done], number
                stays = np.ones(len(going), bool)
                stays[done] = False
                going, a, b = going[stays], a[stays], b[stays]
            p[going], q[going] = parent[a], parent[b]
        for number in range(len(self.levels) - 1, -1, -1):
            symbols, first, _, blocks = self.levels[number]
            down = np.flatnonzero(height > number)
            a, b = p[down], q[down]
            x, y = first[a].astype(np.int64), first[b].astype(np.int64)
            alike = np.flatnonzero(symbols[x] == symbols[y])
            step = 1
            if blocks:
                step = np.minimum(first[a[alike] + 1] - x[alike], first[b[alike] + 1] - y[alike])
            x[alike] += step
            y[alike] += step
            p[down], q[down] = x, y
        return p - i

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols right before places i and j are equal, for i < j."""
        p, q, height = i.astype(np.int64), j.astype(np.int64), np.full(len(i), len(self.levels))
        going = np.arange(len(i))
        for number, (symbols, first, parent, blocks) in enumerate(self.levels):
            a, b = p[going], q[going]
            inside = np.flatnonzero((first[parent[a]] != a) | (first[parent[b]] != b))
            if len(inside):
                x, y = a[inside], b[inside]
                # Before the first symbol is place -1, the mark at the end.
                alike = np.flatnonzero(symbols[x - 1] == symbols[y - 1])
                ends = np.ones(len(inside), bool)
                x, y = x[alike], y[alike]
                if blocks:
                    left, right = x - first[parent[x - 1]], y - first[parent[y - 1]]
                    step = np.minimum(left, right)
                    ends[alike] = left != right
                else:
                    step = 1
                    ends[alike] = False
                a[inside[alike]] = x - step
                b[inside[alike]] = y - step
                done = inside[ends]
                p[going[done]], q[going[done]], height[going[done]] = a[done], b[done], number
                stays = np.ones(len(going), bool)
                stays[done] = False
                going, a, b = going[stays], a[stays], b[stays]
            p[going], q[going] = parent[a], parent[b]
        for number in range(len(self.levels) - 1, -1, -1):
            symbols, first, _, blocks = self.levels[number]
            down = np.flatnonzero(height > number)
            a, b = p[down], q[down]
            x, y = first[a].astype(np.int64), first[b].astype(np.int64)
            alike = np.flatnonzero(symbols[x - 1] == symbols[y - 1])
            step = 1
            if blocks:
                step = np.minimum(x[alike] - first[a[alike] - 1], y[alike] - first[b[alike] - 1])
            x[alike] -= step
            y[alike] -= step
            p[down], q[down] = x, y
        return i - p


def _blocks(now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where blocks of equal symbols begin, and a number for each by symbol and size."""
    starts = np.flatnonzero(np.append(True, now[1:] != now[:-1]))
    sizes = np.diff(np.append(starts, len(now)))
    return starts, now[starts].astype(np.int64) * (len(now) + 1) + sizes


def _pairs(now: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs and single symbols begin, and a number for each. Symbols are left or right ones; a left
    one and a right one after it are a pair, so pairs never overlap and equal symbols are always cut alike."""
    alphabet = int(now.max()) + 1
    most, pair = -1, None
    for _ in range(TRIES):
        right = rng.integers(0, 2, alphabet, dtype=bool)[now]
        for second in (right, ~right):
            met = second[1:] & ~second[:-1]
            if (count := np.count_nonzero(met)) > most:
                most, pair = count, met
    joined = np.append(False, pair)
    starts = np.flatnonzero(~joined)
    other = np.zeros(len(starts), np.int64)
    paired = np.append(pair, False)[starts]
    other[paired] = now[starts[paired] + 1].astype(np.int64) + 1
    return starts, now[starts].astype(np.int64) * (alphabet + 1) + other


def find_runs(
    words: np.ndarray, offsets: np.ndarray, exponent: int = EXPONENT, min_length: int = MIN_LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of the texts that stand one after another in `words`, as (start, end, period), sorted.

    Text k has the words from offsets[k] to offsets[k+1]. A run of a multiple of its smallest period is
    the same stretch, which the smallest one names.
    """
    found = [np.empty((3, 0), np.int64)]
    longest = int(np.diff(offsets).max(initial=0))
    grammar = None
    # For each place, period and end of a run that holds it.
    period, end = np.ones(len(words), np.int32), np.zeros(len(words), np.int32)
    low = 1
    while low <= longest // exponent:
        high = min(2 * low, longest // exponent + 1)
        x, q = _candidates(words, low, high, exponent)
        text = np.searchsorted(offsets, x, "right") - 1
        # Two places of a run, a multiple of its period apart, lead to that run again.
        new = (x + q < offsets[text + 1]) & ((q % period[x] != 0) | (x + q >= end[x]))
        x, q, text = x[new], q[new], text[new]
        if len(x):
            grammar = grammar or Grammar(words)
            s = np.maximum(x - grammar.backward(x, x + q), offsets[text])
            e = np.minimum(x + q + grammar.forward(x, x + q), offsets[text + 1])
            long = e - s >= np.maximum(min_length, exponent * q)
            runs = _first_of_each(np.stack([s[long], e[long], q[long]]))
            for a, b, c in runs.T.tolist():
                period[a:b], end[a:b] = c, b
            found.append(runs)
        low = high
    runs = _first_of_each(np.concatenate(found, axis=1))
    runs = runs[:, np.lexsort((runs[2], runs[0]))]
    return runs[0], runs[1], runs[2]


def _candidates(words: np.ndarray, low: int, high: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid points x of the periods from `low` to `high` whose words x and x + q are equal."""
    points, periods = [], []
    for q in range(low, high):
        step = (exponent - 1) * q
        hits = np.flatnonzero(words[: len(words) - q : step] == words[q::step])
        if len(hits):
            points.append(hits * step)
            periods.append(np.full(len(hits), q))
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *points]), np.concatenate([empty, *periods])


def _first_of_each(runs: np.ndarray) -> np.ndarray:
    """One column for each start and end: that of the smallest period."""
    runs = runs[:, np.lexsort(runs[::-1])]
    fresh = np.append(True, (runs[:2, 1:] != runs[:2, :-1]).any(axis=0))[: runs.shape[1]]
    return runs[:, fresh]


def runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    exponent: int = EXPONENT,
    min_length: int = MIN_LENGTH,
) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row of `docs`.

    Words are what stands between spaces, tabs and line ends, numbered from 0 and compared byte by byte.
    runs are structs (start, length, period) by start, then period: all stretches of words with smallest
    period q and at least `exponent` * q and `min_length` words that no neighbouring word extends.
    collapsed has the words joined by one space without those that any run holds after its first q words
    (bytes that are no UTF-8 become replacement characters). Null and empty texts have no words, no runs
    and an empty collapsed text. Rows are independent: repeated rows repeat, an empty table gives an
    empty one, null ids stay null, and other columns are not read.
    """
    if exponent < 2:
        raise ValueError("a run repeats at least twice")
    prepare(docs.sparkSession)
    rows = columns_as(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", TEXT_BYTES):
            texts = [text.split() for text in utf8(part.column("text"))]
            counts = np.array([len(t) for t in texts], np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            names = pd.factorize(np.array([w for t in texts for w in t], object))[0].astype(np.int32)
            start, end, period = find_runs(names, offsets, exponent, min_length)
            repeats = np.zeros(len(names) + 1, np.int64)
            np.add.at(repeats, start + period, 1)
            np.add.at(repeats, end, -1)
            kept = np.cumsum(repeats)[:-1] == 0
            cuts = np.searchsorted(start, offsets)
            whole = cuts[:-1] == cuts[1:]
            collapsed = [
                b" ".join(words if whole[k] else compress(words, kept[offsets[k] : offsets[k + 1]].tolist()))
                for k, words in enumerate(texts)
            ]
            text = np.searchsorted(offsets, start, "right") - 1
            structs = pa.StructArray.from_arrays(
                [pa.array(start - offsets[text]), pa.array(end - start), pa.array(period)], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), structs),
                    pa.array([t.decode("utf-8", "replace") for t in collapsed], pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    made = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(run, f"id {kind}, {made}")


def strongest(runs: Column) -> Column:
    """The run that repeats most often, by exact length / period; the first of several."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")

    def better(best: Column, run: Column) -> Column:
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    return F.reduce(runs, none, better)


def digest(rows: DataFrame) -> DataFrame:
    """What a query shows of `runs`: their number, the strongest one, and checksums."""
    best = F.col("best")
    text = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.withColumn("best", strongest(F.col("runs"))).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(text, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with repeats put into a tenth of the texts, chosen by the checksum h of the id: from word
    a = g % n on, the first p of those words come again and again, for g = h div 10 and p = 1 + (n-a) div (3 + g % 8)."""
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select(id_col, text_col, F.when(h % 10 == 0, words).alias("words"))
    rows = rows.select(id_col, text_col, "words", F.size("words").alias("n"), F.floor(h / 10).alias("g"))
    rows = rows.select("*", F.when(F.col("n") > 0, F.pmod("g", "n")).cast("int").alias("a"))
    rest = F.col("n") - F.col("a")
    rows = rows.select("*", (F.floor(rest / (F.col("g") % 8 + 3)) + 1).cast("int").alias("p"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    made = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest))
    text = F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col(text_col))
    return rows.select(id_col, text.alias(text_col))
