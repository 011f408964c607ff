"""Hard negatives by exact integer scores, tile by tile.

Anchors and candidates are dealt by hash into tiles of bounded size, and every anchor tile meets every
candidate tile in a task of its own. There the score matrix is made by Strassen's recursion on int64
matrices padded with zeros. Each task keeps the best few of each anchor; keeping the best of such keepings
gives the best of all, so only those few leave a task. Positives come first; the windows that they open
for negatives are searched in a second pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoferry.llm.common import pin, prepare, quoted

POSITIVES, NEGATIVES = 5, 5
# A negative's score is at least this share of the positive's, and at most all of it.
LOWEST_PERCENT, HIGHEST_PERCENT = 80, 100
SCALE = 256
# Vectors of a tile, about, and of the part of it that is multiplied at once.
TILE = 4096
PART = (512, 1024)
# Matrices with a side of at most this are multiplied as they are.
LEAF = 16
NONE = np.iinfo(np.int64).min
# Scores times a percentage must fit into 64 bits.
BOUND = (1 << 63) // 100


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b by seven products of half the size instead of eight; sides are padded with zeros to be halved."""
    (m, k), n = a.shape, b.shape[1]
    halvings = 0
    while min(m, k, n) >> halvings > leaf:
        halvings += 1
    return _product(_padded(a, halvings), _padded(b, halvings), halvings)[:m, :n]


def _padded(a: np.ndarray, halvings: int) -> np.ndarray:
    return np.pad(a, [(0, -side % (1 << halvings)) for side in a.shape])


def _product(a: np.ndarray, b: np.ndarray, halvings: int) -> np.ndarray:
    if not halvings:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    halvings -= 1
    p1 = _product(a11 + a22, b11 + b22, halvings)
    p2 = _product(a21 + a22, b11, halvings)
    p3 = _product(a11, b12 - b22, halvings)
    p4 = _product(a22, b21 - b11, halvings)
    p5 = _product(a11 + a12, b22, halvings)
    p6 = _product(a21 - a11, b11 + b12, halvings)
    p7 = _product(a12 - a22, b21 + b22, halvings)
    out = np.empty((2 * m, 2 * n), a.dtype)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """For each of `rows` owners the best `size` places, by score, then by place. NONE is an empty place."""

    def __init__(self, rows: int, size: int) -> None:
        self.scores = np.full((rows, size), NONE)
        self.places = np.full((rows, size), -1)

    def offer(self, owners: slice, scores: np.ndarray, first: int) -> None:
        """Take in a matrix of scores, a row for each owner, a column for each place from `first` on. It is overwritten."""
        size = self.scores.shape[1]
        row = np.arange(len(scores))
        new_scores, new_places = np.full((len(scores), size), NONE), np.full((len(scores), size), -1)
        for k in range(size):
            best = scores.argmax(axis=1)  # the first of equals
            new_scores[:, k] = scores[row, best]
            if (new_scores[:, k] == NONE).all():
                break
            new_places[:, k] = best + first
            scores[row, best] = NONE
        self.merge(owners, new_scores, new_places)

    def merge(self, owners: slice, scores: np.ndarray, places: np.ndarray) -> None:
        scores = np.concatenate([self.scores[owners], scores], axis=1)
        places = np.concatenate([self.places[owners], places], axis=1)
        # ~ turns the order of scores around.
        order = np.lexsort((places, ~scores), axis=1)[:, : self.scores.shape[1]]
        self.scores[owners] = np.take_along_axis(scores, order, axis=1)
        self.places[owners] = np.take_along_axis(places, order, axis=1)

    def kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, place, score) of all that is kept."""
        owner, k = np.nonzero(self.scores != NONE)
        return owner, self.places[owner, k], self.scores[owner, k]


def _sizes(lists: pa.ChunkedArray) -> np.ndarray:
    return lists.combine_chunks().value_lengths().to_numpy(zero_copy_only=False)


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < _sizes(lists)[:, None]] = lists.combine_chunks().flatten().to_numpy()
    return out


class Tiles:
    """An anchor tile and a candidate tile, the candidates by id, and their scores part by part."""

    def __init__(self, anchors: pa.Table, candidates: pa.Table) -> None:
        self.anchors = anchors
        self.candidates = candidates.sort_by([("id", "ascending"), ("mark", "ascending")])
        width = max(int(_sizes(t["vector"]).max(initial=1)) for t in (anchors, candidates))
        self.a, self.c = _matrix(self.anchors["vector"], width), _matrix(self.candidates["vector"], width).T
        most = [max(-int(x.min(initial=0)), int(x.max(initial=0))) for x in (self.a, self.c)]
        if most[0] * most[1] * width >= BOUND:
            raise OverflowError("scores of these vectors do not fit into 64 bits")
        ids = [t["id"].to_numpy() for t in (self.anchors, self.candidates)]
        labels = pd.factorize(np.concatenate([t["label"].to_numpy() for t in (self.anchors, self.candidates)]))[0]
        self.a_ids, self.c_ids = ids
        self.a_labels, self.c_labels = labels[: len(self.a)], labels[len(self.a) :]

    def parts(self):
        for at in range(0, len(self.a), PART[0]):
            owners = slice(at, min(at + PART[0], len(self.a)))
            for first in range(0, self.c.shape[1], PART[1]):
                places = slice(first, min(first + PART[1], self.c.shape[1]))
                scores = strassen(self.a[owners], self.c[:, places])
                same = self.a_labels[owners, None] == self.c_labels[places]
                other = self.a_ids[owners, None] != self.c_ids[places]
                yield owners, first, scores, same, other

    def table(self, owner: np.ndarray, place: np.ndarray, score: np.ndarray, **more: np.ndarray) -> pa.Table:
        found = self.candidates.select(["id", "mark"]).take(pa.array(place))
        own = self.anchors.select(["id", "mark"]).take(pa.array(owner))
        return pa.table(
            {
                "anchor": own["id"], "anchor_mark": own["mark"], "other": found["id"], "other_mark": found["mark"],
                "score": pa.array(score, pa.int64()), **{k: pa.array(v) for k, v in more.items()},
            }
        )


def _positives(size: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        tiles = Tiles(anchors, candidates)
        heaps = Heaps(anchors.num_rows, size)
        for owners, first, scores, same, other in tiles.parts():
            heaps.offer(owners, np.where(same & other, scores, NONE), first)
        return tiles.table(*heaps.kept())

    return run


def _windows(size: int, lowest: int, highest: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        tiles = Tiles(anchors, candidates)
        counts = _sizes(anchors["positives"])
        slots = int(counts.max(initial=1))
        positive = _matrix(anchors["positives"], slots)
        present = np.arange(slots) < counts[:, None]
        heaps = [Heaps(anchors.num_rows, size) for _ in range(slots)]
        for owners, first, scores, same, other in tiles.parts():
            hundredfold = 100 * scores
            wrong = ~same & other
            for slot in range(slots):
                wanted = positive[owners, slot, None]
                inside = (hundredfold >= lowest * wanted) & (hundredfold <= highest * wanted)
                inside &= wrong & present[owners, slot, None]
                heaps[slot].offer(owners, np.where(inside, scores, NONE), first)
        return pa.concat_tables(
            tiles.table(owner, place, score, slot=np.full(len(owner), slot, np.int32))
            for slot, (owner, place, score) in enumerate(h.kept() for h in heaps)
        )

    return run


def usable(vectors: DataFrame, anchors: Column, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, vector, mark, anchor): the different rows that take part, with integer components."""

    def whole(x: Column) -> Column:
        return F.floor(x.cast("double") * scale)

    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = vectors.select(
        F.col(quoted(id_col)).cast("long").alias("id"),
        F.col(quoted(label_col)).alias("label"),
        F.col(quoted(vector_col)).alias("given"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND given IS NOT NULL").where(F.forall("given", fine))
    rows = rows.select("id", "label", F.transform("given", whole).alias("vector"), "anchor")
    rows = rows.groupBy("id", "label", "vector").agg(F.bool_or("anchor").alias("anchor"))
    return rows.withColumn("mark", F.xxhash64("label", "vector"))


def mine(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest_percent: int = LOWEST_PERCENT,
    highest_percent: int = HIGHEST_PERCENT,
    scale: int = SCALE,
    tile: int = TILE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where `anchors` holds.

    Components become floor(scale * x); a score is the inner product with the anchor. An anchor's positives
    are the best rows of its label with another id; for each of them come the best rows of other labels and
    ids whose score is between the two percentages of the positive's. Equal scores go by the smaller id.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows that
    are alike in id, label and vector are one; rows of one id that differ are rows of their own. The shorter
    of two vectors goes on with zeros, so an empty one scores 0. An anchor without positives, or without
    negatives for one, has no rows for it; an empty table gives none. Scores that don't fit into 64 bits
    after a multiplication by 100 are an error. Other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = pin(usable(vectors, anchors, id_col, vector_col, label_col, scale))
    counts = rows.agg(F.count("*").alias("all"), F.count_if("anchor").alias("anchors")).first()
    grid = max(1, -(-counts["anchors"] // tile)), max(1, -(-counts["all"] // tile))
    near = _met(
        rows.where("anchor"), rows, grid, _positives(positives),
        "anchor long, anchor_mark long, other long, other_mark long, score long",
    )
    near = _best(near, positives, "anchor", "anchor_mark")
    # At most `positives` rows for each anchor.
    ranked = F.array_sort(F.collect_list(F.struct("rank", "score", "other")))
    opened = pin(near.groupBy("anchor", "anchor_mark").agg(ranked.alias("ranked")))
    owners = rows.where("anchor").join(
        opened.select(F.col("anchor").alias("id"), F.col("anchor_mark").alias("mark"), F.col("ranked.score").alias("positives")),
        ["id", "mark"],
    )
    hard = _met(
        owners, rows, grid, _windows(negatives, lowest_percent, highest_percent),
        "anchor long, anchor_mark long, other long, other_mark long, score long, slot int",
    )
    hard = _best(hard, negatives, "anchor", "anchor_mark", "slot")
    positive = F.get("ranked", F.col("slot"))
    return hard.join(opened, ["anchor", "anchor_mark"]).select(
        F.col("anchor").alias("anchor_id"),
        positive["other"].alias("positive_id"),
        "rank",
        F.col("other").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def _met(
    owners: DataFrame, rows: DataFrame, grid: tuple[int, int], search: Callable[[pa.Table, pa.Table], pa.Table], made: str
) -> DataFrame:
    """`search` of every tile of `owners` with every tile of `rows`: each row goes to the tiles it has to meet."""

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def own(count: int) -> Column:
        return F.pmod(F.xxhash64("id", "mark"), F.lit(count)).cast("int")

    # Columns anew, since both sides come from the same table.
    left = owners.select(*(F.col(c).alias(c) for c in owners.columns if c != "anchor"))
    left = left.withColumn("across", own(grid[0])).withColumn("down", every(grid[1]))
    right = rows.drop("anchor").withColumn("down", own(grid[1])).withColumn("across", every(grid[0]))
    kind = pa.schema([(f.split()[0], pa.int32() if f.endswith(" int") else pa.int64()) for f in made.split(", ")])

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not anchors.num_rows or not candidates.num_rows:
            return kind.empty_table()
        return search(anchors, candidates).cast(kind)

    return left.groupBy("across", "down").cogroup(right.groupBy("across", "down")).applyInArrow(run, made)


def _best(found: DataFrame, size: int, *owner: str) -> DataFrame:
    """The best `size` rows of each owner with their `rank`; each task has sent as many at most."""
    order = Window.partitionBy(*owner).orderBy(F.desc("score"), "other", "other_mark")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
