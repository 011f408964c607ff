"""Embedding near-duplicates: an exact metric range join over blocks of vectors in the order of pivot cells."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoferry.llm.common import columns_as, components, forest, pin, prepare

COSINE = 0.95
# At most so many cells, and about so many vectors in each before that.
MAX_PIVOTS = 4096
CELL = 2048
# Vectors that pivots are chosen from and cells are weighed by at most, and their bytes.
SAMPLE = 32_768
SAMPLE_BYTES = 16 << 20
# Vectors of a block at most, and their bytes. Python compares two blocks at a time.
BLOCK = 32_768
BLOCK_BYTES = 8 << 20
# Blocks that are read together: a task meets those of two parts.
PART_BLOCKS = 4
# A table for few parts is dealt to so many, if they get so many vectors.
FEW_PARTS = 8
FEW_VECTORS = 8192
# Vectors of a cell that are compared at once.
TILE = 1024
# Leading axes by which most pairs are found to be apart.
AXES = 26
# More than single-precision products of unit vectors are wrong by, for a component.
SLACK = 3e-7
# Pairs that are compared in double precision at once, and links that a task gathers before it reduces them to a forest.
PAIRS = 1 << 16
LINKS = 1 << 20
# Columns of a stored block: its first node, and numbers for each vector.
BLOBS = ["first", "cell", "h", "g", "id", "n", "v"]


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """The rows of a matrix with length 1, in double precision."""
    rows = vectors.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=0)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def narrow_rows(vectors: np.ndarray) -> np.ndarray:
    """The same in single precision, computed in parts."""
    out = np.empty(vectors.shape, np.float32)
    for at in range(0, len(vectors), 4096):
        some = vectors[at : at + 4096]
        if vectors.dtype == np.float32:  # squares don't leave the range of double precision
            length = np.sqrt(np.einsum("ij,ij->i", some, some, dtype=np.float64))
            np.divide(some, length[:, None], out=out[at : at + 4096], dtype=np.float64, casting="same_kind")
        else:
            out[at : at + 4096] = unit_rows(some)
    return out


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column of `size` numbers each as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` rows of length 1, each the farthest from those before."""
    chosen, near = [0], None
    while len(chosen) < min(count, len(sample)):
        away = np.maximum(2 - 2 * (sample @ sample[chosen[-1]]), 0)
        near = away if near is None else np.minimum(near, away)
        if near.max() <= 1e-6:
            break
        chosen.append(int(near.argmax()))
    return sample[chosen]


def homes(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivot of each row."""
    parts = [(rows[at : at + 2048] @ pivots.T).argmax(axis=1) for at in range(0, len(rows), 2048)]
    return np.concatenate([np.empty(0, np.int64), *parts])


def within(least: np.ndarray, reach: float, slack: float) -> np.ndarray:
    """The least cosine with a pivot of vectors within `reach` of one whose cosine with the pivot is `least` or more.

    Angles between vectors obey the triangle inequality, and vectors of length 1 at a distance of `reach` have the
    angle 2 asin(reach / 2). Cosines may be wrong by `slack`.
    """
    angle = np.arccos(np.clip(least.astype(np.float64) - slack, -1, 1)) + 2 * np.arcsin(min(reach / 2, 1))
    return np.cos(np.minimum(angle, np.pi)) - slack


def cells(rows: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home): the cell of each row's nearest pivot, and every other cell that has vectors of `rows` in reach."""
    near = rows @ pivots.T
    home = near.argmax(axis=1)
    least = np.full(len(pivots), np.inf)
    np.minimum.at(least, home, near[np.arange(len(rows)), home])
    row, cell = np.nonzero((near >= within(least, reach, SLACK * rows.shape[1])) & np.isfinite(least))
    return row, cell, cell == home[row]


class Block:
    """Vectors in the order of their cells and, in a cell, of their distance from its pivot, cut into tiles."""

    def __init__(
        self, first: int, cell: np.ndarray, copies: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, axes: np.ndarray
    ):
        self.first, self.copies, self.vectors = first, copies.astype(np.float64), vectors
        self.rows, self.slack = narrow_rows(vectors), SLACK * max(64, vectors.shape[1])
        low = self.rows @ axes
        half = (low * low).sum(axis=1, keepdims=True) / 2
        one = np.ones_like(half)
        # The product of one row's `low` and another's `high` is minus half their squared distance along the axes.
        self.low, self.high = np.hstack([low, -half, one]), np.hstack([low, one, -half])
        self.links = np.zeros(len(cell))
        edges = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
        cuts = [np.linspace(a, b, -(-(b - a) // TILE) + 1).astype(np.int64)[:-1] for a, b in pairwise(edges)]
        self.cuts = np.concatenate([*cuts, [len(cell)]])
        starts, own_cells = self.cuts[:-1], cell[edges[:-1]]
        self.pivots, self.cell_of = pivots[own_cells], np.searchsorted(own_cells, cell[starts])
        self.least = np.minimum.reduceat(np.einsum("ij,ij->i", self.rows, pivots[cell]), starts)

    def visits(self, other: Block, reach: float) -> list[tuple[np.ndarray, list[int]]]:
        """For each tile the rows of the other block that may have links in it, and where the other's tiles begin in them."""
        near = self.pivots @ other.rows.T
        bounds = within(self.least, reach, self.slack).astype(np.float32)
        rows = [np.flatnonzero(near[k] >= bound) for k, bound in zip(self.cell_of, bounds)]
        return [(r, np.searchsorted(r, other.cuts).tolist()) for r in rows]


def near_pairs(x: Block, y: Block, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Which of the pairs of rows (i, j) have a cosine of `least` or more, in double precision."""
    parts = []
    for at in range(0, len(i), PAIRS):
        a, b = unit_rows(x.vectors[i[at : at + PAIRS]]), unit_rows(y.vectors[j[at : at + PAIRS]])
        parts.append(np.einsum("ij,ij->i", a, b) >= least)
    return np.concatenate([np.empty(0, bool), *parts])


def places(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is true in a matrix; much faster than for two dimensions at once."""
    return np.divmod(np.flatnonzero(hit), hit.shape[1])


def joined(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A label for each row and column of a matrix of links, the same for those that links join; -1 without any."""
    none = len(hit)
    label = np.arange(none)
    while True:
        across = np.where(hit, label[:, None], none).min(axis=0)
        back = np.minimum(label, np.where(hit, across, none).min(axis=1))
        back = np.minimum(back, back[back])
        if np.array_equal(back, label):
            return np.where(hit.any(axis=1), label, -1), np.where(across < none, across, -1)
        label = back


def compare(x: Block, y: Block, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Adds to both blocks' links what they are linked with, counted with copies, and gives links that join the linked
    nodes. Every pair of rows is counted once, also if both blocks are the same."""
    same = x is y
    reach = float(np.sqrt(max(2 - 2 * least, 0)))
    to_x = x.visits(y, reach)
    to_y = to_x if same else y.visits(x, reach)
    apart = np.float32(-(reach**2) / 2 - x.slack)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    room = np.empty(TILE * TILE, np.float32)
    for t, (all_j, cut_j) in enumerate(to_x):
        high = y.high.take(all_j, axis=0).T
        for s in range(t if same else 0, len(to_y)):
            j0, j1 = cut_j[s], cut_j[s + 1]
            all_i, cut_i = to_y[s]
            i0, i1 = cut_i[t], cut_i[t + 1]
            if i0 == i1 or j0 == j1:
                continue
            i = all_i[i0:i1]
            out = room[: (i1 - i0) * (j1 - j0)].reshape(i1 - i0, j1 - j0)
            product = np.matmul(x.low.take(i, axis=0), high[:, j0:j1], out=out)
            if product.max() < apart:
                continue
            a, b = linked(x, y, i, all_j[j0:j1], product >= apart, same and s == t, least)
            if len(a):
                found.append((a, b))
                held += len(a)
            if held > LINKS:
                found = [forest(*map(np.concatenate, zip(*found)))]
                held = len(found[0][0])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(*map(np.concatenate, zip(*found)))


def linked(
    x: Block, y: Block, i: np.ndarray, j: np.ndarray, hit: np.ndarray, own: bool, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Counts the links among rows i of `x` and j of `y` that `hit` leaves possible; links that join the linked nodes.
    With `own` both are rows of one tile, and only pairs with i < j count."""
    if own:
        hit &= i[:, None] < j
    if np.count_nonzero(hit) * 32 > hit.size:
        cosine = x.rows[i] @ y.rows[j].T
        hit &= cosine >= least - x.slack
        p, q = places(hit & (cosine < least + x.slack))
        hit[p, q] = near_pairs(x, y, i[p], j[q], least)
        sure = True
    else:
        sure = False
    if sure and np.count_nonzero(hit) > 4 * sum(hit.shape):
        counted = hit.astype(np.float64)
        x.links[i] += counted @ y.copies[j]
        y.links[j] += x.copies[i] @ counted
        rows, columns = joined(hit)
        p, q = rows >= 0, columns >= 0
        return x.first + np.concatenate([i[p], y.first - x.first + j[q]]), x.first + i[np.concatenate([rows[p], columns[q]])]
    p, q = places(hit)
    i, j = i[p], j[q]
    if not sure:
        near = near_pairs(x, y, i, j, least)
        i, j = i[near], j[near]
    np.add.at(x.links, i, y.copies[j])
    np.add.at(y.links, j, x.copies[i])
    return x.first + i, y.first + j


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row: what a cosine of `cosine` or more links it with.

    Null, empty and zero vectors, and those with null or non-finite components, link with nothing, and so
    do rows without an id; their component_id is their own id. Vectors of different lengths don't link.
    Equal vectors, repeated rows among them, are linked with each other; they are compared as one. An empty
    table gives an empty result, and other columns are not read.

    Vectors are shuffled once and stored once, in blocks of at most `block`. Every pair of blocks is read and compared
    by a task of its own, so nothing is copied for the comparison. Rows find their vector's result by two 64-bit hashes.
    """
    prepare(vectors.sparkSession)
    rows = columns_as(vectors, id=id_col, v=vector_col)
    kind = "float" if rows.schema["v"].dataType.simpleString() == "array<float>" else "double"
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("v").cast(f"array<{kind}>").alias("v"))
    usable = F.col("id").isNotNull() & F.expr(
        "size(v) > 0 and forall(v, x -> x is not null and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)"
    )
    usable = F.coalesce(usable, F.lit(False))
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    valid = rows.where(usable).select("id", "v", F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g"))
    nodes, found, parts = None, None, 0
    kept_as = np.dtype(np.float32 if kind == "float" else np.float64)
    for size, n in sorted(map(tuple, valid.groupBy(F.size("v")).count().collect())):
        own, pairs, more = found_of(valid.where(F.size("v") == size), size, n, kept_as, cosine, block, parts)
        nodes, found = (own, pairs) if nodes is None else (nodes.union(own), found.union(pairs))
        parts += more
    if nodes is None:
        return alone.withColumn("kept", F.lit(True))
    found = pin(found)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    rooted = nodes.select("node", "first_id").join(groups, "node")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    seen = rooted.join(least, "root").join(counts, "node").select("node", "component_id", "links")
    component_id, links = F.coalesce("component_id", "first_id"), F.coalesce("links", F.lit(0)) + F.col("n") - 1
    classes = nodes.join(seen, "node", "left").select(
        "h", "g", component_id.alias("component_id"), links.alias("n_links")
    )
    # A vector on the border of two cells may be a node in both; these have the same links.
    classes = classes.groupBy("h", "g").agg(F.min("component_id").alias("component_id"), F.max("n_links").alias("n_links"))
    # Stored, so that the join below shuffles it by itself and a vector with very many rows can be split.
    classes = pin(classes)
    both = valid.select("id", "h", "g").join(classes, ["h", "g"]).select("id", "n_links", "component_id").union(alone)
    return both.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def found_of(
    valid: DataFrame, size: int, n: int, kind: np.dtype, cosine: float, block: int, before: int
) -> tuple[DataFrame, DataFrame, int]:
    """Over vectors of one length: (h, g, node, first_id, n) for each that is distinct; (node, links, other), which
    are counts for each pair of blocks and links; and in how many parts the nodes are, which follow those `before`."""
    width = size * kind.itemsize
    wanted = max(1, min(SAMPLE, SAMPLE_BYTES // width))
    share = min(1.0, wanted / n)
    picked = valid.where(F.pmod("g", F.lit(1 << 48)) < int(share * (1 << 48))) if share < 1 else valid
    sample = picked.select("v").distinct().limit(2 * wanted).toArrow().column("v").combine_chunks()
    sample = unit_rows(matrix(sample, size)) if len(sample) else np.eye(1, size)
    distinct = max(1, round(len(sample) / share))
    cells_wanted = min(MAX_PIVOTS, max(1, distinct // CELL))
    pivots = spread(sample[: 2 * cells_wanted], cells_wanted).astype(np.float32)
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, :AXES].astype(np.float32)
    room = max(1, min(BLOCK, BLOCK_BYTES // width))
    most = min(block, room)
    home = homes(sample.astype(np.float32), pivots)
    (starts_at, ways), parts = dealt(home, len(pivots), distinct, PART_BLOCKS * room)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(k).to_numpy() for k in ("h", "g")])
            order = np.lexsort(keys.T)
            starts = firsts(keys[order])
            first = order[starts]
            rows = np.ascontiguousarray(matrix(batch.column("v"), size)[first], kind)
            cell = homes(narrow_rows(rows), pivots)
            h = keys[first, 0]
            part = starts_at[cell] + h % ways[cell]
            least = np.minimum.reduceat(batch.column("id").to_numpy()[order], starts)
            n = np.diff(np.append(starts, len(order)))
            columns = [part.astype(np.int32), cell.astype(np.int32), h, keys[first, 1], least, n]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), binaries(rows)], ["part", "cell", "h", "g", "id", "n", "v"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = [b for b in batches if b.num_rows]
        if not full:
            return
        table = pa.Table.from_batches(full)
        part, cell, h, g, ids, n = (table.column(k).to_numpy() for k in ("part", "cell", "h", "g", "id", "n"))
        vectors = np.frombuffer(table.column("v").combine_chunks().buffers()[2], kind, len(part) * size).reshape(-1, size)
        # A partition may have several parts, and a part many rows of one vector.
        order = np.lexsort([g, h, cell, part])
        keys = np.column_stack([part, cell, h, g])[order]
        starts = firsts(keys)
        ids, n = np.minimum.reduceat(ids[order], starts), np.add.reduceat(n[order], starts)
        keys, order = keys[starts], order[starts]
        own = np.empty(len(order))
        for at in range(0, len(order), 4096):
            some = slice(at, at + 4096)
            own[some] = np.einsum("ij,ij->i", narrow_rows(vectors[order[some]]), pivots[keys[some, 1]])
        again = np.lexsort([-own, keys[:, 1], keys[:, 0]])
        keys, order, ids, n = keys[again], order[again], ids[again], n[again]
        edges = np.flatnonzero(np.diff(keys[:, 0], prepend=-1, append=-1))
        for a, b in pairwise(edges):
            for at in range(a, b, most):
                s = slice(at, min(at + most, b))
                columns = [keys[s, 1].astype(np.int32), keys[s, 2], keys[s, 3], ids[s], n[s], vectors[order[s]]]
                first = pa.array([(before + int(keys[at, 0]) << 32) + at - a])
                yield pa.RecordBatch.from_arrays([first, *(binaries(c.reshape(1, -1)) for c in columns)], BLOBS)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, first in enumerate(batch.column("first").to_pylist()):
                h, g, ids, n = (numbers(batch.column(c)[k], np.int64) for c in ("h", "g", "id", "n"))
                columns = [h, g, np.arange(first, first + len(h)), ids, n]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["h", "g", "node", "first_id", "n"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = None
        for batch in batches:
            for k in range(batch.num_rows):
                first = [batch.column(f"{side}_first")[k].as_py() for side in "xy"]
                both = [x] if x is not None and x.first == first[0] else []
                for side in ("xy" if first[0] < first[1] else "x")[len(both) :]:
                    kinds = {"cell": np.int32, "n": np.int64, "v": kind}
                    cell, n, v = (numbers(batch.column(f"{side}_{c}")[k], t) for c, t in kinds.items())
                    both.append(Block(first["xy".index(side)], cell, n, v.reshape(-1, size), pivots, axes))
                x = both[0]
                x.links[:] = 0
                low, high = compare(x, both[-1], cosine)
                some = [np.flatnonzero(b.links) for b in both]
                node = np.concatenate([*(b.first + i for b, i in zip(both, some)), low])
                links = np.concatenate([*(b.links[i] for b, i in zip(both, some)), np.zeros(len(low))]).astype(np.int64)
                counts = len(node) - len(low)
                other = pa.array(np.concatenate([node[:counts], high]), mask=np.arange(len(node)) < counts)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), other], ["node", "links", "other"])

    placed = valid.select("id", "h", "g", "v").mapInArrow(place, "part int, cell int, h long, g long, id long, n long, v binary")
    stored = ", ".join(f"{c} {'long' if c == 'first' else 'binary'}" for c in BLOBS)
    blocks = pin(placed.repartitionById(parts, "part").mapInArrow(pack, stored))
    nodes = blocks.select("first", "h", "g", "id", "n").mapInArrow(unpack, "h long, g long, node long, first_id long, n long")
    x, y = (blocks.select(*(F.col(c).alias(f"{side}_{c}") for c in ("first", "cell", "n", "v"))) for side in "xy")
    # Each task reads its pair from where they are stored; the hint keeps blocks out of broadcasts.
    pairs = x.hint("shuffle_replicate_nl").join(y, F.col("x_first") <= F.col("y_first"))
    return nodes, pairs.mapInArrow(meet, "node long, links long, other long"), parts


def dealt(home: np.ndarray, count: int, distinct: int, most: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """((part, ways), parts): the first part of each of `count` cells and over how many parts it is spread.

    `home` are the cells of a sample of the `distinct` vectors. Parts have about equal numbers of vectors; several small
    cells share one, and a large one has its own.
    """
    weight = np.bincount(home, minlength=count) * (distinct / max(1, len(home)))
    wanted = max(-(-distinct * 10 // (most * 9)), min(FEW_PARTS, -(-distinct // FEW_VECTORS)))
    target = distinct / wanted
    ways = np.maximum(1, np.ceil(weight / target - 0.5)).astype(np.int64)
    small = np.where(ways > 1, 0, weight)
    part = ((np.cumsum(small) - small / 2) / target).astype(np.int64)
    shared = int(part[ways == 1].max(initial=-1)) + 1
    large = np.where(ways > 1, ways, 0)
    part = np.where(ways > 1, shared + np.cumsum(large) - large, part)
    return (part, ways), max(1, shared + int(large.sum()))


def firsts(keys: np.ndarray) -> np.ndarray:
    """Where rows of a matrix begin that differ from the one before."""
    return np.flatnonzero(np.r_[True, (np.diff(keys, axis=0) != 0).any(axis=1)])


def numbers(value: pa.Scalar, kind: np.dtype | type) -> np.ndarray:
    """A binary value as the numbers it was made of."""
    return np.frombuffer(value.as_buffer(), kind)


def binaries(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])
