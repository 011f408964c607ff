"""What the operators of this folder share: pinned tables, text batches, links and components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.config import ship_package, work_folder

# Bytes of text that a Python task works on at once; a longer text is a piece of its own.
CHUNK_BYTES = 4 << 20
# Bytes that Spark hands to a Python worker at once.
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Send the package to the workers, bound the batches that they get, and make sure that checkpoints
    have a shared folder."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_folder(spark))


def pin(frame: DataFrame) -> DataFrame:
    """The rows, stored in the shared checkpoint folder: computed once, free of their lineage, and
    removed by Spark when nothing refers to them any more."""
    prepare(frame.sparkSession)
    return frame.checkpoint()


def columns_as(frame: DataFrame, **names: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that no other column can clash."""
    return frame.select([F.col(quoted(column)).alias(name) for name, column in names.items()])


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def extended(
    docs: DataFrame, text: str, name: str, kind: str, make: Callable[[pa.Array], pa.Array], limit: int = CHUNK_BYTES
) -> DataFrame:
    """`docs` with column `name` of type `kind`, made by a Python function of batches of its text column.

    The other columns travel in one struct, so their names don't matter; a column `name`, in any case, is replaced.
    """
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in kept]).alias("row"), F.col(quoted(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", limit):
            yield pa.RecordBatch.from_arrays([part.column("row"), make(part.column("text"))], ["row", "made"])

    made = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("made", T._parse_datatype_string(kind))]))
    return made.select("row.*", F.col("made").alias(name))


def free_name(docs: DataFrame, name: str) -> str:
    """`name`, with underscores at the end until no column has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """The texts; null is empty, and bytes that are no UTF-8 are replacement characters."""
    return [t.decode("utf-8", "replace") for t in utf8(column)]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of values as (value, smallest value of its component), without the smallest itself."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(root, up := root[root]):
            root = up
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a long, b long) as (node, root): root is the smallest node.

    Alternates two star contractions until nothing changes. Every step is a minimum per node, merged
    on the map side, and a join with it, so a node with very many links is never gathered in one task.
    Nodes without links, or linked with themselves only, have no row.
    """
    links = pin(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    seen = None
    while True:
        mark = links.agg(
            F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))"), F.expr("sum(pmod(xxhash64(lo, hi), 1000000007))")
        ).first()
        if tuple(mark) == seen or mark[0] == 0:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        seen = tuple(mark)
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        floor = wide.groupBy("hi").agg(F.min("lo").alias("m"))
        narrow = wide.join(floor, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = pin(narrow.union(floor.select("hi", "m")).distinct())


def blocked(rows: DataFrame, key: str, by: str, block: int) -> DataFrame:
    """Rows with the pair of blocks (i, j) in which those of one `key` meet.

    A key with more than `block` rows is dealt by a hash of `by` into blocks of about that size, and each
    pair of blocks is a group of its own: no pair of rows is lost, and no group outgrows two blocks. All
    other keys have the one pair (0, 0).
    """
    crowded = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > block)
    met = rows.join(crowded, key, "left")
    met = met.withColumn("_blocks", F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)).cast("int"))
    met = met.withColumn("_own", F.pmod(F.xxhash64(by), "_blocks"))
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return met.select(
        *rows.columns, F.least("_own", "_other").cast("int").alias("i"), F.greatest("_own", "_other").cast("int").alias("j")
    )
