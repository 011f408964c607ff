"""Sharding by a two-pass external shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.config import fresh_folder
from chronoferry.llm.common import prepare, quoted

SHARDS = 24
SEED = 20_231
# Bytes of text that a bucket holds on average; a task shuffles one bucket in memory.
BUCKET_BYTES = 24 << 20
ROW_BYTES = 8


def scatter(docs: DataFrame, id_col: str, text_col: str, buckets: int, seed: int) -> DataFrame:
    """Pass one: rows dealt uniformly over the buckets, each bucket a partition; `order` is the seeded hash
    that fixes a row's place before the shuffle.

    Equal rows share a bucket, which for repeated rows would grow without bound; the number of the row in
    its input partition goes into the bucket of such rows, so that they are dealt like any others.
    """
    rows = docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
        (F.coalesce(F.octet_length(F.col(quoted(text_col))), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.monotonically_increasing_id().alias("number"),
    )
    placed = F.pmod(F.xxhash64(F.lit(seed), F.col(f"row.{quoted(id_col)}"), F.col("number")), F.lit(buckets))
    return rows.withColumn("bucket", placed.cast("int")).repartitionById(buckets, F.col("bucket"))


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniformly random order of n things: numpy's permutation is a Fisher-Yates shuffle."""
    return np.random.Generator(np.random.PCG64(seed)).permutation(n)


def shuffle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> tuple[DataFrame, str]:
    """Pass one and pass two, stored: (row struct, size, bucket, place) and the folder that holds them.

    The stored rows fix the order: whatever is computed from them later sees one and the same shuffle, also
    when a lost executor's tasks run again.
    """
    prepare(docs.sparkSession)
    total = docs.agg(F.sum(F.coalesce(F.octet_length(F.col(quoted(text_col))), F.lit(0)).cast("long") + ROW_BYTES)).first()[0]
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    dealt = scatter(docs, id_col, text_col, buckets, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        # Rows arrive in any order; their number makes the start, and so the shuffle, the same each time.
        start = pc.sort_indices(table.column("number"))
        order = start.take(pa.array(fisher_yates(table.num_rows, [seed, table.column("bucket")[0].as_py()])))
        for at in range(0, table.num_rows, 1000):
            some = table.take(order.slice(at, 1000))
            yield from pa.table({
                "row": some.column("row"),
                "size": some.column("size"),
                "bucket": some.column("bucket"),
                "place": pa.array(np.arange(at, at + some.num_rows)),
            }).combine_chunks().to_batches()

    kind = T.StructType([dealt.schema["row"], *T._parse_datatype_string("size long, bucket int, place long").fields])
    folder = fresh_folder(docs.sparkSession, "shuffled")
    dealt.mapInArrow(run, kind).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(kind).parquet(folder), folder


def sharded(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """`docs` in random order over shards whose numbers of rows differ by one at most: with columns
    shard_size (bytes), shard and slot (place in the shard, gapless from 0).

    The buckets, one after the other, give each row a number in the whole; shard s has an equal stretch of
    those numbers. Null texts have no bytes, repeated rows are rows of their own, an empty table stays
    empty. Columns of the same names, in any case, are replaced.
    """
    rows, _ = shuffle(docs, id_col, text_col, seed, bucket_bytes)
    # One row of 16 bytes for each bucket: the rows in front of it. Small enough for every executor, as a
    # bucket stands for BUCKET_BYTES of text.
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    fronts = counts.select("bucket", "n", F.expr("sum(n) over (order by bucket) - n").alias("front"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    small, large = divmod(total, shards)  # the first `large` shards have one row more
    numbered = rows.join(F.broadcast(fronts.select("bucket", "front")), "bucket").withColumn("number", F.col("front") + F.col("place"))
    edge = large * (small + 1)
    # `small` is 0 only where every row is in front of the edge.
    shard = F.when(F.col("number") < edge, F.expr(f"number div {small + 1}")).otherwise(
        F.lit(large) + F.expr(f"(number - {edge}) div {max(small, 1)}")
    )
    slot = F.when(F.col("number") < edge, F.expr(f"number % {small + 1}")).otherwise(F.expr(f"(number - {edge}) % {max(small, 1)}"))
    kept = [c for c in docs.columns if c.lower() not in ("shard_size", "shard", "slot")]
    return numbered.select(
        *[F.col(f"row.{quoted(c)}").alias(c) for c in kept],
        F.col("size").alias("shard_size"),
        shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
    )


def write(spark: SparkSession, docs: DataFrame, folder: str, **options: object) -> None:
    """The shards as Parquet, one folder `shard=k` each; a reader takes the rows by `slot`."""
    sharded(docs, **options).write.partitionBy("shard").option("compression", "zstd").parquet(folder)
