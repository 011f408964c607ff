"""Token ids as binary shards in training order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

from chronoferry.config import fresh_folder
from chronoferry.llm.common import chunks, columns_as, prepare, strings
from chronoferry.llm.pieces import DEFAULT_MODEL, read_model
from chronoferry.llm.tokens import loaded

SEQUENCE = 4096
SHARD_ROWS = 2048
KEY = 0x5EED_0F_0DE2
ROUNDS = 4
# How hard records are compressed on their way to the shards.
PRESS = 1
CHUNK = 2 << 20
# Texts, and characters of each, that say which ids are frequent.
KNOWN_TEXTS = 200
KNOWN_CHARS = 2000
# Shuffle partitions that write shards at most; each of them writes several where there are more shards.
WRITERS = 20_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A good spread of 64-bit numbers (the finishing steps of a well-known hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permuted(index: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """Each index below `count` to a place below `count`, all different, by a keyed Feistel network.

    The network permutes the numbers of an even number of bits; a result beyond `count` goes through it
    again until it is inside (cycle-walking), less than 4 times on average.
    """
    half = np.uint64(max(1, -(-max(count - 1, 1).bit_length() // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    keys = mixed(np.uint64(key & (2**64 - 1)) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.asarray(index, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mixed(right ^ k) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= count]
    return out.astype(np.int64)


def by_frequency(docs: DataFrame, text_col: str = "text", model_path: str = DEFAULT_MODEL) -> np.ndarray:
    """All ids of the tokenizer, first those that are frequent in a few of the texts.

    Records that hold places in this list instead of ids compress better, because most places are small. They become
    the same ids again whatever the texts are, so any few do.
    """
    tokenizer = loaded(read_model(model_path))
    some = columns_as(docs, text=text_col).select(F.substring("text", 1, KNOWN_CHARS).alias("text")).limit(KNOWN_TEXTS)
    ids = tokenizer.encode(strings(some.toArrow().column("text").combine_chunks()))
    seen = np.bincount(np.concatenate([*ids, [tokenizer.end]]).astype(np.int64), minlength=tokenizer.size)
    return np.argsort(-seen, kind="stable").astype(token_kind(tokenizer.size))


def sequences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str = DEFAULT_MODEL,
    length: int = SEQUENCE,
    order: np.ndarray | None = None,
) -> DataFrame:
    """(part, number, n_tokens, doc_ids, record): the tokens of each input partition, one text after the
    other with an end sign after each, cut into sequences of `length`.

    A record has `length` ids of 2 or 4 bytes; the last of a partition is filled up with end signs, which
    n_tokens doesn't count. doc_ids are the ids of the texts that a sequence has tokens of, in order. Null and
    empty texts are an end sign alone. With an `order` of all ids (see `by_frequency`) records are compressed, for
    storing and shuffling, and `unpacked` makes the same of them.
    """
    prepare(docs.sparkSession)
    places = None if order is None else docs.sparkSession.sparkContext.broadcast(np.argsort(order).astype(order.dtype))
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    rows = columns_as(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(shared.value)
        kind = token_kind(tokenizer.size)
        press = zstandard.ZstdCompressor(level=PRESS)
        part, number = TaskContext.get().partitionId(), 0
        rest, owners = np.empty(0, kind), np.empty(0, np.int64)
        ids: list[int | None] = []

        def cut(tokens: np.ndarray, whole: int) -> pa.RecordBatch:
            nonlocal number
            many, records, docs_of = [], [], []
            for at in range(0, whole, length):
                piece = tokens[at : at + length]
                many.append(len(piece))
                owner = owners[at : at + length]
                docs_of.append([ids[k] for k in owner[np.flatnonzero(np.diff(owner, prepend=-1))].tolist()])
                if len(piece) < length:
                    piece = np.concatenate([piece, np.full(length - len(piece), tokenizer.end, kind)])
                records.append(piece.tobytes() if places is None else press.compress(places.value.take(piece).tobytes()))
            first, number = number, number + len(many)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(many), pa.int32()), pa.array(range(first, number), pa.int64()), pa.array(many, pa.int32()),
                 pa.array(docs_of, pa.list_(pa.int64())), pa.array(records, pa.binary())],
                ["part", "number", "n_tokens", "doc_ids", "record"],
            )

        for batch in chunks(batches, "text", CHUNK):
            texts = tokenizer.encode(strings(batch.column("text")))
            sizes = np.array([len(t) + 1 for t in texts])
            flat = np.full(int(sizes.sum()), tokenizer.end, kind)
            ends = np.zeros(len(flat), bool)
            ends[np.cumsum(sizes) - 1] = True
            flat[~ends] = np.concatenate(texts)
            old = len(ids)
            ids += batch.column("id").to_pylist()
            rest = np.concatenate([rest, flat])
            owners = np.concatenate([owners, np.repeat(np.arange(old, len(ids)), sizes)])
            whole = len(rest) // length * length
            if whole:
                yield cut(rest, whole)
            rest, owners = rest[whole:], owners[whole:]
            if len(owners):  # only texts that go on are still needed
                ids, owners = ids[int(owners[0]) :], owners - owners[0]
            else:
                ids = []
        if len(rest):
            yield cut(rest, len(rest))

    return rows.mapInArrow(run, "part int, number long, n_tokens int, doc_ids array<long>, record binary")


def token_kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def materialise(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str = DEFAULT_MODEL,
    length: int = SEQUENCE,
    shard_rows: int = SHARD_ROWS,
    key: int = KEY,
) -> DataFrame:
    """Write the shards, and return (slot, shard, offset, n_tokens, doc_ids): where each sequence is.

    Every sequence has a slot by a keyed permutation of all. Shard k, the folder `shard=k`, is one file with the slots from k *
    shard_rows on: a record, a line break, the next record, so that slot s begins at (s % shard_rows) * (bytes of a
    record + 1). A reader that has stopped goes on at any slot by seeking there. Rows of an empty table make no
    shards; repeated rows are tokens of their own.
    """
    spark = docs.sparkSession
    stored = fresh_folder(spark, "sequences")
    # Records are compressed once, by the task that makes them, and stay so up to their shard.
    order = by_frequency(docs, text_col, model_path)
    sequences(docs, id_col, text_col, model_path, length, order).write.option("compression", "none").parquet(stored)
    rows = spark.read.parquet(stored)
    # One row of 16 bytes for each input partition: the sequences in front of it. Every executor can hold them.
    fronts = rows.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", "n", F.expr("sum(n) over (order by part) - n").alias("front")
    )
    count = fronts.agg(F.sum("n")).first()[0] or 0

    @arrow_udf(T.LongType())
    def slot(index: pa.Array) -> pa.Array:
        return pa.array(permuted(index.to_numpy(), count, key))

    placed = rows.join(F.broadcast(fronts.select("part", "front")), "part").withColumn("slot", slot(F.col("front") + F.col("number")))
    placed = placed.withColumn("shard", F.expr(f"slot div {shard_rows}").cast("int"))
    size = length * order.itemsize
    shards = max(1, -(-count // shard_rows))
    each = -(-shards // WRITERS)
    writer = F.floor(F.col("shard") / each).cast("int")
    dealt = placed.select("shard", "slot", "record").repartitionById(-(-shards // each), writer)
    ordered = dealt.sortWithinPartitions("shard", "slot").select(
        "shard", unpacked(spark, order)(F.col("record")).cast("string").alias("value")
    )
    ordered.write.partitionBy("shard").option("lineSep", "\n").text(folder)
    return placed.select(
        "slot", "shard", (F.col("slot") % shard_rows * (size + 1)).alias("offset"), F.col("n_tokens").cast("long"), "doc_ids"
    )


def unpacked(spark: SparkSession, order: np.ndarray) -> Callable[[Column], Column]:
    """Makes records, compressed with this order of ids, what they are in a shard."""
    shared = spark.sparkContext.broadcast(order)

    @arrow_udf(T.BinaryType())
    def plain(records: pa.Array) -> pa.Array:
        press, ids = zstandard.ZstdDecompressor(), shared.value
        return pa.array([ids.take(np.frombuffer(press.decompress(r), ids.dtype)).tobytes() for r in records.to_pylist()], pa.binary())

    return plain


def read_shards(spark: SparkSession, folder: str, length: int = SEQUENCE, width: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(slot, record) of the shards' files; a task holds one shard at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    shard = F.regexp_extract("path", "shard=([0-9]+)/", 1).cast("long")
    stride = length * width + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = content.as_buffer()
                records = [data[at : at + stride - 1].to_pybytes() for at in range(0, len(data), stride)]
                slots = np.arange(len(records)) + shard * shard_rows
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(records, pa.binary())], ["slot", "record"])

    return files.select(shard.alias("shard"), "content").mapInArrow(run, "slot long, record binary")
