"""SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoferry.llm.common import blocked, chunks, columns_as, components, forest, free_name, pin, prepare, quoted, utf8

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_BITS = 4
# Bytes of text whose shingles are hashed at once: every byte costs about 20 in memory.
HASHED_BYTES = 1 << 20
# Fingerprints of one signature that are compared with each other in one task at a time.
BLOCK = 1024
# Pairs that a task gathers before it reduces them to a forest.
PAIRS = 1 << 20


def text_fingerprints(texts: list[bytes]) -> np.ndarray:
    """The 64-bit fingerprints (uint64) of texts in UTF-8."""
    hashes: list[int] = []
    counts = []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        words = text.lower().split()
        n = len(words)
        if n > SHINGLE_WORDS:
            line = b" ".join(words)
            ends = list(accumulate(map(len, words), lambda at, size: at + 1 + size))
            starts = [0, *(e + 1 for e in ends[: n - SHINGLE_WORDS])]
            hashes += [digest(line[a:b], HASH_SEED) for a, b in zip(starts, ends[SHINGLE_WORDS - 1 :])]
            counts.append(n - SHINGLE_WORDS + 1)
        elif n:
            hashes.append(digest(b" ".join(words), HASH_SEED))
            counts.append(1)
        else:
            counts.append(0)
    out = np.zeros(len(texts), np.uint64)
    sizes = np.array(counts, np.int64)
    full = sizes > 0
    if full.any():
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(sizes) - sizes)[full]
        set_bits = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        over_half = 2 * set_bits > sizes[full][:, None]
        out[full] = np.packbits(over_half, axis=1).view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) of every row; fp has the fingerprint's bits as a signed long.

    Null and empty texts, and texts of white space, have the fingerprint zero.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", HASHED_BYTES):
            fp = text_fingerprints(utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("text_hash"), pa.array(fp.view(np.int64))], ["id", "text_hash", "fp"]
            )

    rows = columns_as(docs, id=id_col, text=text_col).select(
        F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    return rows.mapInArrow(run, "id long, text_hash long, fp long")


def signatures(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(signature, fp): every segment of the fingerprint with one bit left out.

    The 64 bits are cut into so few segments that two fingerprints within `max_bits` agree in one of
    them but for one bit at most; leaving that bit out, both have the same signature. Segments in
    which they agree entirely share all of theirs.
    """
    segments = max_bits // 2 + 1
    edges = [64 * k // segments for k in range(segments + 1)]
    variants = []
    for low, high in zip(edges, edges[1:]):
        mask = (1 << (high - low)) - 1
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(mask))
        # Segments of up to 32 bits leave room for the wildcard's place above them.
        variants += [part.bitwiseAND(F.lit(mask ^ (1 << k))).bitwiseOR(F.lit((low + k) << 32)) for k in range(high - low)]
    if max_bits < 2:
        raise ValueError("max_bits must be at least 2")
    return prints.select("fp", F.explode(F.array(*variants)).alias("signature"))


def close_pairs(run_of: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of one run within `max_bits`; `run_of` is sorted. In pieces, as forests."""
    last = np.searchsorted(run_of, run_of, side="right")
    at = np.arange(len(fp))
    a, b, held, lag = [], [], 0, 1
    while len(at := at[at + lag < last[at]]):
        near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= max_bits]
        a.append(fp[near])
        b.append(fp[near + lag])
        held += len(near)
        if held > PAIRS:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
            if held > PAIRS // 2:
                yield x, y
                a, b, held = [], [], 0
        lag += 1
    if held:
        yield forest(np.concatenate(a), np.concatenate(b))


def links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join all fingerprints within `max_bits` of each other, as forests.

    `prints` has distinct fingerprints. Groups of one signature meet in blocks, so that a signature
    which very many share is compared by many tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((0, 4), np.int64)

        def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(rows):
                run_of = np.concatenate([[0], np.cumsum((rows[1:, :3] != rows[:-1, :3]).any(axis=1))])
                for x, y in close_pairs(run_of, rows[:, 3].view(np.uint64), max_bits):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

        for batch in batches:
            new = np.column_stack([batch.column(k).to_numpy() for k in ("signature", "i", "j", "fp")]).astype(np.int64)
            rows = np.concatenate([rest, new])
            cut = len(rows)
            if cut:  # the last run may go on in the next batch
                other = (rows[:, :3] != rows[-1, :3]).any(axis=1).nonzero()[0]
                cut = int(other[-1]) + 1 if len(other) else 0
            rest = np.ascontiguousarray(rows[cut:])
            yield from found(np.ascontiguousarray(rows[:cut]))
        yield from found(rest)

    met = blocked(signatures(prints, max_bits), "signature", "fp", block).select("signature", "i", "j", "fp")
    dealt = met.repartition("signature", "i", "j").sortWithinPartitions("signature", "i", "j")
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """(id, text_hash, fp, component_id, root) of every row of `docs`.

    root names the component by its smallest fingerprint; component_id is the smallest id that links of at most `max_bits` differing bits reach, the row's
    own included. Rows of equal fingerprint, repeated rows among them, are linked. A row without an id
    links like any other and is never a component_id; a component without ids has null. An empty table
    gives an empty result, and other columns of `docs` are not read.
    """
    rows = pin(fingerprints(docs, id_col, text_col))
    prints = pin(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    joined = components(links(prints.select("fp"), max_bits, block))
    rooted = prints.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp").select("id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one row of each group of near-duplicates: the one with the smallest id.

    All columns stay. Of several rows with that id in the group (repeated rows), one stays.
    """
    return first_of_each(docs, near_duplicates(docs, id_col, text_col, max_bits), id_col, text_col)


def first_of_each(docs: DataFrame, grouped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` whose id is their group's component_id; `grouped` has id, text_hash, root and component_id."""
    seen = grouped.where(F.col("id").eqNullSafe(F.col("component_id")))
    first = seen.groupBy("root", "component_id").agg(F.min("text_hash").alias("text_hash"))
    ident, text = (F.col(f"docs.{quoted(c)}") for c in (id_col, text_col))
    kept = docs.alias("docs").join(
        first.alias("first"),
        ident.cast("long").eqNullSafe(F.col("first.component_id")) & (F.xxhash64(text) == F.col("first.text_hash")),
        "left_semi",
    )
    return one_of_equals(kept, id_col, text_col)


def one_of_equals(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each id and text, the first by a hash of all columns."""
    name = free_name(rows, "_place")
    # Maps have no hash; rows that differ in nothing else are equals.
    ordered = [F.col(quoted(c)) for c, kind in rows.dtypes if "map<" not in kind]
    window = Window.partitionBy(F.col(quoted(id_col)), F.xxhash64(F.col(quoted(text_col)))).orderBy(F.xxhash64(*ordered))
    return rows.withColumn(name, F.row_number().over(window)).where(F.col(name) == 1).drop(name)
