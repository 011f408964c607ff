"""Benchmark decontamination: item-sized windows, SimHash blocks, exact shingle similarity."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoferry.llm.common import chunks, columns_as, free_name, prepare, quoted, strings

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Two windows of similarity 0.8 differ in about 10 of 64 bits; 24 is 5 standard deviations more.
RADIUS = 24
BLOCKS = 8
# Bytes of benchmark text that one index holds; a larger benchmark is searched in slices.
INDEX_BYTES = 16 << 20

WORD = re.compile(r"\w+")
LINK_SCHEMA = "id long, item_id long, similarity double, distance int, start int, words int"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 for each 64-bit hash."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1)


@dataclass
class Size:
    """The items of one length in words and one shingle width."""

    items: list[int] = field(default_factory=list)
    shingles: list[np.ndarray] = field(default_factory=list)
    prints: np.ndarray | None = None
    near: np.ndarray | None = None  # [block, byte, item]: the item's byte there is within the block's radius


class Index:
    """What tasks need to know of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS) -> None:
        self.radius = radius
        self.word_ids: dict[str, int] = {}
        self.sizes: dict[tuple[int, int], Size] = defaultdict(Size)
        self.shingle_ids: dict[tuple[int, ...], int] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            width = min(SHINGLE_WORDS, len(words))
            ids = [self.word_ids.setdefault(w, len(self.word_ids)) for w in words]
            grams = [tuple(ids[k : k + width]) for k in range(len(ids) - width + 1)]
            own = np.array([self.shingle_ids.setdefault(g, len(self.shingle_ids)) for g in grams])
            size = self.sizes[len(words), width]
            size.items.append(item)
            size.shingles.append(own)
        names = list(self.word_ids)
        self.widths = sorted({width for _, width in self.sizes})
        hashes = np.zeros(len(self.shingle_ids), np.uint64)
        self.users = [set() for _ in self.shingle_ids]
        for gram, k in self.shingle_ids.items():
            hashes[k] = shingle_hash([names[w] for w in gram])
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in self.widths:
            grams = [(g, k) for g, k in self.shingle_ids.items() if len(g) == width]
            rows, own = np.array([g for g, _ in grams]), np.array([k for _, k in grams])
            keys = mixed(rows)
            order = np.argsort(keys)
            if len(np.unique(keys)) < len(keys):
                raise ValueError("two shingles of the benchmark have one number; search it in smaller slices")
            self.tables[width] = keys[order], rows[order], own[order]
        apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])
        for key, size in self.sizes.items():
            size.prints = np.concatenate([packed(bits_of(hashes[s]).sum(axis=0, keepdims=True)) for s in size.shingles])
            # Of BLOCKS blocks one differs by at most radius // BLOCKS bits if all differ by at most radius.
            size.near = np.stack([apart[:, size.prints[:, b]] <= radius // BLOCKS for b in range(BLOCKS)])
            for own in size.shingles:
                for s in own.tolist():
                    self.users[s].add(key)

    def anchors(self, ids: np.ndarray, width: int) -> np.ndarray:
        """The shingle id at each position of `ids` (word ids, -1: in no item), -1 where no item has it."""
        n = len(ids) - width + 1
        out = np.full(max(n, 0), -1, np.int64)
        if n <= 0 or width not in self.tables:
            return out
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        at = np.flatnonzero(known[width:] - known[:-width] == width)
        grams = ids[at[:, None] + np.arange(width)[None, :]]
        keys, rows, own = self.tables[width]
        place = np.minimum(np.searchsorted(keys, mixed(grams)), len(keys) - 1)
        same = (rows[place] == grams).all(axis=1)
        out[at[same]] = own[place[same]]
        return out


def mixed(grams: np.ndarray) -> np.ndarray:
    """One number for each row of word ids. Rows of an index with equal numbers are refused when it is built."""
    out = np.zeros(len(grams), np.uint64)
    for column in grams.T:
        out = (out ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def shingle_hash(words: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two lists of shingle ids; a shingle weighs as often as it occurs."""
    ids, n = np.unique(b, return_counts=True)
    at = np.searchsorted(ids, a)
    at[at == len(ids)] = 0
    mine = np.bincount(at[ids[at] == a], minlength=len(ids))
    both = np.minimum(mine, n).sum()
    return float(both / (len(a) + len(b) - both))


def matches(
    index: Index, words: list[str], found: dict[int, np.ndarray]
) -> Iterator[tuple[int, float, int, int, int]]:
    """(item, similarity, distance, start, words) of the best window for each item that has one.

    `found` has the anchors of the text by shingle width. Only windows that share a shingle with some
    item of their size are looked at: the others have the similarity 0 with all of them.
    """
    n = len(words)
    wanted: dict[tuple[int, int], list[int]] = defaultdict(list)
    for width, anchors in found.items():
        for at in np.flatnonzero(anchors >= 0).tolist():
            for key in index.users[anchors[at]]:
                if key[1] == width:
                    wanted[key].append(at)
    for (length, width), ats in wanted.items():
        size, anchors = index.sizes[length, width], found[width]
        span = min(length, n) - width + 1  # shingles of a window; a text shorter than the item is one window
        places = np.array(ats)
        starts = np.unique((places[:, None] - np.arange(span)[None, :]).ravel())
        starts = starts[(starts >= 0) & (starts + span <= len(anchors))]
        # The shingles that these windows cover, each hashed once.
        covered = np.unique((starts[:, None] + np.arange(span)[None, :]).ravel())
        hashes = np.array([shingle_hash(words[k : k + width]) for k in covered.tolist()], np.uint64)
        sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits_of(hashes), axis=0, dtype=np.int32)])
        first = np.searchsorted(covered, starts)
        prints = packed(sums[first + span] - sums[first])
        hit = np.zeros((len(starts), len(size.items)), bool)
        for block in range(BLOCKS):
            hit |= size.near[block][prints[:, block]]
        w, i = np.nonzero(hit)
        distance = np.bitwise_count(prints[w] ^ size.prints[i]).sum(axis=1)
        inside = distance <= index.radius
        w, i, distance = w[inside], i[inside], distance[inside]
        best: dict[int, tuple[float, int, int]] = {}
        seen = np.concatenate([[0], np.cumsum(anchors >= 0)])
        for at, item, bits in zip(starts[w].tolist(), i.tolist(), distance.tolist()):
            own = size.shingles[item]
            # No more shingles can be common than the window has of any item.
            most = min(int(seen[at + span] - seen[at]), len(own))
            if most < SIMILARITY * (span + len(own) - most):
                continue
            alike = overlap(anchors[at : at + span], own)
            if alike >= SIMILARITY and (item not in best or alike > best[item][0]):
                best[item] = (alike, bits, at)
        for item, (alike, bits, at) in best.items():
            yield size.items[item], alike, bits, at, min(length, n)


def index_slices(benchmark: DataFrame, item_col: str, text_col: str, index_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items, in slices of about `index_bytes` of text each: what one pass over the documents searches."""
    items = columns_as(benchmark, item=item_col, text=text_col).where("text is not null")
    items = items.select(F.col("item").cast("long").alias("item"), "text")
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    slices = -(-total // index_bytes)
    for k in range(slices):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k)
        yield sorted((r.item, r.text) for r in own.distinct().collect() if r.item is not None)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    radius: int = RADIUS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """(id, item_id, similarity, distance, start, words): the benchmark items that each row of `docs` holds.

    Words are runs of letters, digits and underscores in lower case. A row holds an item if one of its
    windows of the item's number of words has a weighted similarity of 0.8 or more with it, over shingles
    of five words; the best window is given, the first one of equals. A text shorter than the item is one
    window; an item of fewer than five words is one shingle. Fingerprints of windows are looked up in eight
    blocks of eight bits, which find all within `radius` bits. Rows without text, and items without words or
    id, match nothing; repeated rows match each on its own; an empty benchmark gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = columns_as(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text")
    out = None
    for items in index_slices(benchmark, item_col, item_text_col, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Index(items, radius))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for part in chunks(batches, "text"):
                texts = [words_of(t) for t in strings(part.column("text"))]
                docs = part.column("id").to_pylist()
                found = [
                    (docs[k], *match) for k, anchors in anchored(index, texts) for match in matches(index, texts[k], anchors)
                ]
                columns = list(zip(*found)) or [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
                names = ["id", "item_id", "similarity", "distance", "start", "words"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        found = rows.mapInArrow(run, LINK_SCHEMA)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], LINK_SCHEMA) if out is None else out


def anchored(index: Index, texts: list[list[str]]) -> Iterator[tuple[int, dict[int, np.ndarray]]]:
    """The texts that have a shingle of some item: (number of the text, anchors by shingle width)."""
    get = index.word_ids.get
    sizes = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    # A -1 after each text keeps shingles from reaching into the next one.
    ids = np.fromiter((get(w, -1) for words in texts for w in chain(words, ("",))), np.int64, int((sizes + 1).sum()))
    every = {width: index.anchors(ids, width) for width in index.widths}
    hit = np.zeros(len(texts), bool)
    for anchors in every.values():
        hit[np.searchsorted(starts, np.flatnonzero(anchors >= 0), side="right") - 1] = True
    for k in np.flatnonzero(hit).tolist():
        low, n = int(starts[k]), int(sizes[k])
        yield k, {width: anchors[low : low + max(n - width + 1, 0)] for width, anchors in every.items()}


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object
) -> DataFrame:
    """`docs` without the rows that hold a benchmark item; all columns stay.

    Leaks are found once for each row and named by id and text, so repeated ids with other texts stay.
    """
    name = free_name(docs, "_leak")
    texts = columns_as(docs, doc_id=id_col, text=text_col).withColumn(name, F.xxhash64("doc_id", "text"))
    leaks = contamination(texts, benchmark, name, "text", **options).select(F.col("id").alias(name)).distinct()
    ident, text = (F.col(quoted(c)) for c in (id_col, text_col))
    return docs.withColumn(name, F.xxhash64(ident, text)).join(leaks, name, "left_anti").drop(name)
