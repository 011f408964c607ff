"""Language-model scores by a hashed maximum-entropy model with class-factored softmax."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoferry.config import fresh_folder
from chronoferry.llm.common import chunks, columns_as, prepare, utf8

FOLDS = 7
# The most frequent words are classes of their own; all others are grouped by their ending.
TOP = 20
GROUPS = 12
CLASSES = TOP + GROUPS
ENDING = 2
FEATURES = 1 << 15
ROUNDS = 2
RATE = 0.15
BATCH = 16_384
# Bytes of text in a block, whose words are looked up together.
BLOCK_BYTES = 16 << 20
# Tokens whose features are computed together.
PIECE = 1 << 18
# Training tasks for each core: every task sends its weights once a round, so there are not too many.
TASKS_PER_CORE = 2
# Rows of weights that are summed up together.
STRETCH = 64
# The words of a group are the leaves of a binary tree, found by the bits of their crc32: so many bits at most.
DEPTH = 16
# Weights of pairs of a feature and a place in a tree, by hash; tokens that share a step, and those whose ways are
# followed together (few, so that they stay in the cache); kinds of features (see `ready`).
CELL_BITS = 18
WORD_BATCH = 1 << 15
WAYS = 1 << 12
WORD_KINDS = (0,)
END = b""

BLOCK_SCHEMA = "block long, ids array<long>, held array<boolean>, sizes binary, tokens binary, listed binary, words array<binary>, seen array<int>"
SCORE_SCHEMA = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def blocks(docs: DataFrame, id_col: str, text_col: str, folds: int, block_bytes: int) -> DataFrame:
    """The texts as numbers: per block its documents' tokens as places in the block's own list of words,
    and how often each word occurs in its training documents. The end sign is the empty word."""
    rows = columns_as(docs, id=id_col, text=text_col).select(
        F.col("id").cast("long").alias("id"),
        F.coalesce(F.crc32(F.col("id").cast("string")) % folds == 2, F.lit(False)).alias("held"),
        "text",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in chunks(batches, "text", block_bytes):
            flat: list[bytes] = []
            sizes = []
            for text in utf8(part.column("text")):
                words = text.lower().split()
                flat += words
                flat.append(END)
                sizes.append(len(words) + 1)
            words = list(dict.fromkeys(flat))
            place = dict(zip(words, range(len(words))))
            tokens = np.fromiter(map(place.__getitem__, flat), np.int32, len(flat))
            held = part.column("held").to_numpy(zero_copy_only=False)
            seen = np.bincount(tokens[~np.repeat(held, sizes)], minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([held.tolist()]),
                 pa.array([np.array(sizes, np.int32).tobytes()]), pa.array([pressed(tokens)]),
                 pa.array([listed(words)]), pa.array([words], pa.list_(pa.binary())), pa.array([seen], pa.list_(pa.int32()))],
                ["block", "ids", "held", "sizes", "tokens", "listed", "words", "seen"],
            )
            number += 1

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def pressed(numbers: np.ndarray) -> bytes:
    """Small numbers (int32) small: their lowest bytes, then the next ones, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpressed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def listed(words: list[bytes]) -> bytes:
    """Words, which hold no white space, in little room."""
    return zstandard.ZstdCompressor(level=3).compress(b" ".join(words))


def unlisted(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b" ")


def classes_of(words: list[bytes], top: dict[bytes, int]) -> np.ndarray:
    """The class of each word: its own for the most frequent ones, else by its ending, as in `score`."""
    endings = [w[-ENDING:] for w in words]
    group = {e: zlib.crc32(e) % GROUPS + TOP for e in set(endings)}
    classes = np.fromiter(map(group.__getitem__, endings), np.uint8, len(words))
    for k, word in enumerate(words):
        if word in top:
            classes[k] = top[word]
    return classes


@dataclass
class Tree:
    """What the corpus counts say of the words in each group, as a binary tree by the bits of their crc32."""

    depth: int
    leaves: np.ndarray  # [group, path]; counts plus one of the words there
    odds: np.ndarray  # [group << depth | place]; logarithm of upper by lower branch; the root has place 1

    @staticmethod
    def of(leaves: np.ndarray) -> Tree:
        depth = leaves.shape[1].bit_length() - 1
        odds = np.zeros(leaves.shape, np.float32)
        mass = leaves
        for level in reversed(range(depth)):
            lower, upper = mass[:, 0::2], mass[:, 1::2]
            with np.errstate(divide="ignore", invalid="ignore"):
                # A branch without words is as good as impossible; where both are, no word comes.
                odds[:, 1 << level : 2 << level] = np.clip(np.nan_to_num(np.log(upper) - np.log(lower), posinf=80, neginf=-80), -80, 80)
            mass = lower + upper
        return Tree(depth, leaves, odds.ravel())


@dataclass
class Model:
    """What scoring needs: weights by feature and class, and what the corpus counts say of each class."""

    train_tokens: int
    distinct: int
    class_total: np.ndarray  # tokens of each class in training
    class_words: np.ndarray  # distinct words of each class in training
    weights: np.ndarray  # [feature, class]; the last row is for every token
    top: dict[bytes, int] = field(default_factory=dict)  # the words that are classes of their own
    tree: Tree = field(default_factory=lambda: Tree.of(np.zeros((GROUPS, 1))))
    cells: np.ndarray = field(default_factory=lambda: np.zeros(1 << CELL_BITS, np.float32))  # weights of the trees

    @property
    def denominators(self) -> np.ndarray:
        """What a word's count plus one is divided by within its class; unknown words are one more word."""
        return np.where(np.arange(CLASSES) < TOP, 1.0, self.class_total + self.class_words + 1.0)


@dataclass
class Block:
    """One block, ready for the model: features and class of each token, and counts of each word."""

    sizes: np.ndarray
    tokens: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    features: np.ndarray  # [feature kind, token]
    target: np.ndarray
    crc: np.ndarray  # of each word


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    # FEATURES is a power of two.
    return ((x ^ (x >> np.uint64(29))) & np.uint64(FEATURES - 1)).astype(np.uint16)


def ready(row: dict, top: dict[bytes, int]) -> Block:
    """Word before, the two words before, the word before that alone, and the classes of both."""
    sizes = np.frombuffer(row["sizes"], np.int32)
    tokens = unpressed(row["tokens"])
    words = unlisted(row["listed"])
    classes = classes_of(words, top)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    first = np.cumsum(sizes) - sizes
    inside = {1: np.ones(len(tokens), bool)}
    inside[1][first] = False
    inside[2] = inside[1].copy()
    inside[2][first[sizes > 1] + 1] = False
    one, two, three = np.uint64(0x51ED270B), np.uint64(0x2545F491), np.uint64(0x6C8E9CF5)
    features = np.empty((4, len(tokens)), np.uint16)
    padded = np.concatenate([np.zeros(2, np.int32), tokens])
    for at in range(0, len(tokens), PIECE):
        to = min(at + PIECE, len(tokens))
        back = []
        for distance in (1, 2):
            before, known = padded[at + 2 - distance : to + 2 - distance], inside[distance][at:to]
            back.append(np.where(known, hashes[before], np.uint64(distance)))
            back.append(np.where(known, classes[before], np.uint8(CLASSES)).astype(np.uint64))
        w1, c1, w2, c2 = back
        features[0, at:to] = spread(w1)
        features[1, at:to] = spread(w1 * np.uint64(31) ^ (w2 + one))
        features[2, at:to] = spread(w2 ^ two)
        features[3, at:to] = spread(c1 * np.uint64(CLASSES + 1) + c2 + three)
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    return Block(sizes, tokens, np.array(row["counts"], np.int64), classes, features, classes[tokens], crc)


def class_scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Logarithm of each class's probability, one row for each token."""
    scores = raw_scores(weights, features)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return scores


def raw_scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Sums of weights, with 0 for the likeliest class of each token."""
    scores = weights.take(features[0], axis=0)
    for kind in features[1:]:
        scores += weights.take(kind, axis=0)
    scores += weights[-1]
    scores -= scores.max(axis=1, keepdims=True)
    return scores


def learn(weights: np.ndarray, squares: np.ndarray, touched: np.ndarray, block: Block) -> None:
    """Gradient steps over a block's training tokens, batch by batch, on the given arrays."""
    for at in range(0, len(block.target), BATCH):
        features, target = block.features[:, at : at + BATCH], block.target[at : at + BATCH]
        n = len(target)
        slope = raw_scores(weights, features)
        np.exp(slope, out=slope)
        slope /= slope.sum(axis=1, keepdims=True)
        slope[np.arange(n), target] -= 1
        slope /= n
        flat = features.ravel().astype(np.intp)
        each = np.ascontiguousarray(slope.T)
        sums = np.empty(weights.T.shape, np.float32)
        for k, own in enumerate(each):
            sums[k] = np.bincount(flat, np.tile(own, len(features)), len(weights))
        sums[:, -1] = each.sum(axis=1)
        sums = np.ascontiguousarray(sums.T)
        squares += sums * sums
        far = np.sqrt(squares)
        far += 1e-8
        sums *= np.float32(RATE)
        sums /= far
        weights -= sums
        touched += np.bincount(flat, minlength=len(weights))
        touched[-1] += n


def training_part(block: Block, held: np.ndarray) -> Block:
    keep = ~np.repeat(held, block.sizes)
    return Block(
        block.sizes[~held], block.tokens[keep], block.counts, block.classes, block.features[:, keep], block.target[keep], block.crc
    )


def leaf_of(crc: np.ndarray, classes: np.ndarray, depth: int) -> np.ndarray:
    """Group and path of words that are not classes of their own."""
    return (classes.astype(np.int32) - TOP << depth) + (crc & np.uint32((1 << depth) - 1)).astype(np.int32)


def way(tree: Tree, leaves: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """[level, token]: the odds by counts on the way to the leaves, which branch is theirs (1 or -1), and the cells
    of the weights that change these odds, for each kind of feature."""
    path, levels = leaves & (1 << tree.depth) - 1, np.arange(tree.depth, dtype=np.int32)[:, None]
    ahead = path >> tree.depth - 1 - levels
    place = (leaves - path) + (np.int32(1) << levels) + (ahead >> 1)
    branch = ((ahead & 1) * 2 - 1).astype(np.float32)
    hashed = place.astype(np.uint32) * np.uint32(0x85EBCA6B)
    hashed ^= hashed >> np.uint32(15)
    cells = []
    for kind in WORD_KINDS:
        feature = (features[kind].astype(np.uint32) + np.uint32(kind * FEATURES)) * np.uint32(0xC2B2AE35)
        feature ^= feature >> np.uint32(13)
        cells.append((hashed ^ feature) * np.uint32(0x9E3779B1) >> np.uint32(32 - CELL_BITS))
    return tree.odds.take(place), branch, cells


def learn_words(cells: np.ndarray, squares: np.ndarray, tree: Tree, block: Block) -> None:
    """Gradient steps on the weights of the trees, over a block's training tokens of groups."""
    if not tree.depth:
        return
    leaves = leaf_of(block.crc, block.classes, tree.depth)
    for at in range(0, len(block.target), WORD_BATCH):
        hit, slopes = [], []
        for start in range(at, min(at + WORD_BATCH, len(block.target)), WAYS):
            some = start + np.flatnonzero(block.target[start : min(start + WAYS, at + WORD_BATCH)] >= TOP)
            slope, branch, used = way(tree, leaves[block.tokens[some]], block.features[:, some])
            for cell in used:
                slope += cells.take(cell)
            slope *= branch
            np.exp(slope, out=slope)
            slope += 1
            np.divide(branch, slope, out=slope)
            hit += [cell.ravel() for cell in used]
            slopes += [slope.ravel()] * len(used)
        sums = np.bincount(np.concatenate(hit), np.concatenate(slopes), len(cells)).astype(np.float32)
        squares += sums * sums
        sums *= np.float32(RATE)
        sums /= np.sqrt(squares + 1)
        cells += sums


def word_scores(model: Model, block: Block) -> np.ndarray:
    """Log10 probability of each token's word within its class: the softmaxes of all branches on the way to its leaf,
    whose odds by counts are changed by the weights of the features, times its share by counts among the words of
    that leaf. Without weights this is its share in the class. A word that training doesn't have is one more word."""
    tree, counts = model.tree, block.counts
    within = np.zeros(len(counts))
    known = (block.classes >= TOP) & (counts > 0)
    other = (block.classes >= TOP) & (counts == 0)
    whole = model.denominators[block.classes]
    within[other] = -np.log10(whole[other])
    leaves = leaf_of(block.crc, block.classes, tree.depth)
    share = (counts[known] + 1) / tree.leaves.ravel()[leaves[known]]
    within[known] = np.log10(share * (1 - 1 / whole[known]))
    out = within[block.tokens]
    for at in range(0, len(out) if tree.depth else 0, WAYS):
        some = at + np.flatnonzero(known[block.tokens[at : at + WAYS]])
        odds, branch, used = way(tree, leaves[block.tokens[some]], block.features[:, some])
        for cell in used:
            odds += model.cells.take(cell)
        odds *= -branch
        np.exp(odds, out=odds)
        odds += 1
        out[some] -= np.log(odds, out=odds).sum(axis=0, dtype=np.float64) / np.log(10)
    return out


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() if name != "counts" else batch.column(name)[k].values.to_numpy()
                   for name in batch.schema.names}


def one_round(spark: SparkSession, numbered: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classes and of the trees after every task has gone over its blocks, each from the model's:
    their mean, weighted by how many tokens had the feature in a task, for the trees by the squares of their slopes."""
    shared = spark.sparkContext.broadcast(model)
    rows = len(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        own, cells = model.weights.copy(), model.cells.copy()
        squares, touched, steep = np.zeros_like(own), np.zeros(rows, np.float32), np.zeros_like(cells)
        for row in rows_of(batches):
            block = training_part(ready(row, model.top), np.array(row["held"], bool))
            learn(own, squares, touched, block)
            learn_words(cells, steep, model.tree, block)
        # Stretches of the trees' weights have numbers after those of the classes.
        parts = [(k, own[k : k + STRETCH], touched[k : k + STRETCH]) for k in range(0, rows, STRETCH)]
        wide = STRETCH * CLASSES
        parts += [(rows + k, cells[k : k + wide, None], steep[k : k + wide]) for k in range(0, len(cells), wide)]
        parts = [p for p in parts if p[2].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in parts], pa.int32()), pa.array([TaskContext.get().partitionId()] * len(parts), pa.int32()),
             pa.array([(p[1] * p[2][:, None]).astype(np.float32).tobytes() for p in parts], pa.binary()),
             pa.array([p[2].tobytes() for p in parts], pa.binary())],
            ["stretch", "task", "sums", "touched"],
        )

    def added(group: pa.Table) -> pa.Table:
        group = group.sort_by("task")  # sums of floats depend on their order
        total = {
            name: np.sum([np.frombuffer(v, np.float32) for v in group.column(name).to_pylist()], axis=0, dtype=np.float64)
            for name in ("sums", "touched")
        }
        return pa.table({
            "stretch": group.column("stretch").slice(0, 1), "task": group.column("task").slice(0, 1),
            **{name: pa.array([v.astype(np.float32).tobytes()]) for name, v in total.items()},
        })

    schema = "stretch int, task int, sums binary, touched binary"
    parts = numbered.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism).mapInArrow(run, schema)
    # In two steps: no group has more rows than a small part of the tasks.
    some = parts.groupBy("stretch", F.pmod("task", F.lit(8))).applyInArrow(lambda t: added(t), schema)
    weights, cells = model.weights.copy(), model.cells.copy()
    for row in some.groupBy("stretch").applyInArrow(added, schema).toLocalIterator():
        many = np.frombuffer(row.touched, np.float32)
        sums = np.frombuffer(row.sums, np.float32).reshape(len(many), -1)
        used = many > 0
        at, means = (row.stretch, weights) if row.stretch < rows else (row.stretch - rows, cells[:, None])
        means[at : at + len(many)][used] = sums[used] / many[used, None]
    return weights, cells


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    Words are what white space of ASCII separates, A-Z in lower case, then one end sign for each text; null
    and empty texts are the end sign alone. Rows whose crc32 of the id, as text, leaves 2 when divided by
    `folds` are held out; rows without an id are trained on. base_score is the log10 probability by counts
    plus one over all training tokens. score is that of the model: a softmax over classes of words, whose
    weights belong to hashed features of the words before, times one over the words of the class, as a tree of
    choices with weights of the word before (see `word_scores`). Weights are trained on all training tokens in rounds over disjoint parts of the corpus. Repeated rows
    count as often as they occur; an empty table gives an empty result; without training rows all classes
    are equally likely.
    """
    spark = docs.sparkSession
    prepare(spark)
    stored = fresh_folder(spark, "blocks")
    blocks(docs, id_col, text_col, folds, block_bytes).write.option("compression", "zstd").parquet(stored)
    made = spark.read.parquet(stored)
    exploded = made.select("block", F.posexplode(F.arrays_zip("words", "seen")).alias("pos", "w"))
    exploded = exploded.select("block", "pos", F.col("w.words").alias("word"), F.col("w.seen").cast("long").alias("seen"))
    counted = fresh_folder(spark, "words")
    exploded.groupBy("word").agg(F.sum("seen").alias("c")).write.parquet(counted)
    words = spark.read.parquet(counted)
    top = [bytes(r.word) for r in words.where("c > 0").orderBy(F.desc("c"), "word").limit(TOP).collect()]
    ranked = spark.createDataFrame([(w, k) for k, w in enumerate(top)], "word binary, rank int")
    group = F.pmod(F.crc32(F.substring("word", -ENDING, ENDING)), F.lit(GROUPS)) + TOP
    # At most TOP rows.
    classed = words.join(F.broadcast(ranked), "word", "left").select(
        "word", "c", F.coalesce("rank", group).cast("int").alias("class")
    )
    totals = classed.groupBy("class").agg(F.sum("c").alias("c"), F.count_if(F.col("c") > 0).alias("v")).collect()
    class_total, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in totals:
        class_total[row["class"]], class_words[row["class"]] = row.c, row.v
    # Twice as many leaves as there are words, at most GROUPS << DEPTH: a few MB.
    depth = min(DEPTH, int(2 * class_words[TOP:].sum() / GROUPS).bit_length())
    path = F.crc32("word").bitwiseAND(F.lit((1 << depth) - 1))
    leaf = (F.shiftleft(F.col("class").cast("long") - TOP, depth) + path).cast("int")
    massed = classed.where((F.col("class") >= TOP) & (F.col("c") > 0)).groupBy(leaf.alias("leaf")).agg(F.sum(F.col("c") + 1).alias("mass"))
    massed = massed.toArrow()
    leaves = np.zeros(GROUPS << depth)
    leaves[massed.column("leaf").to_numpy()] = massed.column("mass").to_numpy()
    tree = Tree.of(leaves.reshape(GROUPS, -1))
    # A block has as many of these as it has words: BLOCK_BYTES at most, or those of one text.
    looked_up = exploded.join(words, "word").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "c"))).alias("w")
    )
    looked_up = looked_up.select("block", F.col("w.c").alias("counts"))
    joined = fresh_folder(spark, "numbered")
    made.drop("seen", "words").join(looked_up, "block").write.option("compression", "zstd").parquet(joined)
    remove(spark, stored)
    numbered = spark.read.parquet(joined)

    weights = np.zeros((FEATURES + 1, CLASSES), np.float32)
    model = Model(int(class_total.sum()), int(class_words.sum()), class_total, class_words, weights, {r: k for k, r in enumerate(top)}, tree)
    if model.train_tokens:
        weights[-1] = np.log((class_total + 1) / (class_total + 1).sum())
        for k in range(ROUNDS):
            part = numbered.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == k)
            model.weights, model.cells = one_round(spark, part, model)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield scored(shared.value, row)

    return numbered.mapInArrow(run, SCORE_SCHEMA)


def scored(model: Model, row: dict) -> pa.RecordBatch:
    block = ready(row, model.top)
    n = len(block.tokens)
    score = word_scores(model, block)
    for at in range(0, n, BATCH):
        part = slice(at, at + BATCH)
        target = block.target[part]
        score[part] += class_scores(model.weights, block.features[:, part])[np.arange(len(target)), target] / np.log(10)
    base = np.log10((block.counts + 1) / (model.train_tokens + 1 * (model.distinct + 1)))[block.tokens]
    first = np.cumsum(block.sizes) - block.sizes
    known = (block.counts > 0)[block.tokens]
    per_doc = [np.add.reduceat(known, first, dtype=np.int64), *(np.add.reduceat(v, first) for v in (base, score))]
    return pa.RecordBatch.from_arrays(
        [pa.array(row["ids"], pa.int64()), pa.array(row["held"]), pa.array(block.sizes.astype(np.int64)), pa.array(per_doc[0]),
         pa.array(np.full(len(block.sizes), model.train_tokens)), pa.array(per_doc[1]), pa.array(per_doc[2])],
        ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
