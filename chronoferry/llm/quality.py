"""Quality classifier: histogram gradient-boosted trees over statistics of the text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoferry.llm.common import chunks, columns_as, extended, free_name, prepare, utf8

# Labelled rows that the trees are fitted on at most: those with the smallest hash of their id.
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
SHRINK = 1.0
LEAST_ROWS = 10

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
KINDS = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t\r\x0b\x0c",
    b"\n",
    bytes(range(128, 256)),
    b".",
    b",",
    b"!?",
    b"|",
    b"#$%&*@",
    bytes(set(PUNCTUATION) - set(b".,!?|#$%&*@")),
]
KIND_OF = np.full(256, len(KINDS), np.uint8)
for _kind, _bytes in enumerate(KINDS):
    KIND_OF[np.frombuffer(_bytes, np.uint8)] = _kind
FEATURES = len(KINDS) + 1 + 11


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES numbers for each text: shares of kinds of bytes, and of words and lines."""
    out = np.zeros((len(texts), FEATURES))
    kinds = len(KINDS) + 1
    for row, text in enumerate(texts):
        size = len(text)
        if not size:
            continue
        count = np.bincount(KIND_OF[np.frombuffer(text, np.uint8)], minlength=kinds)
        words, lines = text.split(), text.split(b"\n")
        n = max(len(words), 1)
        distinct = len(set(words))
        lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
        out[row, :kinds] = count / size
        out[row, kinds:] = (
            np.log1p(size),
            np.log1p(len(words)),
            lengths.mean(),
            lengths.std(),
            (lengths <= 3).mean(),
            distinct / n,
            # Distinct words grow about as the square root of all, so this hardly depends on the length.
            distinct / np.sqrt(n),
            len(lines) / n,
            len(set(lines)) / len(lines),
            count[1] / max(count[0] + count[1], 1),
            sum(w[-1] in PUNCTUATION for w in words) / n,
        )
    return out


@dataclass
class Trees:
    """Boosted trees of one depth as arrays: split s of tree t has the children 2s+1 and 2s+2."""

    base: float
    feature: np.ndarray  # [tree, split]
    cut: np.ndarray  # [tree, split]: greater goes right
    leaf: np.ndarray  # [tree, leaf]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The chance of label 1 for each row of statistics: all rows go down a tree together."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (rows[every, feature[at]] > cut[at])
            total += leaf[at - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Trees for labels 0 and 1. Without rows every score is 0.5; with one label it is near that label."""
    n = len(rows)
    splits, leaves = 2**DEPTH - 1, 2**DEPTH
    share = (labels.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    model = Trees(base, np.zeros((0, splits), np.int64), np.zeros((0, splits)), np.zeros((0, leaves)))
    if n < 2 * LEAST_ROWS or labels.min() == labels.max():
        return model
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, rows.T)])
    slots = np.arange(FEATURES)[None, :] * BINS + binned
    total = np.full(n, base)
    made = []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-total))
        slope, weight = labels - chance, chance * (1 - chance)
        feature, cut = np.zeros(splits, np.int64), np.full(splits, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            width, first = 2**level, 2**level - 1
            place = ((node - first)[:, None] * (FEATURES * BINS) + slots).ravel()
            sums = [
                np.bincount(place, np.repeat(v, FEATURES), width * FEATURES * BINS).reshape(width, FEATURES, BINS)
                for v in (slope, weight, np.ones(n))
            ]
            left = [np.cumsum(s, axis=2) for s in sums]
            whole = [s[:, :, -1:] for s in left]
            g, h, c = left
            gain = g**2 / (h + SHRINK) + (whole[0] - g) ** 2 / (whole[1] - h + SHRINK) - whole[0] ** 2 / (whole[1] + SHRINK)
            gain[(c < LEAST_ROWS) | (whole[2] - c < LEAST_ROWS)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                    feature[first + k], cut[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > cut[node])
        at = node - splits
        leaf = RATE * np.bincount(at, slope, leaves) / (np.bincount(at, weight, leaves) + SHRINK)
        total += leaf[at]
        made.append((feature, cut, leaf))
    model.feature, model.cut, model.leaf = (np.stack(x) for x in zip(*made))
    return model


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS
) -> Trees:
    """Trees fitted on at most `train_rows` labelled documents that are not held out.

    Held out is every id whose crc32, as text, leaves 2 when divided by 4. An id that is labelled
    several times counts once, with its larger label; labels other than 0 and 1 and null ids are ignored.
    """
    marks = columns_as(labels, id="doc_id", label="quality").where("id is not null and label in (0, 1)")
    marks = marks.where(~held_out("id")).groupBy(F.col("id").cast("long").alias("id")).agg(F.max("label").alias("label"))
    chosen = marks.orderBy(F.xxhash64("id"), "id").limit(train_rows)
    rows = columns_as(docs, id=id_col, text=text_col)
    # At most train_rows pairs of numbers: small by their count.
    seen = rows.join(F.broadcast(chosen), "id").dropDuplicates(["id"]).select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("label").cast(pa.float64()), as_lists(statistics(utf8(part.column("text"))))], ["y", "x"]
            )

    got = seen.mapInArrow(run, "y double, x array<double>").toArrow()
    x = got.column("x").combine_chunks().values.to_numpy().reshape(-1, FEATURES) if got.num_rows else np.zeros((0, FEATURES))
    y = got.column("y").to_numpy()
    order = np.lexsort([*x.T, y])  # the same trees in whichever order the rows arrive
    return fit(x[order], y[order])


def as_lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def held_out(column: str, folds: int = 4) -> F.Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == 2, F.lit(False))


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
    name: str = "score",
) -> DataFrame:
    """`docs` with the chance of quality label 1 as column `name`; only the text decides it.

    A null text is an empty one; all empty texts have one score. Repeated rows are scored alike. A
    column that has that name already is replaced. Without usable labels every score is 0.5.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, train_rows))
    return extended(docs, text_col, name, "double", lambda text: pa.array(shared.value.score(statistics(utf8(text)))))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options: object) -> DataFrame:
    """`docs` without the rows that score below `threshold`; all columns stay."""
    name = free_name(docs, "_score")
    return score(docs, labels, name=name, **options).where(F.col(name) >= threshold).drop(name)
