"""Byte-level BPE encoding and decoding by the tiktoken library and a rank file.

The library's matcher keeps a state for each character of a white-space run and gives up on very long
ones. Long texts are therefore cut first, only where matches end whatever the rest of the text holds,
so the ids are those of the whole text; runs of white space become single pieces without the matcher.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.llm.common import chunks, columns_as, prepare, quoted, strings

DEFAULT_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Texts of more characters are cut before they are matched, into parts of about as many.
LONG_TEXT = 50_000
# White-space runs of more characters are never given to the matcher.
LONG_RUN = 5_000

# The white space of the matcher's `\s`, as the inside of a character class.
SPACES = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_RUN = re.compile(f"[{SPACES}]{{{LONG_RUN},}}")
_CUT = re.compile(f"[^{SPACES}](?=[{SPACES}])")


def parts(text: str) -> Iterator[tuple[bool, str]]:
    """The text in parts whose matches are those of the whole text, as (one match by itself, part).

    A match of the pattern never goes on from another character into white space, so a part may begin at
    white space after anything else. A white-space run is one match up to its last character,
    which begins a new match if anything follows, and up to its end if nothing does.
    """
    at = 0
    for run in _RUN.finditer(text):
        yield from ((False, part) for part in _cut(text, at, run.start()))
        at = run.end() - (run.end() < len(text))
        yield True, text[run.start() : at]
    yield from ((False, part) for part in _cut(text, at, len(text)))


def _cut(text: str, at: int, end: int) -> Iterator[str]:
    while end - at > LONG_TEXT and (found := _CUT.search(text, at + LONG_TEXT, end)):
        yield text[at : found.end()]
        at = found.end()
    if at < end:
        yield text[at:end]


class Codec:
    """The library's encoder for the ranks of a file and a pattern, without special tokens."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.known = set(table.values())

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LONG_RUN:
            return self._matched(text)
        ids = [self._single(part) if alone else self._matched(part) for alone, part in parts(text)]
        return np.concatenate([np.empty(0, np.int32), *ids])

    def decode(self, ids: list[int]) -> bytes:
        """The bytes that the ids stand for, whether or not they are UTF-8."""
        try:
            return self.encoding.decode_bytes(ids)
        except KeyError:
            raise ValueError(f"no such ids: {sorted(set(ids) - self.known)[:5]}") from None

    def _matched(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def _single(self, piece: str) -> np.ndarray:
        return np.array(self.encoding._encode_single_piece(piece), np.int32)


_LOADED: dict[tuple[bytes, str], Codec] = {}


def loaded(model: tuple[bytes, str]) -> Codec:
    """The codec of these ranks and pattern; a Python worker builds it once."""
    if model not in _LOADED:
        _LOADED[model] = Codec(*model)
    return _LOADED[model]


def read_ranks(path: str) -> bytes:
    """The rank file, which the driver reads and sends to the tasks: bounded by the vocabulary."""
    with open(os.fspath(path), "rb") as file:
        return file.read()


def encode(
    docs: DataFrame,
    text_col: str = "text",
    ranks_path: str = DEFAULT_RANKS,
    pattern: str = public_tokenizers.PATTERN,
    name: str = "ids",
) -> DataFrame:
    """`docs` with the ids of its text as column `name` (array of int).

    Null and empty texts have no ids. Bytes that are no UTF-8 count as replacement characters. A column of
    that name in any case is replaced; other columns may have any name. Rows are independent: an empty
    table stays empty, repeated rows repeat. No match of a pattern may go on from another character into
    white space, and its `\\s+(?!\\S)` must come before other matches of white space.
    """
    shared = _shared(docs, ranks_path, pattern)

    def make(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        codec = loaded(shared.value)
        for part in chunks([batch], "value"):
            yield part, _lists([codec.encode(t) for t in strings(part.column("value"))])

    return _with_column(docs, text_col, name, T.ArrayType(T.IntegerType()), make)


def decode(
    rows: DataFrame,
    ids_col: str = "ids",
    ranks_path: str = DEFAULT_RANKS,
    pattern: str = public_tokenizers.PATTERN,
    name: str = "decoded",
) -> DataFrame:
    """`rows` with the raw bytes of its ids as column `name` (binary); null ids have none, no ids have zero bytes.

    Any ids decode, those that end inside a character too. Null entries among the ids are left out, an id
    without a rank is an error. A column of that name in any case is replaced.
    """
    shared = _shared(rows, ranks_path, pattern)

    def make(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        codec = loaded(shared.value)
        for k in range(batch.num_rows):
            part = batch.slice(k, 1)
            ids = part.column("value").to_pylist()[0]
            back = None if ids is None else codec.decode([i for i in ids if i is not None])
            yield part, pa.array([back], pa.binary())

    return _with_column(rows, ids_col, name, T.BinaryType(), make)


def coded(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str = DEFAULT_RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """(id, ids, n_tokens, decoded): every text encoded, and its bytes decoded again, in one pass. Null texts
    count as empty; other columns are not read."""
    shared = _shared(docs, ranks_path, pattern)
    rows = columns_as(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(shared.value)
        for part in chunks(batches, "text"):
            ids = [codec.encode(t) for t in strings(part.column("text"))]
            counts = pa.array([len(i) for i in ids], pa.int64())
            back = pa.array([codec.decode(i.tolist()) for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), _lists(ids), counts, back], ["id", "ids", "n_tokens", "decoded"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, n_tokens long, decoded binary")


def digest(rows: DataFrame) -> DataFrame:
    """What a query shows of `coded` rows: checksums instead of the ids and bytes."""
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _shared(docs: DataFrame, ranks_path: str, pattern: str):
    prepare(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))


def _with_column(
    docs: DataFrame,
    column: str,
    name: str,
    kind: T.DataType,
    make: Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, pa.Array]]],
) -> DataFrame:
    """`docs` with a column made in Python; the others travel in one struct, so their names don't matter."""
    others = [F.col(quoted(c)) for c in docs.columns if c.lower() != name.lower()]
    packed = docs.select(F.struct(*others).alias("row"), F.col(quoted(column)).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, made in make(batch):
                yield pa.RecordBatch.from_arrays([part.column("row"), made], ["row", "made"])

    schema = T.StructType([packed.schema["row"], T.StructField("made", kind)])
    return packed.mapInArrow(run, schema).select("row.*", F.col("made").alias(name))


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))
