"""Byte-level BPE against the library on whole texts, and round trips."""

import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from llm_support import SMALL
from pyspark.sql import functions as F

from chronoferry.llm import byte_pairs
from chronoferry.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    with open(byte_pairs.DEFAULT_RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_pairs.Codec(byte_pairs.read_ranks(byte_pairs.DEFAULT_RANKS), public_tokenizers.PATTERN)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_cuts_change_nothing(library, codec, monkeypatch):
    monkeypatch.setattr(byte_pairs, "LONG_TEXT", 30)
    monkeypatch.setattr(byte_pairs, "LONG_RUN", 6)
    monkeypatch.setattr(byte_pairs, "_RUN", re.compile(f"[{byte_pairs.SPACES}]{{6,}}"))
    bits = ["a", "bc", "'s", "'", " ", "  ", "\n", "\t", " " * 7, "\n" * 9, "\x1c", "　", "\x85", "é", "1", "23", "!?",
            "的是", "​", "'ll", " \n \n  \n", "<|endoftext|>", "x" * 50]
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 80)))
        ids = codec.encode(text).tolist()
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", [" " * 700_000 + "x", "\n" * 500_000, "a" * 300_000, "的" * 100_000, "ab c " * 100_000, "x" + "\t " * 300_000])
def test_very_long_texts(codec, text):
    ids = codec.encode(text)
    assert codec.decode(ids.tolist()) == text.encode()


def test_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_byte_pairs"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(docs[r.doc_id].encode())


def test_odd_rows(spark, odd, nothing, library):
    rows = byte_pairs.encode(odd)
    assert rows.columns == odd.columns  # `ids` is there already and gets replaced
    for r in rows.collect():
        assert r.ids == library.encode_ordinary(r.text or "")
    back = byte_pairs.decode(rows)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    assert byte_pairs.encode(nothing).count() == byte_pairs.coded(nothing).count() == 0
    assert byte_pairs.coded(odd).count() == odd.count()
    renamed = byte_pairs.encode(odd.withColumnRenamed("ids", "IDS"))
    assert [c for c in renamed.columns if c.lower() == "ids"] == ["ids"]


def test_any_ids_decode(spark, library):
    ids = library.encode_ordinary("日本語 ÿ")
    rows = [([i],) for i in ids] + [([],), (None,), ([ids[0], None],)]
    got = byte_pairs.decode(spark.createDataFrame(rows, "ids array<int>")).collect()
    want = [b"".join(library.decode_bytes([i]) for i in r[0] if i is not None) if r[0] is not None else None for r in rows]
    assert [None if r.decoded is None else bytes(r.decoded) for r in got] == want
    with pytest.raises(Exception, match="no such ids"):
        byte_pairs.decode(spark.createDataFrame([([10**6],)], "ids array<int>")).collect()


def test_invalid_bytes_and_other_ranks(spark):
    frame = spark.createDataFrame([(1, b"ab\xff c")], "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
    row = byte_pairs.coded(frame, ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken")).first()
    assert bytes(row.decoded).decode() == "ab� c" and row.n_tokens == len(row.ids)
