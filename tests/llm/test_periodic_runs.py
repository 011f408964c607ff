"""Runs of words against a plain search for every period."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from llm_support import SMALL

from chronoferry.llm import periodic_runs
from chronoferry.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words, exponent=4, least=6):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(least, exponent * q):
                found.setdefault((at, end + q), q)
            at = max(end, at + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return [w for k, w in enumerate(words) if k not in gone]


def with_repeats(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("seed", range(40))
def test_grammar_and_runs(seed):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(6):
        parts = [np.empty(0, np.int64)]
        for _ in range(rng.integers(0, 5)):
            block = rng.integers(0, rng.integers(2, 5), rng.integers(1, 8))
            parts.append(np.tile(block, rng.integers(1, 9))[: rng.integers(1, 60)])
        texts.append(np.concatenate(parts))
    words = np.concatenate(texts).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for exponent, least in ((4, 6), (2, 2), (3, 5)):
        start, end, period = periodic_runs.find_runs(words, offsets, exponent, least)
        want = [(s + o, n, q) for t, o in zip(texts, offsets) for s, n, q in brute(t.tolist(), exponent, least)]
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want
    if len(words) > 2:
        grammar = periodic_runs.Grammar(words)
        i, j = np.triu_indices(len(words), 1)
        ahead, back = grammar.forward(i, j), grammar.backward(i, j)
        for a, b, x, y in list(zip(i.tolist(), j.tolist(), ahead.tolist(), back.tolist()))[:: 7]:
            assert words[a : a + x].tolist() == words[b : b + x].tolist()
            assert b + x == len(words) or words[a + x] != words[b + x]
            assert words[a - y : a].tolist() == words[b - y : b].tolist()
            assert a == y or words[a - y - 1] != words[b - y - 1]


def test_long_sequences():
    rng = np.random.default_rng(1)
    for words, want in (
        (np.zeros(200_000, np.int32), (0, 200_000, 1)),
        (np.tile(np.arange(12, dtype=np.int32), 20_000), (0, 240_000, 12)),
        (np.tile(rng.integers(0, 500, 30_000).astype(np.int32), 5), (0, 150_000, 30_000)),
    ):
        runs = periodic_runs.find_runs(words, np.array([0, len(words)]))
        assert want in list(zip(*(r.tolist() for r in runs)))


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    several = 0
    for r in rows:
        words = with_repeats(r.doc_id, words_of(docs[r.doc_id]))
        runs = brute(words)
        several += len(runs) > 1
        # The greatest exact exponent; ties go to the earlier start, then the smaller period.
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(kept(words, runs)))
    assert several and any(r.n_runs for r in rows) and any(r.n_runs == 0 for r in rows)


def test_strongest_is_exact(spark):
    """Exponents that are alike in double precision."""
    runs = [(0, 4 * 10**9 + 3, 10**9), (5, 4 * 10**9 + 4, 10**9), (9, 8 * 10**9 + 8, 2 * 10**9)]
    frame = spark.createDataFrame([(runs,)], "runs array<struct<start: long, length: long, period: long>>")
    assert frame.select(periodic_runs.strongest(frame.runs).alias("best")).first().best.start == 5


def test_odd_rows(spark, odd, nothing):
    rows = periodic_runs.runs(odd).collect()
    texts = odd.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    place = lambda r: (r[0] is None, r[0] or 0, repr(r[1:]))
    want = []
    for doc_id, text in texts:
        words = words_of(text)
        runs = brute(words) if len(words) < 100 else []
        want.append((doc_id, len(words), runs, " ".join(kept(words, runs))))
    got = [(r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows]
    assert sorted(got, key=place) == sorted(want, key=place)
    shown = periodic_runs.digest(periodic_runs.runs(odd)).collect()
    assert len(shown) == len(texts) and all(r.runs_sha256 and r.collapsed_sha256 for r in shown)
    assert periodic_runs.runs(nothing).count() == 0
    text = "x y " * 4 + "end " + "go " * 7
    made = periodic_runs.runs(spark.createDataFrame([(1, text.encode(), 0)], "doc_id long, text binary, RUNS int")).first()
    assert [tuple(r) for r in made.runs] == [(0, 8, 2), (9, 7, 1)] and made.collapsed == "x y end go"


def test_repeats_of_null_and_empty(spark):
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    frame = spark.createDataFrame([(ids[0], None), (ids[1], " \n"), (ids[2], "one"), (None, "a b")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in periodic_runs.with_repeats(frame).collect()}
    assert got == {ids[0]: None, ids[1]: " \n", ids[2]: "one", None: "a b"}
