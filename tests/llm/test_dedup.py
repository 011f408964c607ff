"""SimHash and embedding near-duplicates against brute force."""

import itertools
import re

import numpy as np
import pytest
import xxhash
from llm_support import SMALL

from chronoferry.llm import embeddings, simhash
from chronoferry.llm.common import components, forest


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints(documents):
    texts = [t for _, t in [(r.doc_id, r.text) for r in documents.limit(40).collect()]] + ["", None, "A b", "x " * 50, "É é  À"]
    mine = simhash.text_fingerprints([(t or "").encode() for t in texts])
    assert mine.tolist() == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("block", [1024, 2])
def test_simhash_components(documents, block):
    rows = {r.id: r for r in simhash.near_duplicates(documents, block=block).collect()}
    prints = {r.doc_id: brute_fingerprint(r.text) for r in documents.collect()}
    linked = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert linked
    assert {k: r.fp % 2**64 for k, r in rows.items()} == prints
    assert {k: r.component_id for k, r in rows.items()} == classes(prints, linked)


def test_all_close_fingerprints_are_linked(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63 - 1, 60)
    prints = set(base.tolist())
    for bits in range(1, 7):
        flips = np.array([sum(1 << int(b) for b in rng.choice(63, bits, False)) for _ in base])
        prints |= set((base ^ flips).tolist())
    prints = sorted(prints)
    got = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), block=50).collect()
    close = [(a, b) for a, b in itertools.combinations(prints, 2) if (a % 2**64 ^ b % 2**64).bit_count() <= 4]
    assert all((r.a % 2**64 ^ r.b % 2**64) for r in got)
    assert classes(prints, [(r.a, r.b) for r in got]) == classes(prints, close)


def test_simhash_odd_rows(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.id: r.component_id for r in rows if r.id is not None}
    assert by_id[0] == by_id[1] == 0 and by_id[9] == by_id[8] == 8 and by_id[5] == by_id[4] == 4
    assert {r.component_id for r in rows if r.id is None} == {0, None}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 0, 2, 3, 4, 6, 7, 8]
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_forest_and_components(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    want = classes(range(300), zip(a.tolist(), b.tolist()))
    nodes, roots = forest(a, b)
    assert dict(zip(nodes.tolist(), roots.tolist())) == {n: r for n, r in want.items() if n != r}
    edges = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert all(want[n] == r for n, r in got.items()) and all(n in got for n, r in want.items() if n != r)


@pytest.mark.parametrize("block", [4096, 40])
def test_embeddings(spark, block):
    rng = np.random.default_rng(4)
    table = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    table += [(1000 + 5 * k + n, v + rng.normal(size=len(v)) * 0.03 * n) for k, (_, v) in enumerate(table[:80]) for n in range(5)]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in table], "vec_id long, embedding array<double>")
    rows = {r.id: r for r in embeddings.near_duplicates(vectors, block=block).collect()}
    x = np.stack([v / np.linalg.norm(v) for _, v in table])
    near = x @ x.T >= 0.95
    ids = [k for k, _ in table]
    linked = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near)) if i != j]
    assert linked
    want = classes(ids, linked)
    for k, i in enumerate(ids):
        assert (rows[i].n_links, rows[i].component_id, rows[i].kept) == (near[k].sum() - 1, want[i], want[i] == i)


def test_cells_lose_no_neighbour():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pivots = embeddings.spread(x, 12)
    reach = 0.4
    row, cell, home = embeddings.cells(x, pivots, reach)
    own = dict(zip(row[home].tolist(), cell[home].tolist()))
    visits = set(zip(row.tolist(), cell.tolist()))
    away = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert all((i, own[j]) in visits for i, j in zip(*np.nonzero(away <= reach)))


def test_embeddings_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, []), (6, None),
            (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [-1.0, 0.0]),
            (12, [1e300, 1e298])]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, n int, node string")
    got = sorted((r.id or 0, r.n_links, r.component_id or 0, r.kept) for r in embeddings.near_duplicates(frame).collect())
    linked = [(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (3, 4, 1, False), (12, 4, 1, False)]
    assert got == sorted(linked + [(k, 0, k, True) for k in (0, 4, 5, 6, 7, 8, 9, 10, 11)])
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def unit_groups(rng, size=24):
    """Random rows, a crowd of near copies, and chains of rows about as far apart as links reach."""
    crowd = rng.normal(size=size) + rng.normal(size=(60, size)) * 0.05
    steps = rng.normal(size=size) + np.cumsum(rng.normal(size=(40, size)) * 0.25, axis=0)
    x = np.concatenate([rng.normal(size=(200, size)), crowd, steps]).astype(np.float32)
    return x[rng.permutation(len(x))]


@pytest.mark.parametrize("tile", [1024, 16])
def test_blocks_count_every_pair_once(monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rng = np.random.default_rng(6)
    x = unit_groups(rng)
    copies = rng.integers(1, 4, len(x))
    unit = embeddings.unit_rows(x)
    pivots = embeddings.spread(unit, 7).astype(np.float32)
    axes = np.eye(x.shape[1], 10, dtype=np.float32)
    halves = []
    for k in (0, 1):
        mine = np.arange(k, len(x), 2)
        home = embeddings.homes(unit[mine].astype(np.float32), pivots)
        mine, home = mine[np.argsort(home, kind="stable")], np.sort(home)
        halves.append((mine, embeddings.Block(1000 * k, home, copies[mine], x[mine], pivots, axes)))
    edges = []
    for a, b in ((0, 0), (0, 1), (1, 1)):
        edges += zip(*(e.tolist() for e in embeddings.compare(halves[a][1], halves[b][1], 0.95)))
    node = {1000 * k + n: int(i) for k, (mine, _) in enumerate(halves) for n, i in enumerate(mine)}
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    for mine, block in halves:
        assert block.links.tolist() == (near @ copies)[mine].tolist()
    linked = [(i, j) for i, j in zip(*np.nonzero(near))]
    got = classes(range(len(x)), [(node[a], node[b]) for a, b in edges])
    assert got == classes(range(len(x)), linked)


def test_embeddings_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 30)
    monkeypatch.setattr(embeddings, "FEW_VECTORS", 60)
    x = unit_groups(np.random.default_rng(8))
    x = np.concatenate([x, np.repeat(x[:1], 50, axis=0), x[1:30]])
    rows = [(k // 2 if k > 320 else k, v.tolist()) for k, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.id, r.n_links, r.component_id) for r in embeddings.near_duplicates(frame).collect())
    unit = embeddings.unit_rows(x)
    near = unit @ unit.T >= 0.95
    links = classes(range(len(x)), list(zip(*np.nonzero(near))))
    least = {}
    for k, root in links.items():
        least[root] = min(least.get(root, rows[k][0]), rows[k][0])
    assert got == sorted((rows[k][0], int(near[k].sum()) - 1, least[links[k]]) for k in range(len(x)))


def test_embeddings_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SAMPLE", 2000)
    vectors = np.random.default_rng(9).normal(size=(20_000, 64)).astype(np.float32)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")

    def written():
        store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
        stages = store.stageList(None, False, False, none, None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = written()
    assert embeddings.near_duplicates(frame).count() == len(vectors)
    assert written() - before < 2 * vectors.nbytes
