"""Sharding, training order, token counts and the pipeline."""

from collections import Counter

import numpy as np
import pytest
from llm_support import SMALL
from sentencepiece import SentencePieceProcessor

import __spark_entry__ as entry
import corpus_pipeline
from chronoferry.config import fresh_folder
from chronoferry.llm import decontaminate, pieces, quality, rollups, sharding, simhash, training_order
from chronoferry.llm.queries import WITHDRAWN


def check_shards(rows, total, shards):
    counts = Counter(r.shard for r in rows)
    assert len(rows) == total
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


@pytest.mark.parametrize("shards, size", [(24, 50_000), (7, 1 << 30), (500, 20_000)])
def test_shards(documents, shards, size):
    rows = sharding.sharded(documents, shards, bucket_bytes=size).collect()
    check_shards(rows, documents.count(), shards)
    assert {(r.doc_id, r.text) for r in rows} == {(r.doc_id, r.text) for r in documents.collect()}
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.35


def test_shards_stay_the_same(documents):
    a, b = (sharding.sharded(documents, bucket_bytes=100_000) for _ in range(2))
    place = lambda f: sorted((r.doc_id, r.shard, r.slot) for r in f.collect())
    assert place(a) == place(b)


def test_shards_of_odd_rows(spark, odd, nothing):
    frame = sharding.sharded(odd, 5, bucket_bytes=1000)
    check_shards(frame.collect(), odd.count(), 5)
    assert frame.columns == [*odd.columns, "shard_size", "shard", "slot"]
    assert sharding.sharded(nothing, 5).count() == 0
    renamed = sharding.sharded(odd.withColumnRenamed("lang", "Slot").withColumnRenamed("source", "SHARD"), 5, bucket_bytes=1000)
    assert [c for c in renamed.columns if c.lower() in ("slot", "shard")] == ["shard", "slot"]
    folder = fresh_folder(spark, "clash")
    renamed.write.partitionBy("shard").parquet(folder)
    assert spark.read.parquet(folder).count() == odd.count()


@pytest.mark.parametrize("count", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(count):
    for key in (1, 2**63 + 5):
        assert sorted(training_order.permuted(np.arange(count), count, key).tolist()) == list(range(count))


def test_training_order(spark, documents):
    folder = fresh_folder(spark, "order")
    placed = training_order.materialise(documents, folder, length=256, shard_rows=100).collect()
    records = {r.slot: r.record for r in training_order.read_shards(spark, folder, 256, 2, 100).collect()}
    assert sorted(records) == sorted(r.slot for r in placed) == list(range(len(placed)))
    assert all(r.shard == r.slot // 100 and r.offset == r.slot % 100 * 513 for r in placed)
    library = SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    want = {r.doc_id: [*library.encode(r.text), 2] for r in documents.collect()}
    # Sequences of a text, one after the other in input order, have its tokens.
    stored = Counter()
    for r in placed:
        ids = np.frombuffer(records[r.slot], "<u2")[: r.n_tokens].tolist()
        stored.update(ids)
        whole = [t for d in r.doc_ids for t in want[d]]
        assert any(whole[k : k + len(ids)] == ids for k in range(len(whole)))
    assert stored == Counter(t for ids in want.values() for t in ids)


def test_training_order_of_odd_rows(spark, odd, nothing):
    folder = fresh_folder(spark, "order")
    placed = training_order.materialise(odd, folder, length=64, shard_rows=10).collect()
    assert sum(r.n_tokens for r in placed) == sum(len(i.ids) + 1 for i in pieces.coded(odd).collect())
    assert training_order.read_shards(spark, folder, 64, 2, 10).count() == len(placed)
    assert training_order.materialise(nothing, fresh_folder(spark, "order")).count() == 0


def test_records_on_their_way_are_small(spark, documents):
    """Stored once and shuffled once, they must leave room for the shards; whatever the order, the ids stay the same."""
    plain = training_order.sequences(documents).orderBy("part", "number").select("record")
    order = training_order.by_frequency(documents)
    raw = [r.record for r in plain.collect()]
    for some in (order, order[::-1].copy()):
        packed = training_order.sequences(documents, order=some).orderBy("part", "number").select("record")
        back = packed.select(training_order.unpacked(spark, some)("record").alias("record"))
        assert [r.record for r in back.collect()] == raw
        if some is order:
            assert sum(len(r.record) for r in packed.collect()) < 0.58 * sum(map(len, raw))


def groups(frame):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.bytes) for r in frame.collect()}


def test_rollups(spark, documents):
    library = SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    want = {}
    for r in documents.collect():
        size = len(r.text.encode())
        for tokenizer, tokens in (("bytes", size), ("piece_bpe_32k", len(library.encode(r.text)))):
            if tokenizer == "bytes" and r.source == WITHDRAWN:
                continue
            old = want.get((r.source, r.lang, tokenizer), (0, 0, 0))
            want[r.source, r.lang, tokenizer] = (old[0] + 1, old[1] + tokens, old[2] + size)
    assert groups(entry.queries()["op10_token_counts"](spark, SMALL)) == want
    assert documents.where(documents.source == WITHDRAWN).count() > 0


def test_batches_commit_once(spark):
    kind = "doc_id long, source string, lang string, tokenizer string, tokens long, bytes long"
    old = spark.createDataFrame([(1, "a", "en", "t", 5, 50), (2, "a", "en", "t", 7, 70), (3, None, None, "t", 1, 9)], kind)
    new = spark.createDataFrame([(1, "a", "en", "t", 6, 60), (2, "b", "en", "t", 7, 70), (4, "a", "de", "t", None, None)], kind)
    ledger = rollups.Ledger(spark, fresh_folder(spark, "ledger"))
    assert ledger.totals().count() == 0
    assert ledger.commit("one", rollups.between(old.limit(0), old)) and not ledger.commit("one", rollups.between(old.limit(0), old))
    assert groups(ledger.totals()) == {("a", "en", "t"): (2, 12, 120), (None, None, "t"): (1, 1, 9)}
    for _ in range(2):
        ledger.commit("two", rollups.between(old, new))
    assert groups(ledger.totals()) == {("a", "en", "t"): (1, 6, 60), ("b", "en", "t"): (1, 7, 70), ("a", "de", "t"): (1, 0, 0)}
    # A write that has not ended doesn't count, and can be made again.
    spark.range(1).write.parquet(ledger.path("three") + "/part")
    assert len(ledger.batches()) == 2 and ledger.commit("three", rollups.between(new, new.limit(0)))
    assert ledger.totals().count() == 0


def test_counts_of_odd_rows(odd, nothing):
    counted = rollups.counted(odd).collect()
    assert len(counted) == odd.count() and all(r.tokens == 0 for r in counted if not r.text)
    assert rollups.counted(nothing).count() == 0


def test_pipeline(spark, documents, benchmark):
    rows = documents
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scores = {r.doc_id: r.score for r in quality.score(documents, labels).collect()}
    good = {d for d, s in scores.items() if s >= quality.THRESHOLD}
    kept = documents.where(documents.doc_id.isin(sorted(good)))
    first = {r.id for r in simhash.near_duplicates(kept).where("id = component_id").collect()}
    kept = kept.where(kept.doc_id.isin(sorted(first)))
    clean = first - {r.id for r in decontaminate.contamination(kept, benchmark).collect()}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(clean) and all(r.exact for r in got)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SMALL)
        assert rows.columns == documents.columns, name


def test_stages_take_odd_rows(spark, odd, nothing):
    for frame in (odd, nothing):
        rows = frame
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SMALL)
        assert rows.count() <= frame.count()
