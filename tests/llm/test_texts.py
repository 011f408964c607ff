"""Decontamination, pieces, quality, licences and language model against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from sentencepiece import SentencePieceProcessor

from chronoferry.llm import decontaminate, language_model, licences, pieces, quality
from chronoferry.llm.tokens import Tokenizer
from llm_support import SMALL


def shingles(words):
    n = min(5, len(words))
    return Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))


def brute_matches(docs, items):
    out = {}
    for doc, text in docs:
        words = re.findall(r"\w+", (text or "").lower())
        for item, own in items:
            own = re.findall(r"\w+", own.lower())
            size = min(len(own), len(words))
            if size < min(5, len(own)) or not own:
                continue
            best = 0
            for at in range(len(words) - size + 1):
                a, b = Counter(), Counter()
                width = min(5, len(own))
                for k in range(at, at + size - width + 1):
                    a[tuple(words[k : k + width])] += 1
                for k in range(len(own) - width + 1):
                    b[tuple(own[k : k + width])] += 1
                best = max(best, (a & b).total() / (a | b).total())
            if best >= 0.8:
                out[doc, item] = best
    return out


def test_leaks(spark, documents, benchmark):
    items = [(r.item_id, r.text) for r in benchmark.limit(12).collect()]
    passage = items[3][1].split()
    made = [
        (1000, "before " + items[3][1].upper() + " after"),
        (1001, " ".join(["zero", *passage[:-1], "changed", "words"])),
        (1002, " ".join(passage[:5])),
        (1003, "word " * 3000 + items[5][1].replace(" ", " ,\n")),
        (1004, " ".join(passage[1:])),
    ]
    docs = [(r.doc_id, r.text) for r in documents.limit(30).collect()] + made
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    small = spark.createDataFrame(items, "item_id long, text string")
    want = brute_matches(docs, items)
    assert {1000, 1001, 1003, 1004} <= {d for d, _ in want}
    for options in ({}, {"index_bytes": 700}):
        got = {(r.id, r.item_id): r.similarity for r in decontaminate.contamination(frame, small, **options).collect()}
        assert got == pytest.approx(want)
    kept = {r.doc_id for r in decontaminate.without_leaks(frame, small).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_leaks_of_odd_rows(spark, odd, nothing, benchmark):
    items = spark.createDataFrame([(1, "one two three"), (2, ""), (3, None), (None, "one"), (4, "one")], "item_id long, text string")
    got = {(r.id, r.item_id) for r in decontaminate.contamination(odd, items).collect()}
    assert got == {(3, 1), (2, 4), (3, 4)}
    clean = decontaminate.without_leaks(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 2
    assert decontaminate.contamination(nothing, items).count() == 0
    assert decontaminate.contamination(odd, items.limit(0)).count() == 0
    assert decontaminate.without_leaks(odd, items.limit(0)).count() == odd.count()


HARD = ["", " ", "  ", "a", "a b", " a  b   c ", "\n\n\tx", " \nx \n ", "▁a▁▁b", "日本語テキスト 🙂🙂 é", "x" * 300, "ab" * 500,
        " " * 50 + "z", "\0a\0b", "<s> </s> <unk> <0x41>", "the " * 100, "the\nthe\n\nthe", "\n", "é ﬁ ½"]


def test_pieces_equal_the_library(documents):
    library = SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    rng = np.random.default_rng(2)
    texts = HARD + ["".join(rng.choice(list("abcthe inr▁ \n日é🙂0."), rng.integers(0, 200))) for _ in range(200)]
    texts += [r.text for r in documents.limit(100).collect()]
    for model in (pieces.Pieces(pieces.read_model()), Tokenizer(pieces.read_model())):
        for _ in range(2):  # the second time from what is remembered
            got = model.encode(texts)
            assert [g.tolist() for g in got] == library.encode(texts)
        assert [model.decode(g.tolist()) for g in got] == [library.decode(i) for i in library.encode(texts)]
        assert [model.encode([t])[0].tolist() for t in HARD] == library.encode(HARD)


def test_pieces_of_odd_rows(odd, nothing):
    coded = {r.id: r for r in pieces.coded(odd.where("doc_id is not null")).collect()}
    assert coded[0].ids == [] and coded[0].exact and coded[4].exact and not coded[7].exact
    frame = pieces.encode(odd)
    assert sorted(frame.columns) == sorted(odd.columns) and dict(frame.dtypes)["ids"] == "array<int>"
    back = pieces.decode(frame, name="back").collect()
    assert all(r.back == (r.text or "") for r in back if r.doc_id != 7) and len(back) == odd.count()
    assert pieces.coded(nothing).count() == 0 and pieces.decode(pieces.encode(nothing)).count() == 0


def test_quality(spark):
    where = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, labels).join(labels, "doc_id").where(quality.held_out("doc_id"))
    rows = scored.select("score", "quality").collect()
    right = sum((r.score >= quality.THRESHOLD) == (r.quality == 1) for r in rows)
    assert len(rows) > 80 and right / len(rows) > 0.95
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.h for r in docs.select("doc_id", quality.held_out("doc_id").alias("h")).collect())


def test_trees_by_hand():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, quality.FEATURES))
    y = (x[:, 3] > 0).astype(float)
    trees = quality.fit(x, y)
    assert ((trees.score(x) > 0.5) == (y == 1)).all()

    def slow(row):
        total = trees.base
        for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf):
            at = 0
            while at < len(feature):
                at = 2 * at + (2 if row[feature[at]] > cut[at] else 1)
            total += leaf[at - len(feature)]
        return 1 / (1 + math.exp(-total))

    assert trees.score(x[:50]) == pytest.approx([slow(r) for r in x[:50]])


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, 0), (2, None, 0), (3, 7, 1)], "doc_id long, quality int, toxic int")
    for frame in (odd, nothing):
        for some in (labels, labels.limit(0)):
            got = quality.score(frame, some)
            assert sorted(got.columns) == sorted(frame.columns) and got.count() == frame.count()
            assert all(0 <= r.score <= 1 for r in got.collect())
            assert quality.accepted(frame, some, threshold=0.0).columns == frame.columns
    empty = {r.score for r in quality.score(odd, labels).where("text is null or text = ''").collect()}
    assert len(empty) == 1


def judged(notice):
    """Family, probability and similarity of a paragraph, None if it isn't shown, in plain Python."""
    model = licences.trained()
    grams = licences.grams_of(licences.words_of(notice)) & model.weights.keys()
    if not grams:
        return None
    scores = np.array(model.bias) + np.sum([model.weights[g] for g in grams], axis=0) / np.sqrt(len(grams))
    chance = licences.softmax(scores[None])[0]
    best = int(chance[:-2].argmax())
    if chance[best] >= licences.CONFIDENCE:
        family, p = model.families[best], chance[best]
    elif 1 - chance[-1] >= licences.WORTH_SHOWING:
        family, p = licences.UNKNOWN, chance[-2]
    else:
        return None
    own = [licences.grams_of(licences.words_of(t)) & model.weights.keys() for f, t in licences.templates() if f == family]
    return family, float(p), max((len(g & grams) / len(g) for g in own if g), default=0.0)


def test_licences_by_hand(spark, documents):
    """Every paragraph of all documents, and of all templates and other sentences."""
    sentences = [t for _, t in licences.templates()] + licences.OTHERS
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(10_000 + k, t) for k, t in enumerate(sentences)]
    want = {}
    for doc, text in rows:
        for k, notice in enumerate(regex.split(licences.PARAGRAPHS, text)):
            if (found := judged(notice)) is not None:
                want[doc, k] = (notice, *found)
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.id, r.paragraph) for r in got} == set(want)
    for r in got:
        notice, family, p, share = want[r.id, r.paragraph]
        assert (r.notice, r.family, r.confirmed) == (notice, family, share >= licences.CONFIRMED)
        assert r.probability == pytest.approx(p) and r.similarity == pytest.approx(share)
    shown = {r.id: r for r in got}
    for k, (family, _) in enumerate(licences.templates()):
        assert (shown[10_000 + k].family, shown[10_000 + k].confirmed) == (family, True)
    assert not any(10_000 + k in shown for k in range(len(licences.templates()), len(sentences)))


@pytest.mark.parametrize(
    "text, family",
    [
        ("All rights reserved.", "All rights reserved"),
        ("Copyright 2020 Foo Inc. All rights reserved.", "All rights reserved"),
        ("GPLv3 or later", "GPL"),
        ("Apache-2.0", "Apache"),
        ("Dual MIT/GPL", "MIT or GPL"),
        ("Licensed under the zlib license", "Zlib"),
        ("Distributed under the Boost Software License", "Boost"),
        ("Licensed under the Eclipse Public License 2.0", "EPL"),
        ("CC BY-ND 4.0", "CC-BY-ND"),
        ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND', "MIT"),
        ("This file is licensed under the terms of the MIT license", "MIT"),
        ("# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public\n# License as published by the Free Software Foundation", "GPL"),
        ("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0", "Apache"),
        # Licences without a family.
        ("Licensed under the Frobnicate Public License", "unknown"),
        ("Released under the Xyzzy Source License, version 9", "unknown"),
        # No notices.
        ("Permission is hereby granted, free of", None),
        ("The judge granted him permission to sell copies of the book.", None),
        ("He has a license for his dog.", None),
        ("Wir fahren mit der Bahn und mit dem Bus.", None),
        ("Open source software is used in all companies.", None),
        ("", None),
    ],
)
def test_licence_wording(text, family):
    words = regex.split(licences.PARAGRAPHS, text)
    assert len(words) == 1
    found = judged(text)
    assert (found and found[0]) == family


def test_licences_in_paragraphs(spark):
    lines = ["Released under the", "MIT License.", "Some words here.", "", "CC BY-ND 4.0", "", "  ", "All rights", "reserved.", "end"]
    for ending in ("\n", "\r\n", "\r"):
        got = licences.scan(spark.createDataFrame([(1, ending.join(lines))], "doc_id long, text string")).collect()
        assert sorted((r.paragraph, r.family, r.notice) for r in got) == [
            (0, "MIT", f"Released under the{ending}MIT License."), (2, "CC-BY-ND", "CC BY-ND 4.0"), (3, "All rights reserved", f"All rights{ending}reserved.")
        ]


def test_licences_of_odd_rows(spark, odd, nothing):
    notice = "Released under the MIT License."
    docs = [(1, None, ""), (2, "", ""), (3, "first.\r\n" + notice, "x"), (None, notice, "x"), (4, notice, "x"), (4, notice, "x"),
            (5, "word " * 20_000 + "\n\n" + notice, "x")]
    got = licences.scan(spark.createDataFrame(docs, "doc_id long, text string, FAMILY string")).collect()
    assert sorted((-1 if r.id is None else r.id, r.paragraph, r.family) for r in got) == [
        (-1, 0, "MIT"), (3, 1, "MIT"), (4, 0, "MIT"), (4, 0, "MIT"), (5, 1, "MIT")]
    assert licences.scan(odd).count() == 0 and licences.scan(nothing).count() == 0
    plan = licences.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("InArrow|EvalPython|InPandas|PythonUDF|ArrowUDF", plan)


def brute_counts(docs):
    tokens = {}
    for doc, text in docs:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        tokens[doc] = re.findall(r"[^\x20\x09-\x0D]+", text) + [""]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    c = Counter(w for d, words in tokens.items() if not held[d] for w in words)
    n, v = c.total(), len(c)
    return {
        d: (held[d], len(words), sum(c[w] > 0 for w in words), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
        for d, words in tokens.items()
    }


def test_language_model(documents):
    for size in (12 << 20, 20_000):
        rows = language_model.score(documents, block_bytes=size).collect()
        want = brute_counts([(r.doc_id, r.text) for r in documents.collect()])
        assert len(rows) == len(want)
        for r in rows:
            held, n, known, total, base = want[r.id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
            assert r.base_score == pytest.approx(base) and r.score < 0
        assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_class_chances_sum_to_one():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(language_model.FEATURES + 1, language_model.CLASSES)).astype(np.float32)
    features = rng.integers(0, language_model.FEATURES, (4, 100)).astype(np.uint16)
    assert np.exp(language_model.class_scores(weights, features)).sum(axis=1) == pytest.approx(np.ones(100), abs=1e-4)
    for k, total in ((language_model.TOP, 17), (0, 5)):
        model = language_model.Model(1, 1, np.full(language_model.CLASSES, total), np.full(language_model.CLASSES, 3), weights)
        # Three words with 17 occurrences in all, and the unknown one.
        shares = [(6 + 1), (6 + 1), (5 + 1), 1] if k >= language_model.TOP else [1]
        assert sum(s / model.denominators[k] for s in shares) == pytest.approx(1)


def test_words_before_choose_the_word_in_its_class(spark):
    """Two words of one class that occur equally often, with weights that are equal for all classes."""
    docs = [(0, "leftx abcdone"), (3, "rightx fghdone")] * 50 + [(1, "leftx fghdone"), (1, "rightx abcdone"), (1, "leftx newdone")]
    docs += [(0, f"w{k} " * 200) for k in range(language_model.TOP)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    made = language_model.blocks(frame, "doc_id", "text", language_model.FOLDS, 1 << 20).first().asDict()
    top = {f"w{k}".encode(): k for k in range(language_model.TOP)}
    made["counts"] = np.where([bytes(w) == b"newdone" for w in made["words"]], 0, 60)
    block = language_model.ready(made, top)
    low = block.classes >= language_model.TOP
    leaves = np.zeros((language_model.GROUPS, 64))
    np.add.at(leaves.ravel(), language_model.leaf_of(block.crc, block.classes, 6)[low & (block.counts > 0)], 61)
    total = np.bincount(block.classes, block.counts, language_model.CLASSES)
    words = np.bincount(block.classes, block.counts > 0, language_model.CLASSES)
    model = language_model.Model(int(total.sum()), int(words.sum()), total, words, np.zeros((language_model.FEATURES + 1, language_model.CLASSES), np.float32), top, language_model.Tree.of(leaves))
    steep = np.zeros_like(model.cells)
    for _ in range(5):
        language_model.learn_words(model.cells, steep, model.tree, block)
    score = dict(zip((t for _, t in docs), language_model.scored(model, made).column("score").to_pylist()))
    assert score["leftx abcdone"] > score["leftx fghdone"] + 0.1 and score["rightx fghdone"] > score["rightx abcdone"] + 0.1
    assert score["leftx fghdone"] > score["leftx newdone"]


def test_word_chances_sum_to_one():
    """Whatever the weights are, the words of a class and the unknown one have all of it."""
    rng = np.random.default_rng(0)
    words = [f"{k}en".encode() for k in range(300)]
    counts = rng.integers(1, 50, len(words))
    classes = language_model.classes_of(words, {})
    crc = np.array([zlib.crc32(w) for w in words], np.uint32)
    leaves = np.zeros((language_model.GROUPS, 64))
    np.add.at(leaves.ravel(), language_model.leaf_of(crc, classes, 6), counts + 1)
    total, distinct = np.zeros(language_model.CLASSES), np.zeros(language_model.CLASSES)
    total[classes[0]], distinct[classes[0]] = counts.sum(), len(words)
    model = language_model.Model(1, 1, total, distinct, np.zeros((1, 1)), {}, language_model.Tree.of(leaves))
    tokens, features = np.arange(301), np.repeat(rng.integers(0, language_model.FEATURES, (4, 1)), 301, axis=1).astype(np.uint16)
    block = language_model.Block(
        np.array([301]), tokens, np.append(counts, 0), np.append(classes, classes[0]), features, np.append(classes, classes[0]), np.append(crc, crc[:1])
    )
    plain = language_model.word_scores(model, block)
    assert 10 ** plain == pytest.approx((block.counts + 1) / model.denominators[classes[0]], rel=1e-4)
    model.cells = rng.normal(size=len(model.cells)).astype(np.float32)
    moved = language_model.word_scores(model, block)
    assert sum(10**moved) == pytest.approx(1, abs=1e-4) and abs(moved - plain).max() > 0.1


def test_language_model_of_odd_rows(odd, nothing):
    rows = language_model.score(odd).collect()
    assert len(rows) == odd.count() and all(r.n_tokens >= 1 and math.isfinite(r.score) for r in rows)
    assert language_model.score(nothing).count() == 0


def test_packed_numbers():
    numbers = np.array([0, 1, 70_000, 2**30, 5], np.int32)
    assert language_model.unpressed(language_model.pressed(numbers)).tolist() == numbers.tolist()
    assert SMALL


def test_names_in_another_case_are_replaced(odd):
    coded = pieces.encode(odd.withColumnRenamed("ids", "IDS").withColumnRenamed("row", "Decoded"))
    back = pieces.decode(coded)
    assert [c for c in back.columns if c.lower() in ("ids", "decoded")] == ["ids", "decoded"]
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in back.collect())
