"""Operators over the whole corpus against plain definitions."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from benchloom.llm import decontaminate, fm_index, jaccard, language_model, substrings
from benchloom.llm.components import components

ITEMS = [(1, brute.PASSAGE), (2, "One TWO three"), (3, None), (4, ""), (5, brute.PASSAGE), (5, "six"), (None, "again and again the")]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def by_text(rows):
    return sorted(rows, key=repr)


def test_index_finds_every_occurrence():
    draw = np.random.default_rng(3)
    text = draw.integers(0, 4, 4000)
    text[-1] = 0
    index = fm_index.FMIndex(text, 3)
    for size in (1, 2, 5, 9):
        patterns = draw.integers(1, 4, (50, size))
        low, high = index.search(patterns)
        for pattern, a, b in zip(patterns, low, high):
            wanted = [i for i in range(len(text) - size + 1) if (text[i : i + size] == pattern).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == wanted


@pytest.mark.parametrize("small", [False, True])
def test_decontamination(spark, monkeypatch, small):
    if small:  # many blocks, many shards
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
        monkeypatch.setattr(decontaminate, "SHARD_BYTES", 1)
    got = decontaminate.hits(brute.documents(spark), items(spark), result="found_here").select("doc_id", "found_here.*")
    wanted = []
    for key, text in brute.ROWS:
        n, hit, found = brute.window_hits(text, ITEMS)
        wanted.append((key, n, hit, sorted(found - {None})))
    assert by_text((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()) == by_text(wanted)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in got.collect())


def test_decontamination_of_nothing(spark):
    assert decontaminate.hits(brute.documents(spark, []), items(spark)).count() == 0
    clean = decontaminate.hits(brute.documents(spark), items(spark, []), result="mine").select("mine.n_hit").distinct().collect()
    assert [r.n_hit for r in clean] == [0]


@pytest.mark.parametrize("gathered", [3 << 20, 50])
def test_substrings(spark, monkeypatch, gathered):
    monkeypatch.setattr(substrings, "GATHERED", gathered)
    got = substrings.remove(brute.documents(spark)).collect()
    assert by_text((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == by_text(brute.without_repeats(brute.ROWS))


def test_sketch_loses_nothing(spark):
    # A sketch far too small only lets more windows through.
    rows = [(i, " ".join(f"u{(i * 7 + j) % 61}" for j in range(200))) for i in range(30)]
    documents = brute.documents(spark, rows)
    sketch = substrings.build_sketch(documents, "text", 20, 1 << 16)
    folder, bits = substrings.build_first_places(documents, "doc_id", "text", 20, 1 << 16, sketch)
    assert folder and bits == 0
    got = substrings.remove(documents).collect()
    assert by_text((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == by_text(brute.without_repeats(rows))


def test_substrings_of_nothing(spark):
    assert substrings.remove(brute.documents(spark, [])).count() == 0
    short = substrings.remove(brute.documents(spark, [(1, "a b"), (2, None)])).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in short] == [(2, 0, "a b"), (0, 0, "")]


def near_rows():
    base = [f"t{i}" for i in range(120)]
    rows = list(brute.ROWS)
    for i in range(25):  # a chain of edits, where not all are similar to all
        text = list(base)
        for j in range(i):
            text[(j * 5) % 120] = f"e{j}"
        rows.append((100 + i, " ".join(text)))
    rows += [(200 + i, " ".join(base[: 60 + i])) for i in range(0, 60, 4)]
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_jaccard(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rows = near_rows()
    got = jaccard.classes(brute.documents(spark, rows)).collect()
    wanted = brute.similar_classes(rows)
    # A document without words is alone, under its own key.
    assert by_text((r.doc_id, r.class_id, r.n_links) for r in got) == by_text(wanted)


def test_jaccard_in_small_batches(spark):
    # Some batches hold no link inside a run, others do.
    rows = [(i, f"word{i} " * 7 + f"end{i % 300}") for i in range(400)] + near_rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = jaccard.classes(brute.documents(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert by_text((r.doc_id, r.class_id, r.n_links) for r in got) == by_text(brute.similar_classes(rows))


def test_one_of_each(spark):
    rows = near_rows()
    kept = jaccard.one_of_each(brute.documents(spark, rows))
    assert kept.columns == brute.documents(spark, []).columns
    wanted = {k for k, c, _ in brute.similar_classes(rows) if k == c}
    assert {r.doc_id for r in kept.collect()} == wanted
    assert kept.where("doc_id = 4").count() == 1  # it stands twice


def test_depth_meets_the_recall():
    perfect = [1.0] * jaccard.DIGITS
    d = jaccard.depth(0.8, perfect)
    assert jaccard.expected(0.8, d) >= jaccard.RECALL > jaccard.expected(0.8, d + 1)
    assert jaccard.depth(0.95, perfect) > d
    assert jaccard.depth(0.95, [1.0, 1.0, 0.999, 0.99, 0.9, 0.9]) == 2


def test_copies_are_looked_up_as_texts_are():
    # The prefix that a copy shares is the one of the labels that it gets as a set of its own.
    draw = np.random.default_rng(4)
    sets = [np.sort(draw.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 4, 5, 7, 10, 83, 400)]
    counts = np.array([len(x) for x in sets])
    label, reach = jaccard.labels(np.repeat(np.arange(len(sets)), counts), np.concatenate(sets), counts, 0.8)
    for row, hashes in enumerate(sets):
        part = len(hashes) // 5
        copies = min(len(hashes) // part, 5) if part else 0
        assert (reach[row, copies:] == -1).all()
        for c in range(copies):
            copy = np.delete(hashes, np.arange(c * part, (c + 1) * part))
            other = jaccard.labels(np.zeros(len(copy), int), copy, np.array([len(copy)]), 0.8)[0][0]
            shared = [
                sum(x >> s == y >> s for s in range(0, 10 * jaccard.DIGITS, 10)) for x, y in zip(label[row].tolist(), other.tolist())
            ]
            assert reach[row, c] == max(shared)


@pytest.mark.parametrize("recall", [jaccard.RECALL, 0.5])
def test_recall_of_pairs_at_the_threshold(spark, monkeypatch, recall):
    # 1,200 pairs of similarity 0.8: 80 of 100 shingles. A weaker target leaves longer prefixes, and loses some.
    monkeypatch.setattr(jaccard, "RECALL", recall)
    monkeypatch.setattr(jaccard.depth, "__defaults__", (recall,))
    pairs = [[f"p{i}w{j}" for j in range(104)] for i in range(1200)]
    rows = [(2 * i, " ".join(x)) for i, x in enumerate(pairs)] + [(2 * i + 1, " ".join(x[:84])) for i, x in enumerate(pairs)]
    got = jaccard.classes(brute.documents(spark, rows)).where("n_links = 1 and class_id = 2 * floor(doc_id / 2)").count() / 2
    assert got == 1200 if recall > 0.9 else 1000 < got <= 1200


@pytest.mark.parametrize("partitions", [1, 13])
def test_nodes_that_ask_for_shorter_prefixes(spark, partitions):
    # Node 1 asks for one digit: all that share its first digit are linked; the others only by the whole label.
    bits = jaccard.DIGIT_BITS * (jaccard.DIGITS - 1)
    rows = [(i, [(i % 3 << bits) + i // 2 * 2], 1 if i == 1 else jaccard.DIGITS) for i in range(60)]
    nodes = spark.createDataFrame(rows, "`set` bigint, labels array<bigint>, own int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        links = jaccard.forest_links(nodes, jaccard.DIGITS, 1)
        got = {r.node: r.root for r in components(links).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {i: 1 for i in range(60) if i % 3 == 1}


def test_jaccard_of_nothing(spark):
    assert jaccard.classes(brute.documents(spark, [])).count() == 0
    assert jaccard.one_of_each(brute.documents(spark, [(1, None), (2, "")])).count() == 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95), (7, 7)] + [(200, x) for x in range(201, 400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    wanted = {i: 0 for i in range(61)} | {90: 90, 95: 90, 100: 90} | {x: 200 for x in range(200, 400)}
    assert got == wanted


@pytest.mark.parametrize("gathered", [3 << 20, 40])
def test_language_model(spark, monkeypatch, gathered):
    monkeypatch.setattr(language_model, "GATHERED", gathered)
    rows = [(k, t) for k, t in brute.ROWS if k is not None] + [(50 + i, "The cat sat. the dog sat " * i) for i in range(6)]
    documents = brute.documents(spark, rows)
    model = language_model.fit(documents, F.col("doc_id") % 3 != 1)
    got = language_model.score(documents, model).collect()
    wanted = brute.kneser_ney([t for k, t in rows if k % 3 != 1], [t for _, t in rows])
    found = sorted((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got)
    for a, b in zip(found, sorted((k, *w) for (k, _), w in zip(rows, wanted)), strict=True):
        assert a == pytest.approx(b, rel=1e-9)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in got)


def test_language_model_of_nothing(spark):
    documents = brute.documents(spark)
    model = language_model.fit(documents, F.lit(False))
    assert language_model.score(documents, model).agg(F.sum("score")).first()[0] == 0
    assert language_model.score(documents.limit(0), model).count() == 0


@pytest.mark.parametrize("kind", ["smallint", "int", "string", "decimal(9,0)"])
def test_items_of_other_types(spark, kind):
    frame = items(spark).select(F.col("item_id").cast(kind).alias("item_id"), "text")
    got = decontaminate.hits(brute.documents(spark), frame, result="mine")
    assert got.where("size(mine.items) > 0").count() > 0
