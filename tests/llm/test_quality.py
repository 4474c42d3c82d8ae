"""Quality by rules and by compression."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from benchloom.llm import boosting, compression, quality_rules, ranks

GOOD = "the quick river runs over stones and under bridges while people watch from quiet banks in spring".split()


def corpus(n=400):
    draw = random.Random(5)
    rows = []
    for i in range(n):
        own = [draw.choice(GOOD) + draw.choice(["", "", "s", "ed"]) for _ in range(60)]
        text = " ".join(own) if i % 4 else " ".join(x.upper() + draw.choice(["!!", "***", "###"]) for x in own)
        rows.append((1000 + i, text))
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(k, int(k % 4 != 0)) for k, _ in rows], "doc_id bigint, quality int")


def test_statistics():
    import pyarrow as pa

    base, features = quality_rules.statistics(pa.array([t for _, t in brute.ROWS], pa.string()))
    assert [tuple(x) for x in base.tolist()] == [brute.statistics(t) for _, t in brute.ROWS]
    assert features.shape[1] == len(quality_rules.FEATURES) and np.isfinite(features).all()


def test_rules_learn(spark):
    rows = corpus()
    documents = brute.documents(spark, rows + brute.ROWS)
    rules = quality_rules.fit(documents, labels(spark, rows[:300]))
    got = quality_rules.assess(documents, rules, result="verdict")
    assert got.columns == [*documents.columns, "verdict"]
    held_out = {r.doc_id: r.verdict for r in got.where("doc_id >= 1300").collect()}
    assert np.mean([held_out[k].kept == (k % 4 != 0) for k, _ in rows[300:]]) > 0.95
    for r in got.where("doc_id < 1000 or doc_id is null").collect():
        n, *_, repeats = brute.statistics(r.text)
        assert r.verdict.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert not (r.verdict.base_failed and r.verdict.kept)


def test_rules_without_labels(spark):
    documents = brute.documents(spark)
    for none in (labels(spark, []), labels(spark, [(1001, "")])):
        got = quality_rules.assess(documents, quality_rules.fit(documents, none), result="mine").select("mine.*")
        assert got.where("kept = base_failed").count() == 0
    assert quality_rules.assess(documents.limit(0), quality_rules.fit(documents.limit(0), none)).count() == 0


def test_rules_ignore_bad_labels(spark):
    rows = corpus(80)
    documents, good = brute.documents(spark, rows), labels(spark, rows)
    odd = good.union(spark.createDataFrame([(None, 1), (1001, None), (1002, 7), (5, 0)], "doc_id bigint, quality int"))
    a, b = (quality_rules.fit(documents, x) for x in (good, odd))
    assert a.threshold == b.threshold and (a.trees.value == b.trees.value).all()


def test_all_labels_count(spark):
    import pyarrow as pa

    draw = random.Random(7)
    words = ["a", "river", "STONE", "##", "9", "banks,"]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(1, 6)))) for i in range(42_000)]
    marked = spark.createDataFrame([(k, int("#" not in t)) for k, t in rows], "doc_id bigint, quality int")
    rules = quality_rules.fit(brute.documents(spark, rows), marked)
    truth = np.array([float("#" not in t) for _, t in rows])
    assert rules.trees.base == np.log((truth.sum() + 1) / (len(rows) - truth.sum() + 1))
    features = quality_rules.statistics(pa.array([t for _, t in rows]))[1]
    plain = boosting.fit(features, truth, np.array(list(quality_rules.FEATURES.values())))
    for got, wanted in zip(rules.trees, plain, strict=True):
        assert np.array_equal(got, wanted)
    good = plain.score(features[truth == 1])
    assert rules.threshold == min(0.5, np.quantile(good, quality_rules.SPARE, method="lower"))


def test_ranks_are_exact(spark):
    draw = np.random.default_rng(3)
    parts = {0: draw.random(3001), 1: np.repeat([0.0, 2.5], 900), 2: np.array([7.0]), 3: draw.integers(0, 9, 800) / 7}
    rows = [(p, float(x)) for p, values in parts.items() for x in values]
    values = spark.createDataFrame(rows, "part int, value double").repartition(5)
    shares = np.linspace(0, 1, 65)
    found = ranks.quantiles(values, {p: len(x) for p, x in parts.items()}, shares)
    for p, x in parts.items():
        assert np.array_equal(found[p], np.quantile(x, shares))


def test_trees_are_monotonic():
    draw = np.random.default_rng(1)
    rows = draw.random((4000, 3))
    truth = (rows[:, 0] + np.sin(9 * rows[:, 1]) / 4 + draw.normal(0, 0.3, 4000) > 0.5).astype(float)
    trees = boosting.fit(rows, truth, np.array([1, 0, -1]))
    probe = np.repeat(draw.random((50, 3)), 40, axis=0)
    for feature, sign in ((0, 1), (2, -1)):
        moved = probe.copy()
        moved[:, feature] = np.tile(np.linspace(-0.2, 1.2, 40), 50)
        assert (sign * np.diff(trees.score(moved).reshape(50, 40), axis=1) >= -1e-12).all()
    assert ((trees.score(rows) > 0.5) == truth).mean() > 0.75


def test_compression(spark):
    rows = corpus()
    documents = brute.documents(spark, rows + brute.ROWS)
    model = compression.fit(documents, labels(spark, rows[:300]))
    got = compression.classify(documents, model, result="verdict")
    held_out = got.where("doc_id >= 1300").select("doc_id", "verdict.*").collect()
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in held_out]) > 0.95
    assert got.select("verdict.*").where("score between 0 and 1 and predicted = cast(score >= 0.3 as int)").count() == len(rows) + len(brute.ROWS)
    again = compression.fit(documents.repartition(7), labels(spark, rows[:300]))
    assert again == model and model.slope > 0


def test_compression_without_labels(spark):
    documents = brute.documents(spark)
    for none in (labels(spark, []), labels(spark, [(1, ""), (5, "")])):
        model = compression.fit(documents, none)
        assert compression.classify(documents, model, result="mine").select("mine.score").distinct().count() == 1
    assert compression.classify(documents.limit(0), model).agg(F.count("*")).first()[0] == 0


def test_compression_score_against_plain_calls(spark):
    rows = corpus()
    documents = brute.documents(spark, rows + brute.ROWS)
    model = compression.fit(documents, labels(spark, rows[:300]))
    got = {(r.doc_id, r.text): r.quality.score for r in compression.classify(documents, model).collect()}
    for key, text in rows + brute.ROWS:
        data = (text or "").encode()
        bad, good = (len(compression.compressor(x).compress(data)) for x in (model.bad, model.good))
        z = model.slope * (bad - good) / max(len(data), 1) ** 0.5 + model.constant
        assert got[key, text] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), rel=1e-12)


def test_long_texts_leave_room_for_short_ones(spark, monkeypatch):
    # More long labelled texts than the sample holds, copies of a key, labels of unknown keys and repeated labels.
    rows = corpus(200)
    long = [(5000 + i, "river stones " * 80 + str(i)) for i in range(300)]
    monkeypatch.setattr(compression, "LONGEST", 700)
    monkeypatch.setattr(compression, "MOST_TEXTS", 60)
    documents = brute.documents(spark, rows + long + [(1001, "of another text under the same key")] * 50)
    marks = labels(spark, rows + long + [(9000 + i, None) for i in range(300)] + [(1002, None)] * 80)
    model = compression.fit(documents, marks)
    assert model.bad and model.good
    held = compression.classify(documents, model).where("doc_id between 1000 and 1199").select("doc_id", "quality.*").collect()
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in held]) > 0.9
