"""Collocations against a plain definition."""

import brute
import numpy as np
import pytest

from benchloom.llm import collocations

VOCABULARY = ["New", "york", "city", "hall", "été", "😀", "a", "b", "the", "of"]


def rows(n=60, seed=5):
    draw = np.random.default_rng(seed)
    found = [(None, "en"), ("", "de"), (" \t .;\n", None), ("one word", "xx"), ("the " * 3000 + "end.", "en")]
    for i in range(n):
        words = [VOCABULARY[j] for j in draw.zipf(1.6, 80) % len(VOCABULARY)]
        cut = "".join(w + str(draw.choice([" ", "  ", "\t", ". ", "\n", ", ", " "])) for w in words)
        found.append((cut, ("en", "de", None, "und", "")[i % 5]))
    return found + [("New York City hall. " * 12 + "x", "fr")] * 5


def table(spark, given):
    shape = "text string, lang string, n bigint, phrase string, f bigint, print bigint, score bigint, words string"
    return spark.createDataFrame([(*row, 1, "p", 2, 3, 4, "w") for row in given], shape).repartition(3)


def got(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("bits,gathered", [(64, 3 << 20), (5, 3 << 20), (64, 40)])
def test_collocations(spark, monkeypatch, bits, gathered):
    monkeypatch.setattr(collocations, "GATHERED", gathered)
    # With five bits of fingerprint nearly all phrases collide.
    monkeypatch.setattr(collocations, "PRINT_BITS", bits)
    monkeypatch.setattr(collocations, "RANGE_BYTES", 1 << 12)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 9)
    given = rows()
    found = got(collocations.collocations(table(spark, given)))
    assert found == brute.collocations(given) and len(found) > 20


def test_first_rows_only(spark):
    given = rows()
    found = got(collocations.collocations(table(spark, given), rows=3, least=5, longest=3))
    assert found == brute.collocations(given, rows=3, least=5, longest=3)


def test_prints_are_those_of_the_words(spark):
    import pyarrow as pa

    texts = ["a b c a b c. a b", "c a b", "A,b c a b c a"]
    grams = collocations.Grams(pa.record_batch([pa.array(texts), pa.array(["x"] * 3)], names=["t", "l"]), "t", "l")
    for size in (1, 2, 3, 4):
        at = grams.places(size)
        prints, checks = grams.prints(at, size), grams.checks(at, size)
        names = [grams.phrase(i, size) for i in at]
        assert len(set(names)) == len(set(prints.tolist())) == len(set(zip(names, prints.tolist(), checks.tolist())))


def test_nothing(spark):
    assert collocations.collocations(table(spark, rows()[:4])).count() == 0
    assert collocations.collocations(table(spark, []).limit(0)).count() == 0


def test_scores_pass_64_bits(spark):
    big = 4_000_000_000_000_000_000
    found = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big - 7)], "lang string, n bigint, phrase string, f bigint")
    row = collocations.score(found).first()
    assert row.score == 2_000_000 * (big - 7) // (2 * big)
