"""Whitening against numpy's own decomposition and whole-number arithmetic."""

import math

import numpy as np
import pytest

from benchloom.llm import whitening

SHAPE = "vec_id bigint, embedding array<float>, n bigint, block string, size int, vector string, component int"


def table(spark, vectors):
    rows = [(i if i % 7 else None, v, 1, "b", 2, "v", 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SHAPE).repartition(3)


def vectors(n=300, size=12, seed=4):
    draw = np.random.default_rng(seed)
    found = (draw.normal(size=(n, size)) @ draw.normal(size=(size, size))).astype(np.float32).tolist()
    odd = [None, [], [None] * size, [math.nan] + [1.0] * (size - 1), [1.0] * (size - 1) + [math.inf], [1.0] * (size + 1), [-0.0] * size]
    return found + odd + found[:5] * 20 + [[0.25 / 256] * size] * 3


def brute(given, size, components=4):
    whole = [
        tuple(math.floor(256 * float(x)) for x in v)
        for v in given
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    fit = sorted(set(whole))
    n, sums = len(fit), [sum(x) for x in zip(*fit)]
    mean = np.array(sums) / n
    centred = np.array(fit) - mean
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1][:, :components]
    return n, sums, values, (np.array(whole) - mean) @ axes / np.sqrt(values[:components]), whole


def test_whitening(spark):
    given = vectors()
    frame = table(spark, given)
    model = whitening.fit(frame)
    got = whitening.whiten(frame, model)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    n, sums, values, white, whole = brute(given, 12)
    assert model.n == n and model.sums == sums and len(rows) == 4 * len(whole)
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9
    for c in range(4):
        mine = [r for r in rows if r.component == c + 1]
        assert mine[0].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
        found = sorted(r.whitened for r in mine)
        wanted = [sorted(sign * white[:, c]) for sign in (1, -1)]
        assert any(np.allclose(found, w, rtol=0, atol=1e-9) for w in wanted)
    assert sorted(r.deviation for r in rows if r.component == 1) == sorted(sum((n * x - s) ** 2 for x, s in zip(v, sums)) for v in whole)
    keys = [i if i % 7 else None for i, v in enumerate(given) if v is not None and len(v) == 12 and all(x is not None and math.isfinite(x) for x in v)]
    assert sorted(str(r.vec_id) for r in rows if r.component == 2) == sorted(map(str, keys))


def test_few_components(spark):
    line = table(spark, [[float(i), 2.0 * i, 0.5] for i in range(20)])
    model = whitening.fit(line)
    assert len(model.eigenvalues) == 1 and whitening.whiten(line, model).count() == 20
    assert whitening.whiten(line, model).first().explained == pytest.approx(1)
    for given in ([], [None, []], [[1.0, 2.0]] * 5):
        frame = table(spark, given)
        assert whitening.whiten(frame, whitening.fit(frame)).count() == 0


def test_most_frequent_length(spark):
    frame = table(spark, [[float(i), float(i * i)] for i in range(6)] + [[float(i)] * 3 for i in range(4)] + [[1.0] * 5] * 50)
    model = whitening.fit(frame)
    assert model.n == 6 and whitening.whiten(frame, model).count() == 12


def test_widths_and_large_entries(spark):
    given = [[1.0, 2.0], [300.0, -1.0], [1e9, 5.0], [-1e30, 2.0], [3e38, 0.0], [-128.0, 127.99]]
    blocks = whitening.distinct_vectors(table(spark, given * 3), "embedding").collect()
    assert sum(r.n for r in blocks) == 6 and {r.width for r in blocks} == {2, 4, 8}
    frame = table(spark, given)
    rows = whitening.whiten(frame, whitening.fit(frame)).where("component = 1").collect()
    assert len(rows) == 6 and all(r.deviation is None for r in rows)


def test_deviations_at_the_bounds():
    whole = np.array([[3, -4], [2**40, 5], [2**31, 1]])
    sums = [7, 2**33]
    got = whitening.deviations(whole, 9, sums).to_pylist()
    wanted = [sum((9 * x - s) ** 2 for x, s in zip(v, sums)) for v in whole.tolist()]
    assert got == [x if x < 2**63 else None for x in wanted]


@pytest.mark.parametrize("size,rank", [(1, 1), (2, 2), (7, 7), (40, 40), (30, 11)])
def test_decomposition(size, rank):
    draw = np.random.default_rng(size)
    base = draw.normal(size=(size, rank)) * np.logspace(0, -4, rank)
    matrix = base @ base.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape[1] == rank and np.allclose(factor @ factor.T, matrix, atol=1e-13 * np.abs(matrix).max())
    turned = whitening.one_sided_jacobi(factor)
    lengths = np.sort((turned**2).sum(axis=0))[::-1]
    assert np.allclose(lengths, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-7, atol=1e-13)
    unit = turned / np.sqrt((turned**2).sum(axis=0))
    assert np.allclose(unit.T @ unit, np.eye(rank), atol=1e-12)
