"""Whitening against integers of any size and a plain eigendecomposition."""

import math

import numpy as np
import pytest

from paperloom.llm import queries, whitening

pytestmark = pytest.mark.usefixtures("shared")
SCHEMA = "vec_id long, embedding array<double>, deviation string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, top=32):
    """{vec_id: deviation}, covariance and centred rows of (vec_id, vector)."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim, n = max((len(v) for _, v in kept), default=0), len(kept)
    x = [[(math.floor(64 * c) if abs(c) < 1e300 else 64 * int(c)) + 1_000_000 for c in v] + [1_000_000] * (dim - len(v)) for _, v in kept]
    sums = [sum(row[d] for row in x) for d in range(dim)]
    y = [[n * row[d] - sums[d] for d in range(dim)] for row in x]
    deviations = sorted((i, sum(v * v for v in row)) for (i, _), row in zip(kept, y))
    covariance = np.array([[sum(row[d] * row[e] for row in y) / n**3 for e in range(dim)] for d in range(dim)])
    return deviations, covariance, {i: [v / n for v in row] for (i, _), row in zip(kept, y)}


def check(df, rows):
    deviations, covariance, centred = brute(rows)
    model = whitening.fit(df)
    found = whitening.whiten(df, model).collect()
    assert sorted((r["key"], r["deviation"]) for r in found) == [(i, d if d < 1 << 63 else None) for i, d in deviations]
    values = np.sort(np.linalg.eigvalsh(covariance))[::-1][:len(model.variances)]
    np.testing.assert_allclose(model.variances, values, rtol=1e-9)
    np.testing.assert_allclose(model.explained, values / np.trace(covariance), rtol=1e-9)
    for r in found:
        expected = np.array(centred[r["key"]]) @ model.components / np.sqrt(values)
        np.testing.assert_allclose(r["whitened"], expected, rtol=1e-7, atol=1e-9)
    error = whitening.identity_error(whitening.whiten(df, model), model.n, len(model.variances))
    assert error < 1e-8
    return model


def spread(n=150, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=dim) * (1, 2, 4, 8, 0.3, 20)[:dim] + 7).tolist()) for i in range(n)]


def test_whole_rows_and_broken_ones(spark):
    rows = spread()
    broken = [(900, None), (901, [None] * 6), (902, [math.nan] * 6), (903, [1.0, math.inf]), (904, [1.0, None])]
    model = check(frame(spark, rows + broken), rows)
    assert (model.n, len(model.variances)) == (150, 6)


def test_short_constant_and_repeated(spark):
    rows = [(i, v + [5.0, 0.0]) for i, v in spread(80)] + [(200, []), (201, [1.0])]
    model = check(frame(spark, rows), rows)
    assert model.grid.dim == 8
    twice = frame(spark, rows).unionByName(frame(spark, rows))
    again = whitening.fit(twice)
    assert again.n == 2 * model.n
    np.testing.assert_allclose(again.variances, model.variances, rtol=1e-12)


@pytest.mark.parametrize("scale", [1e6, 1e17, 1e150, 1e307])
def test_large_entries_are_exact(spark, scale):
    rows = [(i, [c * scale / 100 for c in v]) for i, v in spread(40, 3)]
    df = frame(spark, rows)
    if scale < 1e100:
        check(df, rows)
    model = whitening.fit(df)
    assert len(model.variances) == 3
    assert whitening.identity_error(whitening.whiten(df, model), model.n, 3) < 1e-8


def test_shift_costs_no_digit(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1e9 + float(rng.integers(0, 2)) / 64, float(rng.normal())]) for i in range(200)]
    check(frame(spark, rows), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0]), (2, [2.0])]])
def test_without_spread(spark, rows):
    df = frame(spark, rows)
    model = whitening.fit(df)
    found = whitening.whiten(df, model).collect()
    assert [r["whitened"] for r in found] == [[] for _, v in rows if v is not None]
    assert whitening.identity_error(whitening.whiten(df, model), model.n, 0) is None


def test_at_most_top_components(spark):
    rng = np.random.default_rng(5)
    df = frame(spark, [(i, rng.normal(size=40).tolist()) for i in range(300)])
    model = whitening.fit(df)
    assert len(model.variances) == 32 and (np.diff(model.variances) <= 0).all()


def test_query(spark):
    table = "/root/testdata/sf0.001/embeddings.parquet"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(table).collect()]
    deviations, covariance, centred = brute(rows)
    found = queries.whitened_vectors(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 32 * len(rows)
    assert {(r["vec_id"], r["deviation"]) for r in found} == set(deviations)
    assert {r["n"] for r in found} == {len(rows)} and {r["component"] for r in found} == set(range(1, 33))
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    w = np.zeros((len(rows), 32))
    place = {i: p for p, (i, _) in enumerate(rows)}
    for r in found:
        w[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    expected = np.array([centred[i] for i, _ in rows]) @ vectors[:, :32] / np.sqrt(values[:32])
    np.testing.assert_allclose(w * np.sign((w * expected).sum(0)), expected, atol=1e-7)
    error = {r["identity_error"] for r in found}
    assert len(error) == 1 and error.pop() < 1e-9
