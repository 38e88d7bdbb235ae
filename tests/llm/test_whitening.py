"""Whitening against numpy on exact integers."""

import numpy as np
import pytest

from eventlens.llm.whitening import fit, whiten

SCHEMA = "vec_id long, embedding array<float>, white string"


def by_numpy(vectors, count):
    x = (np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(np.int64) + 100_000).astype(object)
    n, total = len(x), x.sum(axis=0)
    apart = n * x - total
    cov = np.array([[float(a) for a in row] for row in apart.T @ apart]) / n**3
    values, components = np.linalg.eigh(cov)
    values, components = values[::-1][:count], components[:, ::-1][:, :count]
    with np.errstate(invalid="ignore", divide="ignore"):
        return (apart * apart).sum(axis=1), (apart / n).astype(float) @ components / np.sqrt(values), values / np.trace(cov)


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "v") for i, v in enumerate(vectors)], SCHEMA).repartition(3)


def check(spark, vectors, extra=()):
    rng = np.random.default_rng(1)
    out = sorted(whiten(table(spark, [*vectors, *extra])).collect())
    assert [r["vec_id"] for r in out] == list(range(len(vectors)))
    count = min(8, len(vectors[0]))
    apart, white, shares = by_numpy(vectors, count)
    got = np.array([[p["whitened"] for p in r["parts"]] for r in out])
    assert [int(r["deviation"]) for r in out] == list(apart)
    for k in range(count):
        assert min(np.abs(got[:, k] - white[:, k]).max(), np.abs(got[:, k] + white[:, k]).max()) < 1e-9
    assert np.allclose([p["explained"] for p in out[0]["parts"]], shares, rtol=1e-6)
    assert [p["component"] for p in out[0]["parts"]] == list(range(1, count + 1))
    assert {r["n"] for r in out} == {len(vectors)} and out[0]["identity_error"] < 1e-9
    return rng


@pytest.mark.parametrize("dims", [2, 8, 20])
def test_against_numpy(spark, dims):
    rng = np.random.default_rng(dims)
    vectors = rng.normal(size=(300, dims)) * rng.uniform(0.1, 3, size=dims) + 0.3
    check(spark, vectors.astype(np.float32))


def test_unusable_rows_go(spark):
    vectors = np.random.default_rng(3).normal(size=(50, 5)).astype(np.float32)
    bad = [None, [], [1, None, 2, 3, 4], [1, 2, 3, 4, float("nan")], [float("-inf"), 1, 2, 3, 4], [1, 2, 3]]
    check(spark, vectors, bad)


def test_large_values_stay_exact(spark):
    vectors = np.random.default_rng(4).normal(size=(40, 3)) * np.array([1e9, 1e6, 1.0])
    out = sorted(whiten(table(spark, vectors.astype(np.float32))).collect())
    assert [int(r["deviation"]) for r in out] == list(by_numpy(vectors, 3)[0])


def test_a_large_mean_costs_no_digit(spark):
    vectors = np.random.default_rng(6).integers(0, 2, size=(64, 4)) / 1024 + 8192
    model = fit(table(spark, vectors).selectExpr("cast(embedding as array<double>) as vector"))
    x = (vectors * 1024).astype(int)
    assert np.allclose(model.values, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1], rtol=1e-12)


def test_no_variance_and_empty(spark):
    out = whiten(table(spark, [[1.0, 2.0, 3.0]] * 4)).collect()
    assert len(out) == 4 and all(p["whitened"] == 0 and p["explained"] == 0 for r in out for p in r["parts"]) and out[0]["identity_error"] == 0
    line = whiten(table(spark, [[x, 2 * x, 1.0] for x in range(5)])).collect()
    assert all(p["whitened"] == 0 for r in line for p in r["parts"][1:]) and line[0]["identity_error"] < 1e-9
    assert whiten(table(spark, [])).collect() == [] and whiten(table(spark, [None, [float("nan")]])).collect() == []
    assert whiten(table(spark, [[], []])).collect() == []
