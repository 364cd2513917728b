"""Whitening against plain linear algebra."""

import numpy as np
import pytest

from chronogrid.llm import queries, whitening

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("case", ["plain", "equal", "zero", "untouched", "close", "one"])
def test_rank_one_update(case):
    rng = np.random.default_rng(3)
    dim = 1 if case == "one" else 12
    values = np.sort(rng.uniform(0, 9, dim))
    basis = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    vector, weight = rng.normal(size=dim), 2.5
    if case == "equal":
        values[2:7] = values[2]
    if case == "zero":
        values[:] = 0
    if case == "untouched":
        vector = basis[:, 3] * 2 + basis[:, 8]
    if case == "close":
        values = 5 + np.arange(dim) * 1e-13
    new, turned = whitening.rank_one(values, basis, vector, weight)
    want = (basis * values) @ basis.T + weight * np.outer(vector, vector)
    assert np.allclose(turned.T @ turned, np.eye(dim), atol=1e-12)
    assert np.allclose((turned * new) @ turned.T, want, atol=1e-11)
    assert np.allclose(new, np.linalg.eigvalsh(want), atol=1e-11) and (np.diff(new) >= 0).all()


def test_no_update():
    values, basis = np.array([1.0, 2.0]), np.eye(2)
    assert whitening.rank_one(values, basis, np.zeros(2), 1.0) == (values, basis)


def test_spectra_of_parts_merge():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (400, 9)) + whitening.SHIFT
    x[50:90] = x[50]
    whole = whitening.Spectrum(9)
    for begin, end in [(0, 1), (1, 3), (3, 60), (60, 61), (61, 400)]:
        part = whitening.Spectrum(9)
        part.add(x[begin:end])
        whole.merge(whitening.Spectrum.of_row(part.row()))
    centred = x - x.mean(axis=0)
    assert whole.n == 400 and (whole.sums == (x - whitening.SHIFT).sum(axis=0)).all()
    assert np.allclose(whole.values, np.linalg.eigvalsh(centred.T @ centred), rtol=1e-9)
    assert np.allclose((whole.basis * whole.values) @ whole.basis.T, centred.T @ centred, rtol=1e-8, atol=1e-5)


def brute(vectors, components):
    """Whole numbers, eigenvalue shares and unsigned whitened values."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    whitened = centred @ basis / np.sqrt(values)
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, whitened, values / np.trace(centred.T @ centred / n)


def check(rows, ids, vectors, components):
    n, deviation, whitened, explained = brute(vectors, components)
    assert len(rows) == len(ids) * components
    sign = {}
    at = {key: i for i, key in enumerate(ids)}
    for r in rows:
        i, k = at[r["vec_id"]], r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation[i])
        assert r["explained"] == pytest.approx(explained[k], rel=1e-9) and r["identity_error"] < 1e-6
        want = whitened[i, k]
        if abs(want) > 0.01:
            assert sign.setdefault(k, np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])
        assert abs(r["whitened"]) == pytest.approx(abs(want), rel=1e-7, abs=1e-7)


def test_query_against_plain_algebra(spark):
    table = queries.table(spark, FOLDER, "embeddings").collect()
    rows = queries.QUERIES["op13_whitening"](spark, FOLDER).collect()
    check(rows, [r["vec_id"] for r in table], [r["embedding"] for r in table], 32)


def test_edges(spark, monkeypatch):
    """Unusable vectors, another length, copies, NULL and repeated ids, clashing names."""
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(8)
    good = rng.normal(size=(50, 5)).tolist() + [[0.5] * 5] * 30
    other = rng.normal(size=(20, 3)).tolist()
    bad = [None, [], [None] * 5, [float("nan")] * 5, [1.0, 2.0, float("inf"), 0.0, 0.0], [1e300] * 5]
    data = [(i, v, 1, 2.0) for i, v in enumerate(good + other + bad)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, n int, x double").repartition(7)
    rows = whitening.whiten(frame, 4).collect()
    five = [r for r in rows if r["vec_id"] < 80]
    three = [r for r in rows if r["vec_id"] >= 80]
    check(five, list(range(80)), good, 4)
    check(three, list(range(80, 100)), other, 3)
    named = frame.selectExpr("CAST(NULL AS LONG) AS vec_id", "embedding").where("size(embedding) = 3")
    assert {r["vec_id"] for r in whitening.whiten(named).collect()} == {None}


def test_too_few_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(make([])).collect() == []
    assert whitening.whiten(make([(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    rows = whitening.whiten(make([(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 9)) for r in rows) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_deviation_beyond_a_long():
    x = np.array([[1 << 40, 0]]) + whitening.SHIFT
    assert whitening.exact_deviation(x, 3, np.array([0, 1])) == [None]
    assert whitening.exact_deviation(x, 1, np.array([(1 << 40) - 1, 1 << 31])) == [1 + (1 << 62)]
