import math

import numpy as np
import pytest

from corpuslens.llm import spectrum_tasks as S
from corpuslens.llm import whitening as W


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def brute(x, most=32):
    """By exact integers and numpy's own solver."""
    n = len(x)
    sums = [sum(int(v) for v in column) for column in x.T]
    y = [[n * int(v) - s for v, s in zip(row, sums, strict=True)] for row in x]
    deviation = [sum(v * v for v in row) for row in y]
    centred = np.array(y, np.float64) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    m = min(most, int((values > values[0] * len(values) * 1e-15).sum()))
    return deviation, values[:m], centred @ vectors[:, :m] / np.sqrt(values[:m]), np.trace(covariance)


def whole(x):
    return np.floor(64 * np.asarray(x, np.float64)).astype(np.int64) + 1_000_000


def compared(frame, rows):
    """``frame`` against ``brute``; components up to their sign."""
    deviation, values, white, trace = brute(whole([v for _, v in rows]))
    out = frame.toPandas()
    m = len(values)
    assert len(out) == len(rows) * m
    assert (out.n == len(rows)).all()
    assert out.identity_error.nunique() == 1
    assert out.identity_error.iloc[0] <= 1e-4
    place = {i: k for k, (i, _) in enumerate(rows)}
    row = out.vec_id.map(place).to_numpy()
    component = out.component.to_numpy() - 1
    assert sorted(zip(row, component, strict=True)) == [(a, b) for a in range(len(rows)) for b in range(m)]
    assert [deviation[i] for i in row] == out.deviation.tolist()
    assert out.explained.to_numpy() == pytest.approx(values[component] / trace, rel=1e-9)
    found = np.zeros_like(white)
    found[row, component] = out.whitened
    sign = np.sign((found * white).sum(0))
    assert found * sign == pytest.approx(white, abs=1e-6)


@pytest.mark.parametrize("n, d", [(300, 5), (400, 40)])
def test_against_brute_force(spark, n, d):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, d)) * np.linspace(1, 3, d) + rng.normal(size=d) * 5
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    compared(W.whiten(vectors(spark, rows)), rows)


def test_registered_query(spark):
    directory = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{directory}/embeddings.parquet")
    compared(W.query(spark, directory), [(r.vec_id, r.embedding) for r in table.collect()])


def test_odd_cases(spark):
    inf, nan = float("inf"), float("nan")
    good = [(i, [math.sin(i), math.cos(3 * i), float(i % 4)]) for i in range(30)]
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [nan, 1.0, 1.0]), (54, [inf, 1.0, 1.0]), (55, [1.0, 2.0])]
    frame = vectors(spark, good + odd).selectExpr("*", "'a' AS x", "1 AS component", "2 AS n", "3 AS deviation")
    compared(W.whiten(frame), good)
    assert W.whiten(frame.limit(0)).count() == 0
    assert W.whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # no variance
    repeated = [(None, v) for _, v in good] + [(7, v) for _, v in good]
    out = W.whiten(vectors(spark, repeated)).toPandas()
    assert len(out) == 60 * 3
    assert out.vec_id.isna().sum() == 90


def test_dependent_entries_have_fewer_components(spark):
    rows = [(i, [float(i % 7), 2.0 * (i % 7), float(i % 3), 5.0]) for i in range(60)]
    compared(W.whiten(vectors(spark, rows)), rows)
    assert W.whiten(vectors(spark, rows)).agg({"component": "max"}).first()[0] == 2


def test_deviation_is_exact_or_null(spark):
    x = np.array([[10**9, 0], [-(10**9), 3], [5, 7]], np.int64)
    for n, sums in ((3, x.sum(0)), (10**6, x.sum(0) * 10**6 // 3)):
        expected = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
        assert S.deviation(x, n, sums).to_pylist() == [e if e < 2**63 else None for e in expected]


def spectra():
    rng = np.random.default_rng(4)
    for n in (1, 2, 9, 40):
        yield n, np.sort(rng.random(n))
        yield n, np.ones(n)
        yield n, np.r_[np.zeros(n - n // 2), np.ones(n // 2)]
        yield n, np.r_[np.linspace(0.9999, 1, n - 1), 5]
        yield n, 10.0 ** -np.arange(n)


@pytest.mark.parametrize("n, values", list(spectra()))
def test_intervals_hold_all_and_the_contour_finds_them(n, values):
    q = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    expected = np.sort(values)[::-1]
    for shift in (-0.5, 0.137, 0.99995001, 1.5, 6.0):
        assert S.count_above(a, shift) == (expected > shift).sum()
    wanted = S.count_above(a, np.abs(a).sum(1).max() * n * np.finfo(float).eps)
    found = []
    for low, high, count in S.intervals(a, wanted, 8):
        value, vector = S.within(a, low, high, count)
        assert len(value) == count
        assert vector.T @ vector == pytest.approx(np.eye(count), abs=1e-12)
        assert a @ vector == pytest.approx(vector * value, abs=1e-12 * max(1, expected[0]))
        found += value.tolist()
    assert len(found) >= wanted
    assert found == pytest.approx(expected[: len(found)], abs=1e-12 * max(1, expected[0]))


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(ArithmeticError):
        S.within(np.diag([1.0, 2.0, 3.0]), 0.5, 2.5, 3)
