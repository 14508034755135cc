"""Whitening against dense linear algebra and whole-number arithmetic."""

import numpy as np
import pytest

from kerbcast.llm import whitening
from kerbcast.llm.whitening import whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(vectors):
    """(deviations, components, values, trace) of the steps, by a dense decomposition."""
    x = np.floor(1024 * vectors.astype(np.float64)).astype(np.int64) + 100000
    n, s = len(x), x.sum(0)
    centred = (n * x - s) / n
    _, lengths, axes = np.linalg.svd(centred, full_matrices=False)
    values = lengths**2 / n
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return exact, axes.T, values, values.sum(), centred


def check(rows, vectors, wanted=8):
    exact, axes, values, trace, centred = expected(vectors)
    k = min(wanted, int((values > 1e-18 * values[0]).sum()))
    assert len(rows) == k * len(vectors)
    table = np.zeros((len(vectors), k))
    for r in rows:
        i, c = r["vec_id"], r["component"] - 1
        assert r["n"] == len(vectors) and r["deviation"] == exact[i]
        assert abs(r["explained"] - values[c] / trace) < 1e-9
        assert r["identity_error"] < 1e-9
        table[i, c] = r["whitened"]
    plain = centred @ axes[:, :k] / np.sqrt(values[:k])
    turn = plain.T @ table / len(vectors)
    # Up to sign, and up to a rotation where values are equal.
    assert np.abs(plain @ turn - table).max() < 1e-6
    for c in range(k):
        apart = all(abs(values[c] - values[o]) > 1e-9 * values[0] for o in range(len(values)) if o != c)
        if apart:
            assert abs(abs(turn[c, c]) - 1) < 1e-9
    return table


def frame(spark, vectors):
    rows = [(k, [float(c) for c in v], 1) for k, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS n", "label AS component", "embedding AS vector")
    return table.repartition(3)


@pytest.mark.parametrize(("n", "d"), [(300, 24), (40, 12), (6, 20), (500, 3)])
def test_matches_a_dense_decomposition(spark, n, d):
    rng = np.random.default_rng(n)
    mix = rng.standard_normal((d, d)) * np.geomspace(1, 0.02, d)
    vectors = (rng.standard_normal((n, d)) @ mix + 0.4).astype(np.float32)
    check(whitened(frame(spark, vectors)).collect(), vectors)


def test_flat_directions_equal_values_and_copies(spark):
    rng = np.random.default_rng(1)
    low = rng.standard_normal((60, 3)) @ rng.standard_normal((3, 10))
    vectors = np.vstack([low, low[:20], np.repeat(low[:1], 30, 0)]).astype(np.float32)
    check(whitened(frame(spark, vectors)).collect(), vectors)
    # The corners of a cross: all values equal.
    cross = np.vstack([np.eye(5), -np.eye(5)]).astype(np.float32)
    check(whitened(frame(spark, cross)).collect(), cross)


def test_wide_spaces_stop_when_settled(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FULL", 8)
    rng = np.random.default_rng(2)
    scale = np.r_[np.geomspace(40, 8, 8), np.full(72, 0.05)]
    vectors = (rng.standard_normal((200, 80)) * scale).astype(np.float32)
    scans = []
    plain = whitening._scan
    monkeypatch.setattr(whitening, "_scan", lambda *a: scans.append(1) or plain(*a))
    check(whitened(frame(spark, vectors)).collect(), vectors)
    assert len(scans) < 60


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((30, 4)).astype(np.float32)
    vectors[5, 2:] = 0.0
    rows = [(k, [float(c) for c in v], 1) for k, v in enumerate(vectors)]
    rows[5] = (5, [float(c) for c in vectors[5, :2]], None)  # short: zeros beyond its end
    bad = [None, [1.0, None, 0.0, 0.0], [float("nan"), 0.0, 0.0, 0.0], [0.0, float("-inf"), 0.0, 0.0]]
    rows += [(100 + k, v, 1) for k, v in enumerate(bad)]
    found = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    check(found, vectors)
    # Null ids and repeated rows are rows of their own.
    again = spark.createDataFrame([*rows, (None, rows[0][1], 1), rows[1]], SCHEMA)
    found = whitened(again).collect()
    assert len(found) == 4 * 32 and sum(r["vec_id"] is None for r in found) == 4
    assert sum(r["vec_id"] == 1 for r in found) == 8


def test_huge_entries_do_not_fail(spark):
    rows = [(0, [1e30, 0.0], 1), (1, [-3e38, 1.0], 1), (2, [0.5, 2.0], 1)]
    found = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    # Beside these entries the other direction has no variance.
    assert len(found) == 3 and all(r["deviation"] is None for r in found if r["vec_id"] < 2)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.5, 0.5], 1)], [(1, [], 1)], [(k, [0.1, 0.2], 1) for k in range(5)]])
def test_nothing_to_whiten_gives_no_rows(spark, rows):
    assert whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_a_fit_of_doubles_whitens_other_rows(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((100, 6)) * 3
    rows = spark.createDataFrame([(v.tolist(),) for v in vectors], "vector array<double>")
    model = whitening.fit(rows, 4)
    values = model.apply(vectors)
    assert np.abs(np.cov(values.T, bias=True) - np.eye(4)).max() < 1e-9
    assert np.abs(model.components.T @ model.components - np.eye(4)).max() < 1e-12
