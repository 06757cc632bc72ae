import math
import random
from fractions import Fraction

import numpy as np
import pytest

from newsflow.llm import whitening as W
from tests.llm.conftest import SF_DIR, rows_of

SCHEMA = "vec_id long, embedding array<double>, x string, vector int, component string"


def whole(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


def usable(rows):
    return [(i, whole(v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def exact_covariance(fit):
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = [[n * x[k] - sums[k] for k in range(d)] for x in fit]
    return n, sums, [[Fraction(sum(c[i] * c[j] for c in centred), n**3) for j in range(d)] for i in range(d)]


def check(found, rows, components=16):
    kept = usable(rows)
    fit = sorted({tuple(x) for _, x in kept})
    n, sums, cov = exact_covariance(fit)
    trace = sum(cov[k][k] for k in range(len(cov)))
    by_row = {}
    for r in found:
        assert r.n == n and 1 <= r.component <= components and r.identity_error <= 1e-4
        by_row.setdefault(r.vec_id, []).append(r)
    shares = {r.component: r.explained for r in found}
    matrix = np.array([[float(c) for c in row] for row in cov])
    values = np.linalg.eigvalsh(matrix)[::-1][: len(shares)]
    assert np.allclose([shares[k + 1] for k in range(len(shares))], values / float(trace), rtol=1e-9)
    for vec_id, x in kept:
        rest = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert {r.deviation for r in by_row[vec_id]} == {rest if rest < 1 << 63 else None}
    # Whitened values of the fit have covariance one and, on the way back, the leading part of V.
    first = {tuple(x): i for i, x in reversed(kept)}
    by_component = {i: {r.component: r.whitened for r in some} for i, some in by_row.items()}
    table = np.array([[by_component[first[x]][k + 1] for k in range(len(shares))] for x in fit])
    assert np.abs(table.T @ table / n - np.eye(len(shares))).max() < 1e-4
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    loading = centred.T @ table / n  # V u / sqrt(e) = sqrt(e) u
    assert np.allclose((loading**2).sum(0), values, rtol=1e-6)
    assert np.allclose(matrix @ loading, loading * values, rtol=1e-6, atol=1e-6 * values[0] ** 1.5)


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in rows_of("embeddings")]
    found = W.whiten(spark.read.parquet(f"{SF_DIR}/embeddings.parquet")).collect()
    assert len(found) == 16 * len(rows)
    check(found, rows)


def test_odd_rows(frame):
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 1 + d) for d in range(6)]) for k in range(60)]
    rows += [(60, None), (61, []), (62, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (63, [math.nan] * 6), (64, [math.inf] + [0.0] * 5),
             (65, [1.0, 2.0])] + [(70 + k, rows[0][1]) for k in range(50)] + [rows[1]] * 3
    df = frame([(*r, "x", 1, "c") for r in rows], SCHEMA)
    found = W.whiten(df).collect()
    left = [r for r in rows if r[0] not in (60, 61, 62, 63, 64, 65)]
    assert len(found) == 6 * len(left)  # no more components than dimensions
    check(found, left)
    assert len(W.whiten(df, components=2).collect()) == 2 * len(left)


def test_huge_numbers_and_null_ids(frame):
    rows = [(1, [1e300, 0.0]), (None, [1.0, 2.0]), (3, [-1e300, 1.0]), (4, [1.0, -2.0])]
    found = W.whiten(frame([(*r, "x", 1, "c") for r in rows], SCHEMA)).collect()
    assert {r.vec_id for r in found} == {1, None, 3, 4} and any(r.deviation is None for r in found)


def test_no_variance_and_empty_table(spark, frame):
    assert W.whiten(frame([(k, [1.0, 2.0], "x", 1, "c") for k in range(5)], SCHEMA)).collect() == []
    assert W.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    flat = [(k, [float(k), 7.0, 2.0 * k], "x", 1, "c") for k in range(5)]
    assert {r.component for r in W.whiten(frame(flat, SCHEMA)).collect()} == {1}


def rotation(n):
    """An orthogonal matrix of rational rotations, exact but for the last digits."""
    q = np.eye(n, dtype=np.longdouble)
    for k in range(n - 1):
        g = np.eye(n, dtype=np.longdouble)
        three, four = np.longdouble(3) / 5, np.longdouble(4) / 5
        g[k, k], g[k + 1, k + 1], g[k, k + 1], g[k + 1, k] = three, three, -four, four
        q = q @ g
    return q


@pytest.mark.parametrize("values", [
    [9, 5, 3, 2, 1, 0.5], [1 + 3e-9, 1 + 2e-9, 1 + 1e-9, 1, 0.5, 1e-6],
    [1 + 3e-12, 1 + 1e-12, 1, 0.5 + 1e-10, 0.5, 0.1], [2, 2, 2, 1, 1, 0], [1e9, 1, 1e-3, 1e-4, 1e-5, 0],
])
def test_eigenvectors_to_double_precision(values):
    q, values = rotation(6), np.array(values, np.longdouble)
    found, x = W.eigen((q * values) @ q.T)
    assert np.abs(found - values).max() < 1e-17 * values[0]
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-16
    for k in range(6):
        same = np.abs(values - values[k]) < 1e-16 * values[0]
        part = q[:, same] @ (q[:, same].T @ x[:, k])
        gap = np.abs(values - values[k])[~same].min(initial=np.inf)
        assert np.abs(part - x[:, k]).max() < max(1e-16, 1e-17 * float(values[0] / gap) * 10)


def test_single_precision_alone_is_not_enough():
    q, values = rotation(6), np.array([1 + 3e-9, 1 + 2e-9, 1 + 1e-9, 1, 0.5, 1e-6], np.longdouble)
    start = np.linalg.eigh(((q * values) @ q.T).astype(np.float32))[1][:, ::-1]
    assert np.abs(np.abs((start * q).sum(0)) - 1).max() > 1e-4
