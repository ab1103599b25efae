from fractions import Fraction

import duckdb
import numpy as np
import pytest

from llm_helpers import SF_SMALL
from releasemill.llm import queries, whitening


def frame(spark, vectors):
    rows = [(k, v, 1, "n") for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component string")


def brute(vectors):
    """Whole numbers, their covariance and deviations by plain arithmetic."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, dims = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([
        [float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n) for j in range(dims)] for i in range(dims)
    ])
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[float(a - m) for a, m in zip(v, mean)] for v in x])
    return n, cov, deviations, centred


def check(rows, vectors, ids, dims):
    n, cov, deviations, centred = brute(vectors)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    shown = min(16, dims)
    expected = centred @ axes[:, :shown] / np.sqrt(values[:shown])
    found = {(r.vec_id, r.component): r for r in rows}
    assert len(found) == len(rows) == len(ids) * shown
    got = np.array([[found[i, k + 1].whitened for k in range(shown)] for i in ids])
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got - expected * signs).max() < 1e-7
    for place, i in enumerate(ids):
        assert found[i, 1].deviation == deviations[place] and found[i, 1].n == n
    for k in range(shown):
        assert found[ids[0], k + 1].explained == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-10


def test_query_equals_plain_arithmetic(spark):
    rows = duckdb.execute(f"SELECT vec_id, embedding FROM '{SF_SMALL}/embeddings.parquet' ORDER BY 1").fetchall()
    found = queries.QUERIES["op11_whitening"](spark, SF_SMALL).collect()
    check(found, [v for _, v in rows], [i for i, _ in rows], 64)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(30, 3)).round(3).tolist()
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0]]
    table = frame(spark, good + odd)
    once = whitening.whitened(table).collect()
    check(once, np.array(good, dtype=np.float32).tolist(), list(range(30)), 3)
    # Rows that repeat a vector are projected, but fitted once; ids may repeat or be missing.
    repeated = table.unionAll(table).unionAll(table.selectExpr("CAST(NULL AS bigint)", "embedding", "label", "component"))
    twice = whitening.whitened(repeated).collect()
    assert len(twice) == 3 * len(once) and {r.n for r in twice} == {30}
    assert {(r.vec_id, r.component, r.deviation) for r in twice if r.vec_id is not None} == {
        (r.vec_id, r.component, r.deviation) for r in once
    }
    assert sum(r.vec_id is None for r in twice) == len(once)


def test_no_variance(spark):
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    assert whitening.whitened(frame(spark, [None, []])).collect() == []
    assert whitening.whitened(frame(spark, [[1.0]]).limit(0)).dtypes == [
        (c.split()[0], {"long": "bigint"}.get(c.split()[1], c.split()[1])) for c in columns.split(", ")
    ]
    (row, _) = whitening.whitened(frame(spark, [[1.0, 2.0]])).collect()
    assert (row.n, row.deviation, row.whitened, row.explained, row.identity_error) == (1, 0, None, None, None)
    line = whitening.whitened(frame(spark, [[0.0, 0.0], [1.0, 1.0], [3.0, 3.0]])).collect()
    assert [r.whitened is None for r in sorted(line, key=lambda r: (r.component, r.vec_id))] == [False] * 3 + [True] * 3
    assert line[0].identity_error < 1e-12
    with pytest.raises(ValueError, match="several lengths"):
        whitening.whitened(frame(spark, [[1.0, 2.0], [1.0]]))
    with pytest.raises(ValueError, match="not be exact"):
        whitening.whitened(frame(spark, [[1e12], [0.0]]))


def orthogonal(size, seed):
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0].astype(whitening.WIDE)


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 24),
    np.concatenate([np.full(6, 2.0), np.linspace(3, 4, 12), np.full(6, 5.0)]),  # equal
    np.concatenate([2 + 1e-9 * np.arange(8), 7 + 1e-6 * np.arange(8), [1e-3] * 8]),  # closer than single precision tells
    np.geomspace(1, 1e-12, 24),
])
def test_eigenpairs_to_double_precision(values):
    axes = orthogonal(24, 1)
    residue = axes.T @ axes - np.eye(24)
    axes = axes - axes @ residue / 2  # orthogonal beyond double precision
    matrix = (axes * values.astype(whitening.WIDE)) @ axes.T
    found, vectors = whitening.eigenpairs((matrix + matrix.T) / 2)
    assert np.abs(vectors.T @ vectors - np.eye(24)).max() < 1e-15
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-15 * values.max()
    assert np.abs(np.sort(found) - np.sort(values)).max() < 1e-15 * values.max()
    # A vector whose eigenvalue stands apart is found to double precision.
    order = np.argsort(-values, kind="stable")
    gaps = [min(abs(values[o] - v) for k, v in enumerate(values) if k != o) for o in order]
    for place, (o, gap) in enumerate(zip(order, gaps)):
        if gap > 1e-2:
            assert abs(abs(axes[:, o] @ vectors[:, place]) - 1) < 1e-15


def test_single_precision_alone_is_not_enough():
    axes = orthogonal(24, 2)
    matrix = (axes * np.linspace(1, 2, 24)) @ axes.T
    _, start = np.linalg.eigh(matrix.astype(np.float32))
    start = start.astype(whitening.WIDE)
    before = np.abs(start.T @ start - np.eye(24)).max()
    after, _, _ = whitening.refined(matrix, start)
    assert before > 1e-8 and np.abs(after.T @ after - np.eye(24)).max() < before**1.5
