import numpy as np
import pytest

from llm_helpers import SF_SMALL, Union
from releasemill.llm import hnsw, queries


def brute(vectors, cosine=0.95):
    rows = hnsw.unit(np.asarray(vectors, dtype=np.float64))
    near = rows @ rows.T >= cosine
    np.fill_diagonal(near, False)
    return near


def grouped(random, count, size=24):
    """Random vectors with groups of near copies and exact copies."""
    base = random.standard_normal((count, size))
    near = np.repeat(base[:20], 12, axis=0) + 0.12 * random.standard_normal((240, size))
    crowd = base[30] + 0.05 * random.standard_normal((150, size))
    return np.concatenate([base, near, crowd, np.repeat(base[40:42], 30, axis=0)]).astype(np.float32)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    found = queries.QUERIES["op5_hnsw"](spark, SF_SMALL).toPandas().set_index("vec_id")
    near = brute(np.stack(table["embedding"].to_numpy()))
    assert (found["n_links"].reindex(table["vec_id"]).to_numpy() == near.sum(axis=1)).all()


def test_graph_search_finds_nearly_all_links(spark):
    random = np.random.default_rng(1)
    vectors = grouped(random, 6000)
    ids = random.permutation(len(vectors))
    frame = spark.createDataFrame(
        [(int(i), v.tolist(), 0) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, n int"
    )
    near = brute(vectors)
    found = hnsw.near_duplicates(frame, shards=3).toPandas().set_index("vec_id").reindex(ids)
    assert (found["n_links"].to_numpy() <= near.sum(axis=1)).all()
    assert found["n_links"].sum() / near.sum() >= 0.98
    union = Union(range(len(vectors)))
    for a, b in zip(*np.nonzero(near)):
        union.join(int(a), int(b))
    roots = np.array([union.find(k) for k in range(len(vectors))])
    smallest = {r: min(ids[roots == r]) for r in np.unique(roots)}
    expected = np.array([smallest[r] for r in roots])
    assert (found["component_id"].to_numpy() == expected).mean() >= 0.99
    assert (found["kept"].to_numpy() == (found.index == found["component_id"])).all()


def test_a_shard_that_fails_its_audit_is_scanned(monkeypatch):
    monkeypatch.setattr(hnsw, "AUDIT_RECALL", 1.1)
    vectors = grouped(np.random.default_rng(2), 800)
    shard = hnsw.Shard(vectors.astype(np.float64), 0.95, 0)
    assert shard.graph is None and shard.width == hnsw.WIDEST_BEAM
    query, row = shard.links(hnsw.unit(vectors.astype(np.float64)))
    near = brute(vectors) | np.eye(len(vectors), dtype=bool)
    assert set(zip(query.tolist(), row.tolist())) == set(zip(*map(list, map(np.ndarray.tolist, np.nonzero(near)))))


def test_recall_of_a_shard():
    vectors = grouped(np.random.default_rng(4), 3000).astype(np.float64)
    shard = hnsw.Shard(vectors, 0.95, 0)
    assert shard.graph is not None and shard.recall >= hnsw.AUDIT_RECALL
    query, row = shard.links(hnsw.unit(vectors))
    near = brute(vectors) | np.eye(len(vectors), dtype=bool)
    assert near[query, row].all() and len(query) / near.sum() >= 0.98


def test_a_tight_group_does_not_pass_the_audit_for_others(monkeypatch):
    """A third of the rows are one group, always scanned; all other searches find nothing."""
    random = np.random.default_rng(6)
    center = random.standard_normal(24)
    crowd = center + 0.03 * random.standard_normal((1200, 24))
    vectors = np.concatenate([random.standard_normal((2800, 24)), crowd])
    search = hnsw.Graph.search

    def broken(graph, queries, width):
        ids, near = search(graph, queries, width)
        return ids, np.where((queries @ hnsw.unit(center[None])[0] > 0.9)[:, None], near, -np.inf)

    monkeypatch.setattr(hnsw.Graph, "search", broken)
    shard = hnsw.Shard(vectors, 0.95, 0)
    assert shard.recall < 0.1 and shard.graph is None
    near = brute(vectors) | np.eye(len(vectors), dtype=bool)
    assert len(shard.links(hnsw.unit(vectors))[0]) == near.sum()


def test_odd_vectors(spark):
    nan, infinite = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.1]), (4, None), (5, [0.0, 0.0]),
        (6, [nan, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [2.0, 0.0]), (10, [-1.0, 0.0]),
        (11, [infinite, 1.0]), (12, [1e300, 0.0]), (12, None),
    ]
    frame = spark.createDataFrame(
        [(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, n long, cid long, shard long"
    )
    found = sorted(
        ((r.vec_id, r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(frame).collect()), key=repr
    )
    near = {1, 2, 3, 12, None}
    expected = [
        (i, 5, 1, i == 1) if i in near and v is not None else (i, 0, i, True) for i, v in rows
    ]
    assert found == sorted(expected, key=repr)
    assert hnsw.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 5, 8])
def test_every_pair_of_shards_meets_once(spark, shards):
    vectors = [[1.0, 0.001 * k] for k in range(40)]
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = hnsw.near_duplicates(frame, shards=shards).collect()
    assert {r.n_links for r in found} == {39} and {r.component_id for r in found} == {0}
