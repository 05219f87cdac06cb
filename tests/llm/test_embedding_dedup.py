"""Vector near-dedup against all pairs in double precision."""

import math

import numpy as np
import pytest

from monthwise.llm import embedding_dedup as ed
from monthwise.llm.hnsw import Hnsw


def vectors(n=900, d=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    for c in range(6):                                 # groups of near and exact copies
        at = slice(100 * c, 100 * c + 40)
        x[at] = x[100 * c] + rng.normal(size=(40, d)) * rng.uniform(0, 0.25, (40, 1))
        x[100 * c + 40:100 * c + 55] = x[100 * c]
    return x


def brute(x, threshold=0.9):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    while True:
        before = comp.copy()
        for i, j in zip(*np.nonzero(near)):
            comp[i] = comp[j] = min(comp[i], comp[j])
        if np.array_equal(before, comp):
            return near, comp


def test_links_and_components(spark):
    x = vectors()
    near, comp = brute(x)
    df = spark.createDataFrame([(i, v.tolist(), 1, "r") for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int, rep string")
    out = ed.near_duplicate_vectors(df)
    got = {r["vec_id"]: r for r in out.collect()}
    want = near.sum(axis=1)
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * want.sum()
    assert all(r["n_links"] <= want[i] for i, r in got.items())
    assert np.mean([got[i]["component_id"] == comp[i] for i in got]) >= 0.99
    assert out.audit[-1][1] >= 0.9


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [math.nan, 1.0]),
            (8, [math.inf, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0]),
            (11, [-0.0, 1.0]), (12, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in ed.near_duplicate_vectors(df).collect()), key=str)
    want = [(1, 4, 1), (2, 4, 1), (10, 4, 1), (10, 4, 1), (None, 4, 1), (11, 1, 11), (12, 1, 11)] + \
        [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted(want, key=str)
    assert ed.near_duplicate_vectors(df.limit(0)).count() == 0


def test_graph_recall_reachability_and_round_trip():
    x = vectors(1500, 24, 4)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.unique(x, axis=0)
    np.random.default_rng(0).shuffle(x)
    g = Hnsw(x)
    for graph in g.graphs:
        reached, front = {0}, [0]
        while front:
            front = [int(j) for j in {int(j) for i in front for j in graph[i] if j >= 0} - reached]
            reached.update(front)
        assert len(reached) == len(graph)
    want = set(zip(*np.nonzero(x @ x.T >= 0.9)))
    q, n = Hnsw.unpack(g.pack()).near(x, 0.9, 32)
    got = set(zip(q.tolist(), n.tolist()))
    assert got <= want and len(got) >= 0.99 * len(want)


def test_full_beams_are_followed_on():
    rng = np.random.default_rng(2)
    x = (np.ones(12) + rng.normal(size=(700, 12)) * 0.05).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, n = Hnsw(x).near(x[:20], 0.9, 8)
    assert len(q) == 20 * 700


def test_a_failed_audit_ends_in_the_exact_comparison(spark, monkeypatch):
    monkeypatch.setattr(ed, "LAST_BEAM", ed.FIRST_BEAM)
    monkeypatch.setattr(ed, "TARGET_RECALL", 1.1)        # no beam reaches it
    x = vectors(600)
    near, comp = brute(x)
    df = spark.createDataFrame([(2 * i + 1, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = ed.near_duplicate_vectors(df)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out.collect()}
    assert [beam for beam, _ in out.audit] == [ed.FIRST_BEAM, None]
    assert got == {2 * i + 1: (int(near[i].sum()), 2 * int(comp[i]) + 1) for i in range(len(x))}


def test_a_hot_group_does_not_hide_missed_links(spark):
    hot = [(i, 1000, 1000) for i in range(99)]
    audited = spark.createDataFrame(hot + [(200, 1, 0), (201, 1, 1), (201, 1, 1)], "rep long, true long, found long")
    assert ed.worst_recall(audited) == 0.0               # one link, not found; two links, both found
    assert ed.worst_recall(audited.limit(0)) is None


def test_vectors_without_an_id_join_nothing(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 0.1]), (None, [0.1, 1.0]), (None, [0.1, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in ed.near_duplicate_vectors(df).collect() if r["vec_id"]}
    assert got == {(1, 1, 1), (2, 2, 2)}


def test_one_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.1, 0.0]), (3, [0.0, 0.0, 1.0]), (3, [0.0, 0.1, 1.0]), (3, [0.0, 1.0, 0.1]),
            (4, None), (4, [0.0, 0.0, 1.0]), (None, [0.0, 1.0, 0.05]), (5, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in ed.near_duplicate_vectors(df).collect() if r["vec_id"])
    assert got == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (3, 2, 3), (3, 2, 3), (4, 0, 4), (4, 2, 3), (5, 0, 5)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables_with_repeated_ids(spark, seed):
    x = vectors(600)
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 120, len(x))
    near, comp = brute(x)
    least = {}
    for c, i in zip(comp, ids):
        least[c] = min(least.get(c, 10**9), int(i))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in ed.near_duplicate_vectors(df).collect())
    assert got == sorted((int(i), int(near[k].sum()), least[comp[k]]) for k, i in enumerate(ids))


def test_recall_is_measured_where_links_are_rare(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 32))
    x[1] = x[0] + 0.01 * rng.normal(size=32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = ed.near_duplicate_vectors(df)
    assert out.audit[-1][1] is not None and out.audit[-1][1] >= ed.TARGET_RECALL
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect() if r["n_links"]} == {(0, 1, 0), (1, 1, 0)}


def test_a_group_of_a_third_in_small_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(ed, "SHARD_BYTES", 8 * 16 * 150)
    monkeypatch.setattr(ed, "FOLD", 16)
    rng = np.random.default_rng(3)
    x = np.concatenate([np.ones((300, 16)) + 0.05 * rng.normal(size=(300, 16)), rng.normal(size=(600, 16))])
    near, comp = brute(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ed.near_duplicate_vectors(df).collect()}
    assert got == {i: (int(near[i].sum()), int(comp[i])) for i in range(len(x))}
