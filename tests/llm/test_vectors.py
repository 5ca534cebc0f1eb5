"""Vector operators against brute force."""

import numpy as np
import pytest

from geoobs.llm import neighbours, vector_dedup

KIND = "vec_id long, embedding array<float>"


def clustered(seed, groups, members, spread, dim=16, alone=60):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    near = np.concatenate([c + spread * rng.normal(size=(members, dim)) for c in centres])
    return np.concatenate([near, rng.normal(size=(alone, dim))]).astype(np.float32)


def frame(spark, x, extra=()):
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows + list(extra), KIND)


ODD = [
    (9000, None), (9001, []), (9002, [0.0] * 16), (9003, [1.0, float("nan")] * 8),
    (9004, [1.0, float("inf")] * 8), (9005, [1.0, None] * 8), (9006, [1.0] * 3), (9007, [2.0] * 3),
]


@pytest.mark.parametrize("tile", [vector_dedup.TILE, 8])
def test_near_vectors(spark, tile):
    x = clustered(1, 12, 14, 0.12)
    x[5] = x[2]  # equal vectors
    x[6] = 2 * x[2]
    df = frame(spark, x, ODD + [(0, x[0].tolist()), (None, x[1].tolist())])
    got = vector_dedup.near_vectors(df, tile=tile).collect()
    assert len(got) == len(x) + len(ODD) + 2
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.minimum(label, np.where(links, label[None], len(x)).min(1))
    by = {r.vec_id: r for r in got}
    assert [by[i].n_links for i in range(len(x))] == links.sum(1).tolist()
    assert [by[i].component_id for i in range(len(x))] == label.tolist()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    assert all(by[i].n_links == 0 and by[i].kept for i in range(9000, 9006))
    assert (by[9006].n_links, by[9007].component_id) == (1, 9006)
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_windows_reach_across_tasks(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "TASK_ROWS", 300)
    x = clustered(3, 1, 400, 0.02, alone=0)
    got = vector_dedup.near_vectors(frame(spark, x), window=8, passes=2).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(399, 0)}


def test_passes_grow_slowly():
    few, many = (vector_dedup.passes_needed(n, 0.9, 64, 0.005) for n in (50_000, 50_000_000))
    assert few < many < 10 * few


def exact(x, i, top):
    d = np.sqrt(((x.astype(float) - x[i].astype(float)) ** 2).sum(1))
    order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:top]
    return [(j, d[j]) for j in order]


def test_small_search_is_exact(spark):
    x = clustered(4, 5, 10, 0.3)
    x[10:30] = x[10]  # more equal vectors than are asked for
    df = frame(spark, x, ODD[:6] + [(3, x[3].tolist()), (None, x[0].tolist())])
    got = neighbours.nearest_neighbours(df, df.filter("vec_id < 40"), top=5).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(by) == list(range(40))
    for i, found in by.items():
        want = exact(x, i, 5)
        assert [j for j, _ in found] == [j for j, _ in want]
        assert [s for _, s in found] == pytest.approx([s for _, s in want], abs=1e-12)
    assert neighbours.nearest_neighbours(df.limit(0), df.limit(0)).count() == 0
    two = neighbours.nearest_neighbours(df.filter("vec_id < 2").distinct())
    assert {(r.query_id, r.vec_id) for r in two.collect()} == {(0, 1), (1, 0)}


def test_graph_search_recall(spark):
    x = clustered(7, 40, 15, 0.5, alone=900)
    df = frame(spark, x)
    asked = df.filter("vec_id % 10 = 0").unionAll(
        spark.createDataFrame([(50_000 + i, x[i].tolist()) for i in range(5)], KIND))
    got = neighbours.nearest_neighbours(df, asked, bucket=128, tables=4, rounds=3).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(found[i] & {j for j, _ in exact(x, i, 10)}) / 10 for i in range(0, len(x), 10)]
    assert np.mean(hits) >= 0.9
    assert all(i in found[50_000 + i] for i in range(5))  # queries from outside start at the pivots


def test_pairs_in_a_hot_cone(spark):
    # Vectors of the cone have cosine 0.8, isolated pairs in it 0.905; windows of 64 overflow.
    rng = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    n, cone, pairs, dim = 9000, 6000, 300, 64
    x = unit(rng.normal(size=(n, dim)))
    axis = np.zeros(dim)
    axis[0] = 1
    side = rng.normal(size=(cone, dim))
    side[:, 0] = 0
    side = unit(side)
    a, b = side[:pairs], side[pairs:2 * pairs]
    across = unit(b - (a * b).sum(1, keepdims=True) * a)
    side[pairs:2 * pairs] = 0.525 * a + np.sqrt(1 - 0.525 ** 2) * across
    x[:cone] = np.sqrt(0.8) * axis + np.sqrt(0.2) * side
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], KIND)
    got = {r.vec_id: r for r in vector_dedup.near_vectors(df).collect()}
    found = sum(got[pairs + i].component_id == got[i].component_id for i in range(pairs))
    assert found >= 0.99 * pairs
