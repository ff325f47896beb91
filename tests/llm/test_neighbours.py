import math

import numpy as np
import pytest

from farestar.llm import hnsw, neighbours
from farestar.llm.queries import op12_neighbours

VECTORS = "vec_id long, embedding array<float>, label int, dim int, vector string"


def plain(rows, every=50, k=5):
    """{query: [(score, vec_id)]} of all k nearest, pair by pair."""
    usable = {
        (i, tuple(v)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    found = {}
    for i, v in usable:
        if i % every == 0:
            near = []
            for j, w in usable:
                if j != i and len(v) == len(w):
                    a, b = np.array(v, float), np.array(w, float)
                    near.append((-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), j))
            found[i] = sorted((round(s, 12), j) for s, j in near)[:k]
    return found


def answers(df):
    found = {}
    for row in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        near = found.setdefault(row.query_id, [])
        near.append((round(-row.score, 12), row.vec_id))
        assert row.rank == len(near)
    return found


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], VECTORS).repartition(3)


def random_rows(n, dim, seed, first=0):
    rng = np.random.default_rng(seed)
    return [(first + i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(size=(n, dim)))]


@pytest.fixture
def odd_vectors():
    rows = random_rows(60, 4, 1)
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)] + [(200, [2.0, 4.0, 6.0, 8.0])] * 2
    rows += [(300, None), (301, []), (350, [0.0] * 4), (400, [1.0, None, 0.0, 0.0]), (401, [float("nan")] * 4)]
    rows += [(402, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0, 2.0, 3.0, 4.0]), (450, [1e38, -1e38, 3e38, 1e38])]
    return rows + [(500, [1e-40, 0.0, 0.0, 1e-41]), (550, [1.0, 2.0]), (551, [-0.0, 1.0]), (552, [0.0, 1.0])]


def test_small_tables_are_searched_exactly(spark, odd_vectors):
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in odd_vectors]
    found = answers(neighbours.nearest_of_every(table(spark, rows), 50, 5))
    expected = plain(rows)
    assert set(found) == set(expected) == {0, 50, 100, 200, 450, 500, 550}
    for query, near in expected.items():
        assert [s for s, _ in found[query]] == pytest.approx([s for s, _ in near], abs=1e-9)
    assert [v for _, v in found[100]] == [101, 102, 103, 104, 105]
    assert sorted(v for _, v in found[550]) == [551, 552] and found[550][0][0] == found[550][1][0]


def test_an_empty_table_has_no_neighbours(spark):
    assert neighbours.nearest_of_every(table(spark, []), 50, 5).count() == 0
    assert neighbours.nearest_of_every(table(spark, [(0, [1.0, 2.0])]), 50, 5).count() == 0
    assert neighbours.nearest_of_every(table(spark, [(1, [1.0, 2.0]), (2, None)]), 50, 5).count() == 0


def test_shards_are_merged(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_NODES", 400)
    rows = random_rows(1500, 16, 2) + [(5000 + i, random_rows(1, 16, 3)[0][1]) for i in range(300)]
    found, expected = answers(neighbours.nearest_of_every(table(spark, rows), 50, 5)), plain(rows)
    assert set(found) == set(expected)
    hits = [len(set(found[q]) & set(expected[q])) / 5 for q in expected]
    assert np.mean(hits) >= 0.97
    assert [v for _, v in found[5000]] == [5001, 5002, 5003, 5004, 5005]


def test_recall_on_the_given_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found, expected = answers(op12_neighbours(spark, folder)), plain(rows)
    assert set(found) == set(expected)
    got = [[s for s, _ in found[q]] for q in expected]
    want = [[s for s, _ in expected[q]] for q in expected]
    assert np.mean([sum(g <= w[-1] + 1e-9 for g in gs) / len(w) for gs, w in zip(got, want)]) >= 0.97


@pytest.mark.parametrize("shape", ["noise", "clusters", "line"])
def test_graph_recall(shape):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(4000, 24))
    if shape == "clusters":
        points = rng.normal(size=(10, 24))[rng.integers(0, 10, 4000)] + 0.02 * points
    elif shape == "line":
        points = np.stack([np.cos(np.arange(4000) / 4000), np.sin(np.arange(4000) / 4000)], axis=1)
    points = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)
    graph = hnsw.build(points)
    found = hnsw.search(graph, points[::40])[:, :6]
    exact = np.argsort(-(points[::40] @ points.T), axis=1)[:, :6]
    sims = points[::40] @ points.T
    worst = np.take_along_axis(sims, exact[:, -1:], 1) - 1e-6
    assert (np.take_along_axis(sims, found, 1) >= worst).mean() >= 0.97
    for links in graph.links:
        for row in links:
            row = row[row >= 0]
            assert len(set(row.tolist())) == len(row) and (row < len(links)).all()
