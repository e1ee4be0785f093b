from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neighbours
from millrace.llm.neighbours import balanced_partition, best_of_block, nearest, neighbour_graph
from millrace.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, v int, leaf string, query int"


def table(spark, pairs):
    return spark.createDataFrame([(i, x, 1, 2, "c", 3) for i, x in pairs], SCHEMA)


def exact(pairs, k, asks):
    """(query, rank, id, score) by brute force over valid (id, vector) rows."""
    pairs = sorted({(i, tuple(x)) for i, x in pairs})
    out = {}
    for i, x in pairs:
        if not asks(i):
            continue
        scored = sorted((-float(np.dot(np.float32(x).astype(float), np.float32(y).astype(float))), j) for j, y in pairs if j != i)
        out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for i, found in want.items():
        assert [j for j, _ in got[i]] == [j for j, _ in found], i
        assert np.allclose([s for _, s in got[i]], [s for _, s in found], rtol=0, atol=1e-12)


def clusters(n, dim, seed, centres=40):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, dim))
    return (middle[draw.integers(centres, size=n)] + 0.4 * draw.normal(size=(n, dim))).astype("float32")


def test_partition_is_balanced_and_keeps_edges():
    x = clusters(1200, 16, 1).astype(float)
    graph = neighbour_graph(x, 10)
    assert all(i not in row for i, row in enumerate(graph))
    parts = balanced_partition(x, graph, 8)
    assert np.bincount(parts, minlength=8).max() <= 1.1 * 1200 / 8 + 1
    kept = (parts[:, None] == parts[graph]).mean()
    assert kept > 0.6
    assert kept > 4 * (np.random.default_rng(0).permutation(parts)[:, None] == parts[graph]).mean()


def test_block_ties_and_copies():
    q, c = np.eye(2), np.array([[1.0, 0], [0, 1], [1, 0.0], [2, -3]])
    row, ids, score = best_of_block(q, c, np.array([7, 9, 4, 2, 1]), np.array([2, 1, 1, 1]), 3)
    assert list(zip(row, ids, score)) == [(0, 1, 2), (0, 2, 1), (0, 7, 1), (1, 4, 1), (1, 2, 0), (1, 7, 0)]


def test_whole_mass_is_exact(spark):
    x = clusters(700, 12, 2)
    pairs = [(3 * i, row.tolist()) for i, row in enumerate(x)]
    got = by_query(nearest(table(spark, pairs), F.col("vec_id") % 20 == 0, 5, mass=2.0))
    same(got, exact(pairs, 5, lambda i: i % 20 == 0))


def test_odd_rows_ties_copies(spark):
    x = clusters(300, 4, 3)
    good = [(i, row.tolist()) for i, row in enumerate(x)]
    good += [(1000 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(60)] + [(1003, [1.0, 0.0, 0.0, 0.0])]
    odd = [(2000, None), (2020, [0.0] * 4), (2040, [1.0, None, 0.0, 0.0]), (2060, [float("nan"), 1.0, 0.0, 0.0])]
    odd += [(2080, [float("inf"), 0.0, 0.0, 0.0]), (2100, []), (2120, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    got = by_query(nearest(table(spark, good + odd), F.col("vec_id") % 20 == 0, 20, mass=2.0))
    same(got, exact(good, 20, lambda i: i % 20 == 0))
    assert [j for j, _ in got[1000]][:20] == [j for j, _ in exact(good, 20, lambda i: i == 1000)[1000]]


def test_few_and_no_rows(spark):
    two = nearest(table(spark, [(0, [1.0, 2.0]), (5, [0.5, 0.5])]), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in two.collect()] == [(0, 1, 5, 1.5)]
    one = nearest(table(spark, [(0, [1.0, 2.0])]), F.col("vec_id") % 20 == 0)
    assert one.count() == 0
    none = nearest(table(spark, []), F.col("vec_id") % 20 == 0)
    assert none.count() == 0 and none.columns == ["query_id", "rank", "vec_id", "score"]


def test_levels_and_blocks(spark, monkeypatch):
    for name, value in (("LEAF", 60), ("SAMPLE", 300), ("PARTS", 4), ("BLOCK", 16), ("QUERIES", 8)):
        monkeypatch.setattr(neighbours, name, value)
    x = clusters(1500, 16, 4)
    pairs = [(i, row.tolist()) for i, row in enumerate(x)]
    got = by_query(nearest(table(spark, pairs), F.col("vec_id") % 20 == 0, 10))
    want = exact(pairs, 10, lambda i: i % 20 == 0)
    assert got.keys() == want.keys()
    recall = np.mean([len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 10 for i in want])
    assert recall >= 0.9


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_recall_of_the_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    pairs = [(r.vec_id, r.embedding) for r in rows]
    got = by_query(QUERIES["op11_nearest"](spark, folder))
    want = exact(pairs, 20, lambda i: i % 20 == 0)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    recall = np.mean([len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 20 for i in want])
    assert recall >= 0.9
    vectors = {i: np.float64(x) for i, x in pairs}
    assert all(abs(s - vectors[i] @ vectors[j]) < 1e-12 for i, found in got.items() for j, s in found)
