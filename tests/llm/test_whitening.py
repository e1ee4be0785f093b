from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from millrace.llm.queries import QUERIES
from millrace.llm.whitening import components, deviations, whiten, whole_sums

SCHEMA = "vec_id long, embedding array<float>, label int, x int, digest string, n int, white int"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "exact_deviation"]


def table(spark, pairs):
    return spark.createDataFrame([(i, v, 1, 2, "c", 3, 4) for i, v in pairs], SCHEMA)


def brute(pairs, wanted=4, multiplicity=False):
    """{(id, place of the row): (deviation, whitened row)}, n, explained."""
    rows = [
        (i, tuple(math.floor(256 * float(np.float32(c))) for c in v))
        for i, v in pairs
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    times = Counter(x for _, x in rows)
    fit = np.array([x for x, t in times.items() for _ in range(t if multiplicity else 1)])
    n, sums = len(fit), [sum(int(row[d]) for row in fit) for d in range(fit.shape[1])]
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(wanted, (values > 1e-10 * values.sum()).sum())
    out = []
    for i, x in rows:
        off = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out.append((i, off, (np.array(x) - fit.mean(axis=0)) @ vectors[:, :keep] / np.sqrt(values[:keep])))
    return out, n, values[:keep] / values.sum()


def same(got, pairs, multiplicity=False):
    assert got.columns == COLUMNS
    want, n, explained = brute(pairs, multiplicity=multiplicity)
    rows = got.collect()
    assert len(rows) == len(want) * len(explained)
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert rows[0].identity_error < 1e-8
    by_key = {}
    for r in rows:
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        assert r.deviation == r.exact_deviation
        by_key.setdefault((r.vec_id, r.component), []).append((r.deviation, r.whitened))
    signs = {}
    for k in range(len(explained)):
        mine = np.array([w for (_, c), found in sorted(by_key.items(), key=repr) if c == k + 1 for _, w in sorted(found)])
        theirs = np.array([w for _, _, w in sorted(((repr(i), off, w[k]) for i, off, w in want))])
        mine_sorted = np.sort(mine)
        signs[k] = min(np.abs(mine_sorted - np.sort(s * theirs)).max() for s in (1, -1))
        assert signs[k] < 1e-8
    assert sorted((repr(i), off) for i, off, _ in want) == sorted(
        (repr(i), off) for (i, c), found in by_key.items() if c == 1 for off, _ in found
    )


def drawn(n, dim, seed=1):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, dim)) * np.linspace(2, 0.5, dim)).astype("float32").tolist()


@pytest.mark.parametrize("multiplicity", [False, True])
def test_equals_brute_force_with_copies(spark, multiplicity):
    vectors = drawn(200, 6)
    pairs = list(enumerate(vectors)) + [(1000 + i, vectors[3]) for i in range(90)] + [(5, vectors[5]), (None, vectors[6])]
    same(whiten(table(spark, pairs), multiplicity=multiplicity), pairs, multiplicity)


def test_each_row_is_projected_on_its_component(spark):
    pairs = list(enumerate(drawn(60, 5, seed=4)))
    want, _, _ = brute(pairs)
    got = {(r.vec_id, r.component): r.whitened for r in whiten(table(spark, pairs)).collect()}
    for k in range(4):
        ratio = np.array([got[i, k + 1] / w[k] for i, _, w in want])
        assert np.allclose(ratio, ratio[0], atol=1e-7) and abs(abs(ratio[0]) - 1) < 1e-9


def test_odd_rows(spark):
    good = list(enumerate(drawn(40, 3, seed=2)))
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 1.0]), (103, [1.0, float("-inf"), 0.0])]
    odd += [(104, []), (105, [1.0, 2.0])]
    same(whiten(table(spark, good + odd)), good)
    zero = good + [(200, [0.0, 0.0, 0.0]), (201, [-0.0, 0.0, 0.0])]
    same(whiten(table(spark, zero)), zero)


def test_no_variance_and_no_rows(spark):
    for pairs in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]):
        got = whiten(table(spark, pairs))
        assert got.columns == COLUMNS and got.count() == 0
    line = [(i, [float(i), float(2 * i), 0.0]) for i in range(20)]
    got = whiten(table(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 20
    assert abs(got[0].explained - 1) < 1e-12


def test_exact_numbers():
    x = np.array([[1 << 62, -3], [5, (1 << 62) - 1]])
    assert whole_sums(x, np.array([2, 3])).tolist() == [(1 << 63) + 15, -6 + 3 * ((1 << 62) - 1), 5]
    sums = [10**20, -7]
    assert deviations(x, 9, sums) == [sum((9 * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert deviations(np.array([[2, 3]]), 4, [1, 20]) == [49 + 64]
    values, vectors = components(np.diag([1.0, 5.0, 3.0]), 2)
    assert values.tolist() == [5, 3] and (vectors.max(axis=0) == 1).all()


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    pairs = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    same(QUERIES["op13_whitening"](spark, folder), pairs)
