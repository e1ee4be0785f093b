from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from millrace.llm.components import components
from millrace.llm.simhash import (
    _stars, allocate, correlated_blocks, fingerprint_of, keep_one_of_each, links, near_duplicates,
)


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance=2):
    """Smallest member of the component of each value."""
    top = {v: v for v in values}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in values:
        for b in values:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= distance and find(a) != find(b):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def near_values(seed, centres, n):
    random.seed(seed)
    out = set()
    for _ in range(centres):
        centre = random.getrandbits(64)
        for _ in range(n):
            value = centre
            for _ in range(random.randint(0, 4)):
                value ^= 1 << random.randrange(64)
            out.add(value - 2**64 if value >> 63 else value)
    return sorted(out)


@pytest.mark.parametrize("text", [None, "", " ", "One", "a b", "A b C d", "x " * 700, "é ü z"])
def test_fingerprint(text):
    assert fingerprint_of(text) == slow_fingerprint(text)


@pytest.mark.parametrize("bucket", [2048, 4])
def test_links_keep_every_component(spark, bucket):
    values = near_values(3, 12, 25)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    found = components(links(fps, bucket=bucket))
    root = {v: v for v in values} | {r.node: r.root for r in found.collect()}
    assert root == classes(values)


def test_stars_of_a_bucket():
    values = near_values(5, 1, 400)
    top = {v: v for v in values}
    for a, b in _stars(values, 2):
        x, y = min(top[a], top[b]), max(top[a], top[b])
        top = {k: x if v == y else v for k, v in top.items()}
    assert top == classes(values)


def test_allocation_and_blocks():
    cost, chosen = allocate([{-1: 0, 0: 5, 1: 50}, {-1: 0, 0: 1, 1: 2}, {-1: 0, 0: 9}], 0)
    assert sum(chosen) == 0 and cost == 7
    bits = np.random.RandomState(0).rand(500, 64) < 0.5
    bits[:, 40] = bits[:, 3]
    pairs = (bits.T.astype(float) @ bits)
    blocks = correlated_blocks(pairs, 500, 3)
    assert sorted(b for x in blocks for b in x) == list(range(64))
    assert any(3 in x and 40 in x for x in blocks)


def test_rows_nulls_copies(docs):
    rows = [(5, "a b c d"), (3, "a b c d"), (9, None), (8, ""), (None, "a b c d"), (5, "a b c d"), (7, "q r s t u v w")]
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(docs(rows)).collect()), key=str)
    zero = classes([slow_fingerprint(t) for t in ("a b c d", "", "q r s t u v w")])
    assert len(zero) == len(set(zero.values()))
    assert got == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (None, 3), (5, 3), (7, 7)], key=str)
    kept = keep_one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, 8, 7], key=str)
    assert near_duplicates(docs([])).count() == 0


def test_long_chain(spark):
    n = 200
    chain = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(500, 500)], "a long, b long")
    assert {r.node: r.root for r in components(chain).collect()} == {k: 0 for k in range(1, n + 1)}
