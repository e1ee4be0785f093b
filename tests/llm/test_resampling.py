from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm.resampling import cutoff, features, ranked, resample, weighted_median

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def bag(text, run=1):
    w = WORD.findall((text or "").translate(_LOWER))
    return w, Counter(" ".join(w[i : i + k]) for k in range(1, run + 1) for i in range(len(w) - k + 1))


def brute(docs, target, percent=10, least=20, run=1):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = Counter(), Counter()
    for texts, out in (([x for _, x in docs], s), (target, t)):
        for text in texts:
            for f, n in bag(text, run)[1].items():
                out[bucket(f)] += n
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out, able = [], []
    for row, (i, text) in enumerate(docs):
        w, found = bag(text, run)
        weight = sum(n * gain(bucket(f)) for f, n in found.items())
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, sum(found.values()), weight, score, None])
        if len(w) >= least:
            able.append(row)
    able.sort(key=lambda r: (-out[r][3], math.inf if out[r][0] is None else out[r][0]))
    for rank, r in enumerate(able[: percent * len(able) // 100]):
        out[r][4] = rank + 1
    return sorted(map(tuple, out), key=repr)


def collected(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, df.collect()), key=repr)


def made(n, seed=5):
    random.seed(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "日本", "A-b", "x1"]
    return [(i, " ".join(random.choices(words, k=random.choice([0, 5, 19, 20, 21, 60])))) for i in range(n)]


@pytest.mark.parametrize("run", [1, 2, 3])
@pytest.mark.parametrize("text", [None, "", "  ", "A a-B\x7fé É 1a_日本 ", "x " * 5])
def test_features(text, run):
    n, found = features(text, run)
    words, want = bag(text, run)
    assert n == len(words) and {k.decode(): v for k, v in found.items()} == want


@pytest.mark.parametrize("run", [1, 2])
def test_equals_brute_force(spark, docs, run):
    rows = made(400)
    target = ["w1 w2 w3 w4", "W5 w1 日本", None, ""]
    got = resample(docs(rows), spark.createDataFrame([(t,) for t in target], "text string"), run=run)
    assert collected(got) == brute(rows, target, run=run)


def test_nulls_copies_ties_long(spark, docs):
    target = spark.createDataFrame([("b c",)], "text string")
    text = "b c d e f " * 6
    rows = [(None, text), (None, None), (3, None), (4, "")] + [(7, text)] * 30 + [(9, "b " * 200_000)]
    rows += [(i, text + "z") for i in range(20, 40)]
    got = collected(resample(docs(rows), target, percent=50))
    want = brute(rows, ["b c"], percent=50)
    assert got == want
    assert sorted(r[4] for r in got if r[4] is not None) == list(range(1, 27))


def test_empty_tables(spark, docs):
    target = spark.createDataFrame([("b c",)], "text string")
    assert collected(resample(docs([]), target)) == []
    rows = made(60)
    assert collected(resample(docs(rows), target.limit(0))) == brute(rows, [])
    # Too few rows for one to be drawn.
    assert collected(resample(docs(rows[:3]), target)) == brute(rows[:3], ["b c"])


def test_weighted_median_discards_a_quarter():
    random.seed(1)
    for _ in range(50):
        groups = [sorted((random.randrange(50), random.randrange(9)) for _ in range(random.randrange(1, 40))) for _ in range(6)]
        pivot = weighted_median([(g[len(g) // 2], len(g)) for g in groups])
        flat = [k for g in groups for k in g]
        assert sum(k <= pivot for k in flat) >= len(flat) // 4
        assert sum(k >= pivot for k in flat) >= len(flat) // 4


def test_cutoff_and_ranks(spark):
    random.seed(2)
    keys = [(random.randrange(-20, 20), random.randrange(12)) for _ in range(500)]
    df = spark.createDataFrame(keys, "fall long, id long").repartition(7).cache()
    for wanted in (1, 2, 250, 499, 500):
        assert cutoff(df, wanted) == sorted(keys)[wanted - 1]
    assert cutoff(df, 0) is None and cutoff(df, 501) is None
    got = [tuple(r) for r in ranked(df, F.col("fall"), F.col("id")).orderBy("rank").collect()]
    assert [r[:2] for r in got] == sorted(keys) and [r[2] for r in got] == list(range(1, 501))
    df.unpersist()
