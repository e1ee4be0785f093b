"""Percentiles and previous rows against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.ordering import previous_value
from millrace.functions.percentiles import exact_percentiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.95, 0.99, 1.0]


def samples(kind):
    r = random.Random(7)
    return {
        "single": [5.0],
        "two": [1.0, 2.0],
        "ties": [3.0] * 700 + [r.uniform(0, 9) for _ in range(300)],
        "signs": [r.gauss(0, 100) for _ in range(500)] + [0.0] * 50,
        "tail": [r.uniform(1, 2) for _ in range(990)] + [1e9 * r.random() for _ in range(10)],
        "extremes": [1e-310, -1e-310, 0.0, 1.7e308, -1.7e300, 1e-300] * 3,
        "tiny": [r.random() / 1e6 for _ in range(200)],
    }[kind]


@pytest.mark.parametrize("kind", ["single", "two", "ties", "signs", "tail", "tiny", "extremes"])
def test_percentiles_equal_numpy(make, kind):
    data = samples(kind)
    df = make("v double", [(x,) for x in data] + [(None,)])
    found = {r["probability"]: r for r in exact_percentiles(df, ["v"], PROBABILITIES).collect()}
    assert set(found) == set(PROBABILITIES)
    for p in PROBABILITIES:
        assert math.isclose(found[p]["percentile"], float(np.quantile(data, p)), rel_tol=1e-12)
        assert found[p]["samples"] == len(data)


def test_percentiles_by_group_and_column(make):
    r = random.Random(3)
    data = [(g, r.uniform(-5, 5), r.uniform(0, 1)) for g in ["a", "b", None] for _ in range(200)]
    df = make("g string, x double, y double", data)
    found = exact_percentiles(df, ["x", "y"], [0.5, 0.9], ["g"]).collect()
    assert len(found) == 3 * 2 * 2
    for row in found:
        place = {"x": 1, "y": 2}[row["column"]]
        own = [d[place] for d in data if d[0] == row["g"]]
        assert math.isclose(row["percentile"], float(np.quantile(own, row["probability"])))


def test_percentiles_of_nothing(make):
    assert exact_percentiles(make("v double", []), ["v"], [0.5]).count() == 0


def test_previous_value_crosses_buckets(make):
    data = [(k, i, i * 10 if i % 3 else None) for k in ["a", "b", None] for i in range(0, 50, 2)]
    df = make("k string, i long, v long", data)
    out = previous_value(df, ["k"], "i", "v", "before", F.floor(F.col("i") / 7))
    found = {(r["k"], r["i"]): r["before"] for r in out.collect()}
    for k in ["a", "b", None]:
        own = [d for d in data if d[0] == k]
        for before, row in zip([None, *own], own):
            assert found[(k, row[1])] == (before[2] if before else None)
