from __future__ import annotations

import random

import numpy as np

from millrace.llm.toxicity import fit, rate, train

BAD = ["idiotic", "moronic", "scummy", "trashy"]


def _corpus(n=400):
    random.seed(9)
    word = lambda: "".join(random.choices("aeiounrst", k=4))
    rows, marks = [], []
    for k in range(n):
        words = [word() for _ in range(40)]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(1 + k % 3):
                words.insert(random.randrange(40), random.choice(BAD))
        rows.append((k, " ".join(words)))
        marks.append((k, int(toxic)))
    return rows, marks


def test_toxic_found_and_clean_left(spark, docs):
    rows, marks = _corpus()
    odd = [(1000, None), (1001, ""), (None, "idiotic scummy"), (0, rows[0][1]), (1002, "fine text " * 9000)]
    table = docs(rows + odd)
    labels = spark.createDataFrame([*marks, (7, None), (None, 1)], "doc_id long, toxic int")
    got = rate(table, train(table, labels)).collect()
    assert len(got) == len(rows) + len(odd)
    wanted = dict(marks)
    wrong = [r.doc_id for r in got if r.doc_id in wanted and r.toxic != bool(wanted[r.doc_id])]
    assert len(wrong) <= 2
    for r in got:
        assert 0 <= r.expected_severity <= 3
        if r.doc_id in (1000, 1001, 1002):
            assert not r.toxic
        if r.doc_id is None:
            assert r.toxic


def test_severity_column_and_order():
    random.seed(1)
    grades = np.array([k % 4 for k in range(400)])
    rows = [np.array(sorted({*random.sample(range(3, 40), 3), *range(g)})) for g in grades]
    weights, cuts = fit(rows, grades, 40)
    assert (np.diff(cuts) > 0).all()
    score = np.array([weights[r].sum() for r in rows])
    severity = (1 / (1 + np.exp(cuts[None, :] - score[:, None]))).sum(axis=1)
    means = [severity[grades == g].mean() for g in range(4)]
    assert means == sorted(means) and np.abs(np.rint(severity) - grades).mean() < 0.1


def test_nothing_to_learn(spark, docs):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert train(docs([(1, "a")]), labels) is None
    assert train(docs([(1, "a")]), labels.limit(0)) is None
    assert rate(docs([(1, "idiotic")]), None).first().toxic is False
    assert rate(docs([]), None).count() == 0
