from __future__ import annotations

import collections
import random
import re

from millrace.llm.quality_rules import base_statistics, judge, learn_rules, remove_rejected, with_features

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    grams = list(zip(words, words[1:], words[2:]))
    seen = collections.Counter(grams)
    covered = {k + d for k, g in enumerate(grams) if seen[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_statistics_equal_brute_force(docs):
    random.seed(4)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "x x x x x", "é ü\x0bß\x1fq z", "a\n\na\n a"]
    texts += [" ".join(random.choices("abcd#", k=random.randint(1, 60))) for _ in range(30)]
    texts.append("lorem ipsum dolor sit amet " * 4000)
    found = base_statistics(docs(list(enumerate(texts)))).collect()
    assert len(found) == len(texts)
    for row in found:
        assert (
            row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words
        ) == expected(texts[row.doc_id]), row.doc_id


def _labelled(n=300):
    random.seed(7)
    good = [" ".join(f"w{random.randint(0, 999)}" for _ in range(80)) for _ in range(n)]
    bad = [" ".join(f"w{random.randint(0, 999)}##" for _ in range(80)) for _ in range(n // 3)]
    return list(enumerate(good + bad)), [(k, 1) for k in range(n)] + [(n + k, 0) for k in range(len(bad))]


def test_rules_reject_what_labels_reject(spark, docs):
    rows, marks = _labelled()
    labels = spark.createDataFrame([*marks, (None, 0), (5, None)], "doc_id long, quality int")
    table = docs([*rows, (None, None), (9, rows[9][1])])
    got = judge(table, labels).collect()
    assert len(got) == len(rows) + 2
    wanted = dict(marks)
    for row in got:
        if row.doc_id is None:
            assert row.base_failed and not row.kept
        else:
            assert row.kept == (wanted[row.doc_id] == 1)
    kept = remove_rejected(table, labels)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([k for k, q in marks if q] + [9])


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = judge(docs([(1, "w " * 60), (2, " ".join(map(str, range(60))))]), none)
    assert {r.doc_id: (r.base_failed, r.kept) for r in got.collect()} == {1: (True, False), 2: (False, True)}
    assert judge(docs([]), none).count() == 0
    assert learn_rules(with_features(base_statistics(docs([]))), none) == []


def test_only_native_functions(docs, spark):
    plan = judge(docs([(1, "a")]), spark.createDataFrame([], "doc_id long, quality int"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
