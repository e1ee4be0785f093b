from __future__ import annotations

import hashlib
import pickle
import random
import re

import numpy as np
import pytest

from millrace.llm.decontamination import (
    Benchmark, Search, find_contamination, merged, normal_form, remove_contaminated,
)

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(text, items, size=13):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, own in items:
        own = WORD.findall(lower(own))
        for k in range(max(1, len(own) - size + 1) if own else 0):
            window = own[k : k + size]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(str(item))
    names = ",".join(sorted(found))
    return (
        len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
        bool(hit) and 20 * len(hit) >= len(words),
    )


@pytest.mark.parametrize("pass_bytes", [8_000_000, 60])
def test_equals_brute_force(spark, docs, pass_bytes):
    random.seed(2)
    vocabulary = ["alpha", "Beta", "gamma", "été", "x1", "漢字"]
    items = [(k, " ".join(random.choices(vocabulary, k=random.choice([1, 3, 13, 15, 20])))) for k in range(12)]
    items += [(90, None), (91, ""), (92, "-- !!"), (10, items[10][1])]
    texts = [None, "", "!?", "Alpha", "alpha " * 40]
    texts += [
        ", ".join(random.choices(vocabulary, k=random.randint(1, 40))) + " " + random.choice(items[:12])[1].upper()
        for _ in range(40)
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = docs([*enumerate(texts), (None, "alpha"), (3, texts[3])])
    got = find_contamination(table, bench, pass_bytes=pass_bytes).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        text = "alpha" if row.doc_id is None else texts[row.doc_id]
        values = (row.n_words, row.n_hit, row.n_items, row.items_sha256, row.contaminated)
        assert values == expected(text, items), row.doc_id
    kept = remove_contaminated(table, bench, pass_bytes=pass_bytes)
    assert kept.columns == table.columns
    assert kept.count() == sum(not r.contaminated for r in got)


def test_passes_are_jobs_of_their_own(spark, docs):
    """Rows equal those of one pass, and the plan does not grow with the passes."""
    items = [(k, f"item{k} " + " ".join(f"w{k}x{i}" for i in range(14))) for k in range(8)]
    items.append((8, items[7][1] + " tail"))
    texts = [f"before {items[k][1]} and {items[(3 * k + 1) % 8][1].upper()}" for k in range(8)]
    table = docs([*enumerate([*texts, texts[0], None, "none of them"]), (None, items[7][1]), (3, "again")])
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = find_contamination(table, bench)
    many = find_contamination(table, bench, pass_bytes=300)
    assert many.schema == one.schema
    assert many._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") <= 1
    rows = sorted(map(repr, many.collect()))
    assert rows == sorted(map(repr, one.collect()))
    assert sum("n_items=0" not in r for r in rows) == 10


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    got = find_contamination(docs([(1, "a b"), (2, None)]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in sorted(got)] == [(2, 0, False), (0, 0, False)]
    assert find_contamination(docs([]), none).count() == 0


def test_search_skips_nothing():
    random.seed(1)
    for _ in range(200):
        text = bytes(random.choices(b"ab ", k=random.randint(0, 80)))
        strings = [b" " + bytes(random.choices(b"ab ", k=random.randint(2, 9))) + b" " for _ in range(4)]
        wanted = sorted((k, s) for s in set(strings) for k in range(len(text)) if text.startswith(s, k))
        distinct = sorted(set(strings))
        ends = np.cumsum([len(s) for s in distinct])
        search = Search(b"".join(distinct), ends - [len(s) for s in distinct], ends, np.arange(len(distinct)))
        assert sorted((k, distinct[number]) for k, number in search.occurrences(text)) == wanted


def test_tables_of_a_large_pass_are_small():
    """They grow with the windows, by less than what a worker can hold."""
    random.seed(3)
    vocabulary = ["".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(5000)]
    items = [(k, " ".join(random.choices(vocabulary, k=400))) for k in range(400)]
    size = sum(len(text) for _, text in items)
    assert size > 1_000_000
    bench = Benchmark(items, 13)
    assert len(pickle.dumps(bench)) < 20 * size + 21_000_000 * len(bench.searches)
    text = normal_form("before " + items[7][1][:300] + " after")
    ranges, names = bench.hits(text)
    assert names == {"7"} and merged(ranges)
