from __future__ import annotations

import random

import pytest

from millrace.llm.line_dedup import dedup_lines, remove_repeated_lines, repeated_runs


def expected(texts, min_lines, min_words):
    """Windows of lines that occurred before go, over documents in order."""
    sequences = []
    for text in texts:
        lines = (text or "").split("\n")
        sequences.append([(k, x) for k, x in enumerate(lines) if x.strip(" \t\n\r\x0b\f")])
    gone: list[set] = [set() for _ in texts]
    for n in {1, min_lines}:
        seen = set()
        for d, own in enumerate(sequences):
            for at in range(len(own) - n + 1):
                window = tuple(x for _, x in own[at : at + n])
                if n < min_lines and len(window[0].split()) < min_words:
                    continue
                if window in seen:
                    gone[d].update(k for k, _ in own[at : at + n])
                seen.add(window)
    return [
        None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d])
        for d, t in enumerate(texts)
    ]


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_equals_brute_force(docs, min_lines):
    random.seed(8)
    pool = ["a", "b", "c d", "one two three four five", "six seven eight nine ten eleven", "", "  "]
    texts = [None, "", "\n\n", "a"] + ["\n".join(random.choices(pool, k=random.randint(1, 9))) for _ in range(25)]
    texts += ["rep\n" * 300, texts[6], "Unique line of five words here\n" + (texts[7] or "")]
    got = {r.doc_id: r for r in dedup_lines(docs([*enumerate(texts)]), min_lines, 5).collect()}
    for k, wanted in enumerate(expected(texts, min_lines, 5)):
        assert got[k].text == wanted, k
        assert got[k].n_lines == (0 if texts[k] is None else texts[k].count("\n") + 1)


def test_columns_order_and_repeated_rows(spark, docs):
    long = "one two three four five six"
    table = docs([(9, long), (2, long), (2, long), (None, long)])
    kept = remove_repeated_lines(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [(2, ""), (2, ""), (9, "")]
    assert [r.text for r in kept.collect() if r.doc_id is None] == [long]
    clash = table.withColumnRenamed("n_chars", "n_removed").withColumnRenamed("words", "n_lines")
    assert remove_repeated_lines(clash).columns == clash.columns
    assert remove_repeated_lines(docs([])).count() == 0


def test_lines_with_one_hash_stay_two(docs):
    pair = ["one lineand more a b c d e", "twoaahrf1Z}SwX}R a b c d e"]
    got = dedup_lines(docs(list(enumerate(pair))), 2, 5).collect()
    assert {r.doc_id: r.text for r in got} == dict(enumerate(pair))


def expected_runs(texts, min_lines):
    """The longest earlier copy at each place, unless it goes on from the line before."""
    sequences = [[x for x in (t or "").split("\n") if x.strip(" \t\n\r\x0b\f")] for t in texts]
    different = {}
    for d, own in enumerate(texts):
        if own is not None:
            different.setdefault(own, []).append(d)
    firsts = sorted(rows[0] for rows in different.values())
    runs = set()
    for rows in different.values():
        for d in rows[1:]:
            if len(sequences[d]) >= min_lines:
                runs.add((d, 0, len(sequences[d]), len(rows), rows[0], 0))
    for d in firsts:
        reached = 0
        for at in range(len(sequences[d])):
            for n in range(len(sequences[d]) - at, 0, -1):
                window = sequences[d][at : at + n]
                places = [
                    (e, k)
                    for e in firsts
                    for k in range(len(sequences[e]) - n + 1)
                    if sequences[e][k : k + n] == window
                ]
                if places[0] != (d, at):
                    copies = sum(len(different[texts[e]]) for e, _ in places)
                    if at + n > reached and n >= min_lines:
                        runs.add((d, at, n, copies, *places[0]))
                    reached = max(reached, at + n)
                    break
    return runs


@pytest.mark.parametrize("seed", [1, 2])
def test_maximal_runs_equal_brute_force(docs, seed):
    random.seed(seed)
    pool = ["a", "b", "c d", "", "one two three four five"]
    texts = [None, "", "a", "\n".join("xyzuvwstr")]
    texts += ["\n".join(random.choices(pool, k=random.randint(1, 14))) for _ in range(20)]
    texts += [texts[6], texts[6], "p\n" + texts[3] + "\nq", "o\n" + texts[3], "rep\n" * 23]
    texts += ["\n".join("xyzuvws") + "\nlast\n" + texts[5]]
    for least in (1, 3):
        got = {tuple(r) for r in repeated_runs(docs(list(enumerate(texts))), least).collect()}
        assert got == expected_runs(texts, least)


def test_runs_of_no_documents(docs):
    assert repeated_runs(docs([])).count() == 0
    assert repeated_runs(docs([(1, None), (2, ""), (3, "one line")])).count() == 0
