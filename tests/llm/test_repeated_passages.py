from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

import millrace.llm.repeated_passages as passages
from millrace.llm.repeated_passages import anchors, remove_repeated, two_stage_order


def expected(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[s : s + length] for b in data for s in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_two_stage_order():
    random.seed(1)
    for _ in range(400):
        depth = random.choice([1, 2, 3, 5, 8])
        letters = range(97, 97 + random.choice([1, 2, 3, 5]))
        pieces = [bytes(random.choices(letters, k=depth + random.randint(0, 12))) for _ in range(random.randint(1, 6))]
        runs, at = [], 0
        for p in pieces:
            runs.append((at, at + len(p) - depth + 1))
            at += len(p)
        text = b"".join(pieces)
        order = two_stage_order(text, runs, depth)
        assert sorted(order) == [s for a, b in runs for s in range(a, b)]
        keys = [text[s : s + depth] for s in order]
        assert keys == sorted(keys)


def test_anchors_cover_all_windows_in_chunks(monkeypatch):
    random.seed(2)
    text = bytes(random.choices(b"abc", k=5000))
    whole = anchors(text)
    assert sum(n for _, _, n, _ in whole) == len(text) - 399
    assert all(first <= place <= first + 400 - passages.GRAM for _, first, _, place in whole)
    monkeypatch.setattr(passages, "CHUNK", 700)
    parts = anchors(text)
    expand = lambda rows: [(h, p) for h, _, n, p in rows for _ in range(n)]
    assert expand(parts) == expand(whole)


def _texts():
    random.seed(6)
    word = lambda: "".join(random.choices("abcdeé", k=random.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, long = prose(120), prose(400)
    texts = [None, "", "short", "x" * 399, "y" * 400, "z" * 1200, prose(50)]
    texts += [prose(30) + shared + prose(30) for _ in range(12)]
    texts += [long, long, long + "!", shared[:405], " ab" * 300]
    edited = long.split(" ")
    edited[200] = "EDIT"
    return texts + [" ".join(edited), prose(300)]


@pytest.mark.parametrize("large, pieces", [(1000, 1000), (3, 1000), (3, 2)])
def test_equals_brute_force(docs, monkeypatch, large, pieces):
    monkeypatch.setattr(passages, "LARGE", large)
    monkeypatch.setattr(passages, "PIECES", pieces)
    texts = _texts()
    rows = [*enumerate(texts)]
    got = {r.doc_id: r for r in remove_repeated(docs(rows)).collect()}
    assert len(got) == len(texts)
    for k, wanted in enumerate(expected(texts, 400)):
        r = got[k]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == wanted, k
        assert sum(s["end"] - s["first"] for s in r.spans) == r.n_removed


def test_repeated_rows_and_none(docs):
    long = "lorem ipsum " * 50
    got = remove_repeated(docs([(1, long), (1, long), (None, "a")])).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == [(1, 0), (600, 600), (600, 600)]
    assert remove_repeated(docs([])).count() == 0


def test_texts_with_one_hash_stay_two(spark, docs):
    pair = ["one lineand more a b c d e", "twoaahrf1Z}SwX}R a b c d e"]
    table = docs(list(enumerate(pair)))
    assert table.selectExpr("xxhash64(text) AS h").distinct().count() == 1
    got = {r.doc_id: r for r in remove_repeated(table).collect()}
    for k, text in enumerate(pair):
        assert (got[k].n_removed, got[k].kept_sha256) == (0, hashlib.sha256(text.encode()).hexdigest())
