from __future__ import annotations

import itertools
import random
import zlib

import numpy as np

from millrace.llm.language import identify, train, viterbi, words_of

WORDS = {
    "en": "the house with window and thing without other which there should".split(),
    "de": "das haus mit fenster und ding ohne andere welche dort sollte zwischen".split(),
    "ru": "дом окно вещь который другой там должен".split(),
}


def slow_viterbi(scores, penalty):
    n, k = scores.shape
    best = max(
        itertools.product(range(k), repeat=n),
        key=lambda p: sum(scores[t, x] for t, x in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:])),
    )
    return sum(scores[t, x] for t, x in enumerate(best)) - penalty * sum(a != b for a, b in zip(best, best[1:]))


def test_viterbi_is_best():
    random.seed(3)
    lengths = np.array([random.randint(1, 6) for _ in range(30)] + [1, 6])
    scores = np.random.RandomState(1).normal(size=(lengths.sum(), 3)) * 2
    labels = viterbi(scores, lengths, 1.5)
    at = 0
    for n in lengths:
        own, path = scores[at : at + n], labels[at : at + n]
        got = own[np.arange(n), path].sum() - 1.5 * (np.diff(path) != 0).sum()
        assert abs(got - slow_viterbi(own, 1.5)) < 1e-9
        at += n


def _corpus(n=120):
    random.seed(5)
    rows = []
    for k in range(n):
        lang = list(WORDS)[k % 3]
        rows.append((k, " ".join(random.choices(WORDS[lang], k=30)), lang))
    return rows


def test_held_out_and_mixed(spark):
    rows = _corpus()
    schema = "doc_id long, text string, lang string, score double"
    extra = [(1000, None, "en"), (1001, " 12 !!", "de"), (None, rows[0][1], None), (0, rows[0][1], "en")]
    table = spark.createDataFrame([(*r, 1.0) for r in rows + extra], schema)
    model = train(table)
    assert model.languages == ["de", "en", "ru"]
    got = identify(table, model).collect()
    assert len(got) == len(rows) + len(extra)
    langs = {k: lang for k, _, lang in rows}
    for r in got:
        if r.doc_id in langs:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert r.lang_pred == langs[r.doc_id] and 0 < r.score <= 1
        elif r.doc_id is not None:
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
    mixed = " ".join(WORDS["en"] * 3 + WORDS["de"] + WORDS["ru"])
    found = identify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert [s["lang"] for s in found.spans] == ["en", "de", "ru"]
    assert found.spans[-1]["end"] == len(words_of(mixed)) and found.lang_pred == "en"


def test_nothing_to_learn(spark, docs):
    assert train(docs([(1, "some text")])) is None
    got = identify(docs([(1, "some text")]), None, with_spans=False).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)
    assert identify(docs([]), None).count() == 0


def test_copies_count_once_in_the_draw(docs):
    texts = ["ein kurzer satz", "noch ein langer satz", "drei worte hier"]
    rows = [(k, texts[k % 3]) for k in range(600)]
    model = train(docs(rows, "de"), sample=6)
    few = train(docs([(k, t) for k, t in rows if k < 60], "de"), sample=6)
    assert model.uses.any() and (model.scores == few.scores).all()


def test_more_labels_than_a_byte_holds():
    scores = np.zeros((6, 300))
    scores[:3, 7], scores[3:, 299] = 100, 100
    assert viterbi(scores, np.array([6])).tolist() == [7] * 3 + [299] * 3
    assert viterbi(np.repeat(scores, 64, axis=0), np.full(64, 6)).shape == (384,)


def test_letters_and_their_marks():
    from millrace.llm.language import words_of

    assert words_of("½ ② Ⅷ ² 12 _") == []
    assert words_of("Ab3c dé") == ["ab", "c", "dé"]
    assert words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert words_of("été") == ["été"]
    assert words_of("plain ASCII x2") == ["plain", "ascii", "x"]
