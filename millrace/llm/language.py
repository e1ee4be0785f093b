"""Language identification of mixed-language text.

A model counts hashed letter sequences of words by language over a bounded
sample of the labelled documents, and the scripts that each language uses. To
label a text, the script of a word narrows its candidate languages, every word
gets a score for each candidate, and a Viterbi pass with a penalty for a change
of language labels the spans. The text's language is the one with most letters.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of a language that training reads, on average.
SAMPLE = 2000
#: Hashed letter sequences, lengths counted, and what each score may reach.
FEATURES = 1 << 15
LENGTHS = (1, 2, 3, 4)
SMOOTHING = 0.5
FLOOR = -12.0
SWITCH = 8.0
#: A language uses a script if so large a part of its letters is in it.
SCRIPT_SHARE = 0.01
#: From so few texts on, a Viterbi step goes text by text.
FEW = 12

# Starts and ends of script ranges, in order.
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for name, _, _ in SCRIPTS)) + ("other",)
_STARTS = np.array([a for _, a, _ in SCRIPTS], np.uint32)
_ENDS = np.array([b for _, _, b in SCRIPTS], np.uint32)
_NUMBERS = np.array([SCRIPT_NAMES.index(name) for name, _, _ in SCRIPTS])
#: Letters with the marks that belong to them; other numerals are no letters.
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_ASCII_WORD = re.compile(r"[a-z]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    text = (text or "").lower()
    return (_ASCII_WORD if text.isascii() else _WORD).findall(text)


def scripts_of(codes: np.ndarray) -> np.ndarray:
    """Script number of each code point."""
    at = np.searchsorted(_STARTS, codes, "right") - 1
    inside = (at >= 0) & (codes <= _ENDS[at])
    return np.where(inside, _NUMBERS[at], len(SCRIPT_NAMES) - 1)


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed letter sequences of distinct words: word number, feature; and the
    script of each word's first letter."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    space = codes == 32
    word_at = np.cumsum(space) - 1
    numbers, features = [], []
    rolling = np.zeros(len(codes), np.uint64)
    for length in range(1, max(LENGTHS) + 1):
        n = len(codes) - length + 1
        if n <= 0:
            break
        rolling = (rolling[:n] * np.uint64(0x100000001B3)) ^ codes[length - 1 :].astype(np.uint64)
        # A sequence may begin and end with the space beside a word, not span it.
        inner = np.zeros(n, bool)
        for k in range(1, length - 1):
            inner |= space[k : k + n]
        good = ~inner
        if length <= 2:
            good &= ~space[:n] | (length == 2)
        if length == 1:
            good &= ~space
        if length == 2:
            good &= ~(space[:n] & space[1 : 1 + n])
        at = np.flatnonzero(good)
        mixed = (rolling[at] + np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
        features.append((mixed >> np.uint64(49)).astype(np.int64))
        numbers.append(np.minimum(word_at[at], len(words) - 1))
    firsts = np.flatnonzero(space)[:-1] + 1
    return np.concatenate(numbers), np.concatenate(features), scripts_of(codes[firsts])


@dataclass
class Model:
    """Scores of features by language, and the scripts of each language."""

    languages: list[str]
    scores: np.ndarray
    uses: np.ndarray
    cache: dict[str, int] = field(default_factory=dict)

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each word in each language, the best of a word being zero."""
        numbers, features, scripts = _features(words)
        total = np.empty((len(words), len(self.languages)))
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(
                numbers, weights=self.scores[features, k], minlength=len(words)
            )
        total -= total.max(axis=1, keepdims=True)
        allowed = self.uses[scripts]
        allowed = allowed | ~allowed.any(axis=1, keepdims=True)
        total[~allowed] = -1e6
        total -= total.max(axis=1, keepdims=True)
        return np.where(allowed, np.maximum(total, FLOOR), FLOOR)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best label of each row of ``scores``; texts of ``lengths`` lie end to end.

    Staying is preferred to an equally good change, and the first of equal
    labels to the others.
    """
    total, k = scores.shape
    labels = np.zeros(total, np.int64)
    if k == 1 or not total:
        return labels
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    order = np.argsort(-lengths, kind="stable")
    lengths, starts = lengths[order], starts[order]
    came = np.zeros((total, k), np.int8 if k <= 128 else np.int32)
    active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left")
    value = scores[starts[: active[0]]].copy()
    together = int(np.searchsorted(-active, -FEW, "right")) or 1
    for t in range(1, min(together, len(active))):
        n = active[t]
        if n < len(value):
            _end(value[n:], starts[n : len(value)] + lengths[n : len(value)] - 1, labels)
            value = value[:n]
        best = value.argmax(axis=1)
        change = value[np.arange(n), best] - penalty
        stay = value >= change[:, None]
        rows = starts[:n] + t
        came[rows] = np.where(stay, np.arange(k), best[:, None])
        value = np.where(stay, value, change[:, None]) + scores[rows]
    for j in range(len(value)):
        _alone(value[j], scores, came, int(starts[j]) + min(together, len(active)), int(starts[j] + lengths[j]), penalty)
        labels[starts[j] + lengths[j] - 1] = int(value[j].argmax())
    # Back from the ends, the same way.
    for t in range(len(active) - 1, 0, -1):
        n = active[t]
        if n >= FEW or t < together:
            rows = starts[:n] + t
            labels[rows - 1] = came[rows, labels[rows]]
        else:
            for row in (int(s) + t for s in starts[:n]):
                labels[row - 1] = came[row, labels[row]]
    return labels


def _end(value: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> None:
    labels[rows] = value.argmax(axis=1)


def _alone(value, scores, came, first: int, end: int, penalty: float) -> None:
    """Viterbi steps of one text, from row ``first`` on; ``value`` is updated."""
    now = value.tolist()
    for row, own in enumerate(scores[first:end].tolist(), first):
        top = max(now)
        change, best = top - penalty, now.index(top)
        for k, old in enumerate(now):
            if old >= change:
                came[row, k] = k
                now[k] = old + own[k]
            else:
                came[row, k] = best
                now[k] = change + own[k]
    value[:] = now


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 5 == 0


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model of ``docs(doc_id, text, lang)`` that are not held out.

    Rows with a null lang or text are left out. Of each language, a sample of
    ``sample`` different texts on average is drawn by a hash of the text; copies
    count once. Counts are
    summed by Spark; one number per feature and language comes to the driver.
    None if there is nothing to learn from.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc_id")))
    # Hashes stand for the texts: only the size of the draw rests on these counts.
    distinct = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    sizes = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    part = F.pmod(F.xxhash64("text", F.lit("train")), F.lit(1_000_000))
    limit = F.lit(0)
    for lang, n in sorted(sizes.items()):
        limit = F.when(F.col("lang") == lang, F.lit(max(1, sample * 1_000_000 // n))).otherwise(limit)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        width = FEATURES + len(SCRIPT_NAMES)
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if words:
                    _, features, scripts = _features(words)
                    total = sums.setdefault(lang, np.zeros(width, np.int64))
                    total[:FEATURES] += np.bincount(features, minlength=FEATURES)
                    total[FEATURES:] += np.bincount(scripts, minlength=len(SCRIPT_NAMES))
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(total[at])],
                names=["lang", "feature", "n"],
            )

    found = (
        rows.where(part < limit)
        .select("text", "lang")
        .distinct()
        .mapInArrow(count, "lang string, feature long, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(sizes)
    counts = np.zeros((FEATURES + len(SCRIPT_NAMES), len(languages)))
    place = {lang: k for k, lang in enumerate(languages)}
    counts[found["feature"].to_numpy(np.int64), [place[x] for x in found["lang"]]] = found["n"]
    letters, scripts = counts[:FEATURES], counts[FEATURES:]
    scores = np.log((letters + SMOOTHING) / (letters.sum(axis=0) + SMOOTHING * FEATURES))
    uses = scripts > SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0))
    return Model(languages, scores, uses)


_MODELS: dict[str, Model] = {}


def identify(docs: DataFrame, model: Model | None, *, with_spans: bool = True) -> DataFrame:
    """Language of every row of ``docs(doc_id, text)``.

    Columns: doc_id, held_out, lang_pred, score (the part of the letters that
    is labelled so) and, if wanted, spans of words of one language. ``und`` and
    score 0 for a text that is null or has no letters, or without a model. Of
    languages with equally many letters the first by name is predicted. Other
    columns are not read.
    """
    # The size of the model is fixed by FEATURES and the number of languages.
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MODELS:
            _MODELS.clear()
            _MODELS[name] = shared.value
        for batch in batches:
            found = _label(_MODELS[name], batch.column(2).to_pylist(), with_spans)
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array(found[0], pa.string()), pa.array(found[1], pa.float64())]
            names = ["doc_id", "held_out", "lang_pred", "score"]
            if with_spans:
                kind = pa.list_(
                    pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
                )
                columns.append(pa.array(found[2], kind))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    if with_spans:
        schema += ", spans array<struct<first: int, end: int, lang: string>>"
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(run, schema)


def _label(model: Model | None, texts: list[str | None], with_spans: bool):
    words_by = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in words_by], np.int64)
    langs, scores, spans = ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    if model is None or not lengths.sum():
        return langs, scores, spans
    place: dict[str, int] = {}
    numbers = np.fromiter(
        (place.setdefault(w, len(place)) for words in words_by for w in words),
        np.int64,
        int(lengths.sum()),
    )
    distinct = list(place)
    sizes = np.array([len(w) for w in distinct], np.int64)[numbers]
    has = np.flatnonzero(lengths)
    labels = viterbi(model.emissions(distinct)[numbers], lengths[has])
    k = len(model.languages)
    owner = np.repeat(np.arange(len(has)), lengths[has])
    letters = np.bincount(owner * k + labels, weights=sizes, minlength=len(has) * k).reshape(-1, k)
    best = letters.argmax(axis=1)
    for row, (at, b) in enumerate(zip(has.tolist(), best.tolist())):
        langs[at] = model.languages[b]
        scores[at] = float(letters[row, b] / letters[row].sum())
    if with_spans:
        first = 0
        for at, n in zip(has.tolist(), lengths[has].tolist()):
            own = labels[first : first + n]
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), n]
            spans[at] = [
                {"first": a, "end": b, "lang": model.languages[own[a]]}
                for a, b in zip(cuts, cuts[1:])
            ]
            first += n
    return langs, scores, spans
