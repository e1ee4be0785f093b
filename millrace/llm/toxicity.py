"""Toxicity severity by cumulative-link ordinal regression.

A document's features are which words and beginnings of words it holds, chosen
by how they divide the labelled rows. One weight vector is shared by all grades; ordered
thresholds cut the same score into grades:
``P(grade <= k) = logistic(threshold_k - score)``. The result is the expected
grade.

The label table only says toxic or not. Grades of severity come from it: words
are chosen by their log odds in toxic documents, and a toxic document's grade
grows with the number of different ones it holds (1 to 3). Documents that are not toxic have grade 0. A label column
``severity`` of whole numbers from 0 is used instead where there is one.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept_in_files

#: Labelled documents that training reads of each label, at most.
SAMPLE = 4000
#: Words and beginnings that the model may use.
CHOSEN = 4096
#: Letters of the beginnings of words that are features besides the word.
STEMS = (4, 5, 6)
#: Documents of the sample that a chosen word needs.
LEAST_DOCS = 5
#: Log odds of a chosen word, and the standard deviations by which it occurs in
#: more toxic documents than by chance.
STRONG = 3.5
CERTAIN = 6.0
RIDGE = 1e-4
STEPS = 400
#: Different chosen words from which on a toxic document's grade is 2, and 3.
GRADE_FROM = (5, 10)


class Reader:
    """Turns texts into the numbers of their words and of the beginnings of these.

    Beginnings stand for a stem, whose words have many endings. ``places`` gives
    the numbers that are wanted and what they become.
    """

    def __init__(self, places: dict[int, int] | None = None):
        self.places, self.seen = places, {}

    def numbers(self, text: str | None) -> np.ndarray:
        plain = (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPLIT).split()
        seen, out = self.seen, []
        for w in plain:
            found = seen.get(w)
            if found is None:
                if len(seen) > 200_000:
                    seen.clear()
                found = seen[w] = self._of(w)
            out += found
        return np.array(out, np.int64)

    def _of(self, word: bytes) -> tuple[int, ...]:
        letters = word.decode("utf-8", "replace")
        stems = [f"{letters[:n]}-" for n in STEMS if len(letters) > n]
        numbers = (zlib.crc32(x.encode()) for x in (letters, *stems))
        if self.places is None:
            return tuple(numbers)
        return tuple(self.places[n] for n in numbers if n in self.places)


_SPLIT = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class Model:
    """Weights of the chosen words by number, and the thresholds between grades."""

    places: dict[int, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def expected(self, score: np.ndarray) -> np.ndarray:
        """Expected grade: the chances of passing each threshold, summed."""
        return (1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))).sum(axis=1)


def fit(x_rows: list[np.ndarray], grades: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of the most likely cumulative-link model.

    Gradient steps (Adam) on the penalised likelihood. Thresholds are a first
    one and positive distances, so they stay in order.
    """
    n, top = len(x_rows), int(grades.max())
    owner = np.repeat(np.arange(n), [len(r) for r in x_rows])
    columns = np.concatenate(x_rows) if n else np.zeros(0, np.int64)
    values = np.zeros(width + top)
    values[width] = 1.0
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, STEPS + 1):
        w = values[:width]
        cuts = np.cumsum(np.concatenate([values[width : width + 1], np.exp(values[width + 1 :])]))
        score = np.bincount(owner, weights=w[columns], minlength=n)
        upper = 1 / (1 + np.exp(-np.clip(np.append(cuts, np.inf)[grades] - score, -40, 40)))
        lower = 1 / (1 + np.exp(-np.clip(np.append(-np.inf, cuts)[grades] - score, -40, 40)))
        upper[grades == top], lower[grades == 0] = 1.0, 0.0
        chance = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_cut = np.bincount(grades, weights=up, minlength=top + 1)[:top]
        by_cut = by_cut - np.bincount(grades, weights=low, minlength=top + 1)[1:]
        slope = np.empty_like(values)
        slope[:width] = np.bincount(columns, weights=(low - up)[owner], minlength=width)
        tail = np.cumsum(by_cut[::-1])[::-1]
        slope[width] = tail[0]
        slope[width + 1 :] = tail[1:] * np.exp(values[width + 1 :])
        slope /= max(1, n)
        slope[:width] -= RIDGE * w
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        values += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    cuts = np.cumsum(np.concatenate([values[width : width + 1], np.exp(values[width + 1 :])]))
    return values[:width], cuts


def _presence(docs: DataFrame, places: dict[int, int] | None) -> DataFrame:
    """``docs(grade, text)`` to the distinct words of each: ``words``."""
    # None, or no more than CHOSEN entries.
    shared = docs.sparkSession.sparkContext.broadcast(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            found = [np.unique(reader.numbers(text)) for text in batch.column(1).to_pylist()]
            words = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), words], names=["grade", "words"])

    return docs.select("grade", "text").mapInArrow(run, "grade int, words array<bigint>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model of ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``.

    Null labels and texts are left out; of several labels the highest counts. Of
    either label the ``sample`` documents with the smallest hashes of their ids
    are read. Word counts are summed by Spark over the sample; the driver
    gets one row for each chosen word, and the chosen words of the sample.
    None if one of the labels is missing.
    """
    name = "severity" if "severity" in labels.columns else "toxic"
    marks = (
        labels.where(F.col(name).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(name).cast("int")).alias("grade"))
    )
    toxic = F.col("grade") > 0
    by_hash = (F.xxhash64("doc_id"), F.col("doc_id"))
    drawn = marks.where(toxic).orderBy(*by_hash).limit(sample)
    drawn = drawn.union(marks.where(~toxic).orderBy(*by_hash).limit(sample))
    # At most twice the sample of rows of two numbers: small enough to send to
    # every task, so that no text is shuffled.
    texts = docs.where("text IS NOT NULL").select("doc_id", "text")
    drawn = texts.join(F.broadcast(drawn), "doc_id")
    drawn = kept_in_files(drawn.select("grade", "text"), "labelled-texts")
    counts = (
        _presence(drawn, None)
        .select((F.col("grade") > 0).alias("toxic"), F.explode("words").alias("word"))
        .groupBy("word")
        .agg(
            F.count(F.when(F.col("toxic"), 1)).alias("bad"),
            F.count(F.when(~F.col("toxic"), 1)).alias("good"),
        )
        .where(F.col("bad") + F.col("good") >= LEAST_DOCS)
    )
    totals = {r[0]: r[1] for r in drawn.groupBy(toxic).agg(F.count("*")).collect()}
    bad_n, good_n = totals.get(True, 0), totals.get(False, 0)
    if not bad_n or not good_n:
        return None
    bad, good, share = F.col("bad"), F.col("good"), bad_n / (bad_n + good_n)
    odds = F.log((bad + 0.5) / (bad_n + 1.0)) - F.log((good + 0.5) / (good_n + 1.0))
    strength = (bad - share * (bad + good)) / F.sqrt((bad + good) * (share * (1 - share)))
    chosen = (
        counts.where(odds >= STRONG)
        .select("word", strength.alias("strength"))
        .where(F.col("strength") >= CERTAIN)
        .orderBy(F.desc("strength"), "word")
        .limit(CHOSEN)
        .collect()
    )
    if not chosen:
        return None
    places = {row["word"]: k for k, row in enumerate(chosen)}
    x_rows, grades = [], []
    for row in _presence(drawn, places).toLocalIterator():
        words = np.array(row["words"], np.int64)
        grade = row["grade"]
        if name == "toxic" and grade > 0:
            grade = 1 + sum(len(words) >= least for least in GRADE_FROM)
        x_rows.append(words)
        grades.append(grade)
    learned, cuts = fit(x_rows, np.array(grades), len(places))
    return Model(places, learned, cuts)


_MODELS: dict[str, tuple[Model | None, Reader]] = {}


def rate(docs: DataFrame, model: Model | None) -> DataFrame:
    """Expected severity of every row of ``docs(doc_id, text)``.

    Columns: doc_id, expected_severity, grade (the nearest whole number) and
    toxic (more likely some grade above 0 than none). Whole texts count. A null
    or empty text has no words; without a model all severities are 0. Repeated
    and null ids are rows of their own. Other columns are not read.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MODELS:
            _MODELS.clear()
            _MODELS[name] = (shared.value, Reader(shared.value.places if shared.value else {}))
        model, reader = _MODELS[name]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if model is None:
                severity, toxic = np.zeros(len(texts)), np.zeros(len(texts), bool)
            else:
                score = np.array(
                    [model.weights[np.unique(reader.numbers(t))].sum() for t in texts]
                )
                severity, toxic = model.expected(score), score > model.thresholds[0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(severity, pa.float64()),
                    pa.array(np.rint(severity).astype(np.int32), pa.int32()),
                    pa.array(toxic, pa.bool_()),
                ],
                names=["doc_id", "expected_severity", "grade", "toxic"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, expected_severity double, grade int, toxic boolean"
    )
