"""Importance resampling towards a target distribution.

Every text is a bag of hashed runs of words. The gain of a bucket is the log ratio
of its frequency in the target texts to that in the documents; the weight of a
document is the sum of its gains. Keys with Gumbel noise make the highest scores
a draw without replacement in proportion to the weights.

The cutoff of the draw is found by selection, not by a sort of all rows. Each
round, every partition gives the median of its keys that are still possible, on
both sides of the last pivot. The median of these medians, weighted by the
numbers of keys behind them, is the next pivot: a quarter of the keys at least
is discarded, until the cutoff key itself is known. Only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, kept_in_files

BUCKETS = 10_000
#: Words of the longest run that is a feature.
RUN = 1
#: Least number of words of a document that can be drawn.
LEAST_WORDS = 20
#: Percent of these documents that are drawn.
PERCENT = 10
SEED = 2024

#: Bytes of words, in lower case, and a blank for all others.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
#: Different features that a worker remembers the buckets of.
_KNOWN_LIMIT = 200_000


class _Buckets(dict):
    """Bucket of a feature; forgets all when it holds very many."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _KNOWN_LIMIT:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features(text: str | None, run: int = RUN) -> tuple[int, Counter]:
    """Number of words, and the runs of 1 to ``run`` words with their counts."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split(b" ")
    found = Counter(words)
    blanks = found.pop(b"", 0)
    n = len(words) - blanks
    if run > 1:
        words = [w for w in words if w]
        for k in range(2, run + 1):
            found.update(b" ".join(words[i : i + k]) for i in range(n - k + 1))
    return n, found


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: occurrences of the features of ``texts(text)``. Each task
    sums its own before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(buckets)
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = features(text.as_py(), run)[1]
                at = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
                np.add.at(total, at, np.fromiter(found.values(), np.int64, len(found)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    return (
        texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    )


def gains(source: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket; only the counts of the buckets reach the driver."""

    def collected(texts: DataFrame) -> list[int]:
        out = [0] * buckets
        for row in bucket_counts(texts, run, buckets).collect():
            out[row.bucket] = row.n
        return out

    s, t = collected(source), collected(target)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return [
        math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s, t)
    ]


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document, in thousandths."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, gain: list[int], run: int = RUN, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of each row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(buckets)
        array = np.array(gain, np.int64)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, found = features(text.as_py(), run)
                at = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
                times = np.fromiter(found.values(), np.int64, len(found))
                weight = int(array[at] @ times)
                out.append((n, int(times.sum()), weight, weight + noise(doc_id, seed)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([row[i] for row in out], pa.int64()) for i in range(4)],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, n_words long, n_features long, weight long, score long"
    )


# ---------------------------------------------------------------- selection

#: A key: higher scores are better, then smaller ids. A missing id is the last.
Key = tuple[int, int]
_NO_ID = (1 << 63) - 1


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The key at which half of the weight is reached."""
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def _counts(keys: DataFrame, low: Key | None, pivot: Key | None, high: Key | None) -> list:
    """One row for each partition: numbers of keys that are better than, equal to
    and worse than ``pivot``, and the medians of the better and the worse ones.
    Keys not strictly between ``low`` and ``high`` are left out."""

    def side(score: np.ndarray, order: np.ndarray) -> tuple[int, Key | None]:
        if not len(score):
            return 0, None
        at = np.lexsort((order, score))[len(score) // 2]
        return len(score), (int(score[at]), int(order[at]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, orders, equal = [], [], 0
        for batch in batches:
            # Falling score as rising numbers: smaller keys are better.
            score, order = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            keep = np.ones(len(score), bool)
            for bound, sign in ((low, 1), (high, -1)):
                if bound is not None:
                    first, second = sign * (score - bound[0]), order
                    keep &= (first > 0) | ((first == 0) & ((second > bound[1]) if sign > 0 else (second < bound[1])))
            scores.append(score[keep])
            orders.append(order[keep])
        if not scores:
            return
        score, order = np.concatenate(scores), np.concatenate(orders)
        if pivot is None:
            better = np.zeros(len(score), bool)
            same = better
        else:
            better = (score < pivot[0]) | ((score == pivot[0]) & (order < pivot[1]))
            same = (score == pivot[0]) & (order == pivot[1])
        equal = int(same.sum())
        worse = ~better & ~same
        (n, a), (m, b) = side(score[better], order[better]), side(score[worse], order[worse])
        if n + m + equal:
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "better": n,
                        "equal": equal,
                        "worse": m,
                        "a": None if a is None else list(a),
                        "b": None if b is None else list(b),
                    }
                ],
                schema=pa.schema(
                    [
                        ("better", pa.int64()),
                        ("equal", pa.int64()),
                        ("worse", pa.int64()),
                        ("a", pa.list_(pa.int64())),
                        ("b", pa.list_(pa.int64())),
                    ]
                ),
            )

    near = keys
    if low is not None:
        near = near.where(F.col("fall") >= low[0])
    if high is not None:
        near = near.where(F.col("fall") <= high[0])
    return near.mapInArrow(count, "better long, equal long, worse long, a array<long>, b array<long>").collect()


def cutoff(keys: DataFrame, wanted: int) -> Key | None:
    """The key at place ``wanted`` (from 1) of ``keys(fall, id)`` in rising order;
    None if there is no such place. Only a row for each partition and round
    reaches the driver."""
    if wanted < 1:
        return None
    low = high = None
    found = _counts(keys, None, None, None)
    if sum(r["worse"] for r in found) < wanted:
        return None
    medians = [(tuple(r["b"]), r["worse"]) for r in found if r["worse"]]
    while True:
        pivot = weighted_median(medians)
        found = _counts(keys, low, pivot, high)
        better, equal = sum(r["better"] for r in found), sum(r["equal"] for r in found)
        if wanted <= better:
            high = pivot
            medians = [(tuple(r["a"]), r["better"]) for r in found if r["better"]]
        elif wanted <= better + equal:
            return pivot
        else:
            wanted -= better + equal
            low = pivot
            medians = [(tuple(r["b"]), r["worse"]) for r in found if r["worse"]]


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``rank`` from 1 in the given order. Sorted in ranges; only the
    number of rows of each range is summed up on its own."""
    placed = kept_in_files(
        rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "sorted-winners"
    )
    part = F.shiftright("at", 33)
    # One row for each range.
    sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    starts, seen = [], 0
    for number in sorted(sizes):
        starts.append((number, seen))
        seen += sizes[number]
    first = rows.sparkSession.createDataFrame(starts, "part long, first long")
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(first), "part")
        .withColumn("rank", F.col("first") + within + 1)
        .drop("part", "first", "at")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_features, weight,
    score, rank (from 1 for those drawn, else null).

    ``percent`` of the documents with ``least_words`` words or more are drawn,
    rounded down, by falling score, ties by rising id; a null id comes last and
    has the noise of an empty id. Repeated rows are documents of their own, with
    ranks in any order among themselves. A null text has no words. Other columns
    are not read. An empty table gives no rows; an empty target has counts of
    zero.
    """
    gain = gains(docs, target, run, buckets)
    rows = kept_in_files(scored(docs, gain, run, buckets, seed), "scored-documents")
    able = F.col("n_words") >= least_words
    keys = rows.where(able).select(
        (-F.col("score")).alias("fall"), F.coalesce("doc_id", F.lit(_NO_ID)).alias("id")
    )
    wanted = keys.count() * percent // 100
    last = cutoff(keys, wanted)
    out = ["doc_id", "n_features", "weight", "score"]
    nothing = F.lit(None).cast("long").alias("rank")
    if last is None:
        return rows.select(*out, nothing)
    order = F.coalesce("doc_id", F.lit(_NO_ID))
    fall = -F.col("score")
    wins = able & ((fall < last[0]) | ((fall == last[0]) & (order <= last[1])))
    # Repeats of the cutoff key may exceed the number to draw.
    drawn = ranked(rows.where(wins).select(*out), F.desc("score"), order).select(
        *out, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")
    )
    return rows.where(~wins).select(*out, nothing).union(drawn)
