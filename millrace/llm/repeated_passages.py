"""Suffix-array dedup of passages by two-stage suffix sorting.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
else. Three steps find those strings:

1. *Anchors.* In every window of ``length`` bytes the smallest hash of a short
   string inside is its anchor. Equal windows have equal anchors at equal places,
   so a window whose anchor hash occurs once is unique. Only short rows of
   anchors are counted and joined, not text.
2. *Buckets.* Windows with one anchor that is repeated lie next to each other in
   a text; this piece of text goes to the bucket of the anchor. Buckets with
   very many pieces are divided by the place of the window and the bytes that
   all windows of a part have in common. Equal pieces are counted before the
   shuffle.
3. *Suffix arrays.* The windows of the pieces of a task are sorted in two
   stages: only suffixes smaller than their successor are compared directly,
   the others are put into place by one scan of the buckets of first bytes. A
   window is repeated if its common prefix with a neighbour in this order has
   ``length`` bytes.

A part that is still large after the division holds windows that differ in a
few bytes at the ends; its windows go to buckets of one string each. Such a
string is told by a cryptographic digest, so that equal digests are equal bytes.

Exact copies of whole texts are one text with a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept_in_files

LENGTH = 400
#: Bytes of the strings that anchors are hashes of.
GRAM = 48
#: Occurrences of an anchor from which its bucket is divided, the windows of a
#: part, and the different pieces from which a part is divided by windows.
LARGE = 1000
PART = 8
PIECES = 1000
#: Windows that one suffix array holds, unless one bucket has more.
BLOCK = 300_000
#: Bytes of a text that are hashed at once.
CHUNK = 1 << 22

_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: list[np.ndarray] = []


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed hash of every string of ``GRAM`` bytes."""
    n = len(data)
    if not _TABLES or len(_TABLES[0]) < n:
        size = max(n, 1 << 16)
        _TABLES[:] = [_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _TABLES[0][:n], out=sums[1:])
    found = (sums[GRAM:] - sums[:-GRAM]) * _TABLES[1][: n - GRAM + 1]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    return found


def anchors(text: bytes, length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """Runs of windows with one anchor: hash, first start, number of starts, place."""
    out: list[tuple[int, int, int, int]] = []
    for first in range(0, max(1, len(text) - length + 1), CHUNK):
        data = np.frombuffer(text[first : first + CHUNK + length - 1], np.uint8)
        if len(data) < length:
            break
        hashes = gram_hashes(data)
        wide = length - GRAM + 1
        starts = len(data) - length + 1
        # The upper bits order the hashes, the lower ones are the place.
        order = (hashes & ~np.uint64(0x7FFFFF)) | np.arange(len(hashes), dtype=np.uint64)
        rows = -(-len(order) // wide)
        square = np.full(rows * wide, np.iinfo(np.uint64).max, np.uint64)
        square[: len(order)] = order
        square = square.reshape(rows, wide)
        before = np.minimum.accumulate(square, axis=1).ravel()
        after = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(after[:starts], before[wide - 1 : wide - 1 + starts])
        changes = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        places = (least[changes] & np.uint64(0x7FFFFF)).astype(np.int64)
        counts = np.diff(np.append(changes, starts))
        signed = hashes[places].view(np.int64)
        out += zip(
            signed.tolist(),
            (changes + first).tolist(),
            counts.tolist(),
            (places + first).tolist(),
        )
    return out


def two_stage_order(text: bytes, runs: list[tuple[int, int]], depth: int) -> list[int]:
    """Starts of ``runs`` (first, end) in the order of their ``depth`` bytes.

    Every start has ``depth`` bytes in its own piece of ``text``. A suffix whose
    first different bytes rise is smaller than its successor, and sorted
    directly; the last starts of a run draw in those after them up to such a
    one. Where bytes do not rise over a whole window, the kind of a suffix
    would rest on bytes behind it; then all are sorted directly.
    """
    induced = bytearray(len(text) + 1)
    wanted = bytearray(len(text) + 1)
    direct: list[list[int]] = [[] for _ in range(256)]
    for first, end in runs:
        last, stop = end - 1, end - 2 + depth
        while last < stop and text[last] >= text[last + 1]:
            last += 1
        if last == stop:
            return _direct_order(text, runs, depth)
        # The bytes fall or stay up to ``last`` and rise there.
        falling, smaller = 1, False
        direct[text[last]].append(last)
        for s in range(last - 1, first - 1, -1):
            here, after = text[s], text[s + 1]
            if here != after:
                smaller = here > after
            falling = falling + 1 if here >= after else 1
            if falling >= depth - 1:
                return _direct_order(text, runs, depth)
            if smaller:
                induced[s] = 1
            else:
                direct[here].append(s)
        wanted[first:end] = b"\x01" * (end - first)
    order: list[int] = []
    placed: list[list[int]] = [[] for _ in range(256)]
    for byte in range(256):
        # Smaller successors come first in a bucket, which grows as it is read.
        direct[byte].sort(key=lambda s: text[s : s + depth])
        for group in (placed[byte], direct[byte]):
            for s in group:
                if wanted[s]:
                    order.append(s)
                if s and induced[s - 1]:
                    placed[text[s - 1]].append(s - 1)
    return order


def _direct_order(text: bytes, runs: list[tuple[int, int]], depth: int) -> list[int]:
    starts = [s for first, end in runs for s in range(first, end)]
    return sorted(starts, key=lambda s: text[s : s + depth])


def repeated_starts(pieces: list[tuple[bytes, int]], depth: int) -> list[list[int]]:
    """For each (piece, times): the windows that occur elsewhere in the pieces."""
    text = b"".join(piece for piece, _ in pieces)
    at, runs = 0, []
    for piece, _ in pieces:
        runs.append((at, at + len(piece) - depth + 1))
        at += len(piece)
    order = two_stage_order(text, runs, depth)
    twice = bytearray(len(text))
    before = None
    for a, b in zip(order, order[1:]):
        own = text[a : a + depth] if before is None else before
        before = text[b : b + depth]
        if own == before:
            twice[a] = twice[b] = 1
    return [
        list(range(end - first))
        if times > 1
        else [s - first for s in range(first, end) if twice[s]]
        for (first, end), (_, times) in zip(runs, pieces)
    ]


def spans(starts: list[int]) -> list[tuple[int, int]]:
    """Rising starts as ranges (first, end)."""
    out: list[list[int]] = []
    for s in starts:
        if out and out[-1][1] == s:
            out[-1][1] = s + 1
        else:
            out.append([s, s + 1])
    return [(a, b) for a, b in out]


def _key(*parts: object) -> int:
    digest = xxhash.xxh64(seed=7)
    for part in parts:
        digest.update(part if isinstance(part, bytes) else b"%d." % part)
    return digest.intdigest() - (1 << 63)


def cut_pieces(text: bytes, found: list[dict], length: int, large: int) -> Iterator[tuple]:
    """Pieces (key, first start, number of starts, bytes) of repeated anchors."""
    for row in found:
        h, first, n, place = row["h"], row["first"], row["n"], row["place"]
        if row["times"] <= large:
            yield h, first, n, text[first : first + n - 1 + length]
            continue
        end = first + n
        while first < end:
            part = (place - first) // PART
            stop = min(end, place - part * PART + 1)
            common = text[place - part * PART : place - part * PART - PART + 1 + length]
            yield (
                _key(h, part, common),
                first,
                stop - first,
                text[first : stop - 1 + length],
            )
            first = stop


_SPAN = "array<struct<first: int, end: int>>"
_SPAN_ARROW = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def _span_column(found: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"first": a, "end": b} for a, b in x] for x in found], _SPAN_ARROW)


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """``(t1, t2, spans)``: the byte ranges to remove from the texts of
    ``texts(t1, t2, text)``, rows of equal keys being equal texts."""

    def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                found = anchors(text.encode("utf-8", "surrogatepass"), length)
                rows += found
                keys += [row] * len(found)
            taken = pa.array(keys, pa.int64())
            h, first, n, place = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken),
                    batch.column(1).take(taken),
                    pa.array(h, pa.int64()),
                    *[pa.array(x, pa.int32()) for x in (first, n, place)],
                ],
                names=["t1", "t2", "h", "first", "n", "place"],
            )

    long = texts.where(F.octet_length("text") >= length)
    found = kept_in_files(
        long.mapInArrow(find_anchors, "t1 long, t2 long, h long, first int, n int, place int"),
        "anchors",
    )
    # Copies of a text give equal rows: they are no repetition of the anchor.
    identity = F.xxhash64("t1", "t2", "place")
    repeated = (
        found.groupBy("h")
        .agg(F.count("*").alias("times"), F.min(identity).alias("a"), F.max(identity).alias("b"))
        .where("a <> b")
        .select("h", "times")
    )
    # Written, so that both sides of the join are shuffled for it and an anchor
    # of very many copies can be split.
    repeated = kept_in_files(repeated, "repeated-anchors")
    placed = (
        found.join(repeated, "h")
        .groupBy("t1", "t2")
        .agg(F.collect_set(F.struct("first", "n", "place", "h", "times")).alias("found"))
    )
    whole = long.groupBy("t1", "t2").agg(F.first("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py().encode("utf-8", "surrogatepass")
                for piece in cut_pieces(text, batch.column(3)[row].as_py(), length, LARGE):
                    keys.append(row)
                    rows.append(piece)
                if len(rows) > 20_000 or row == batch.num_rows - 1:
                    taken = pa.array(keys, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(taken),
                            batch.column(1).take(taken),
                            pa.array([r[0] for r in rows], pa.int64()),
                            pa.array([_key(r[3]) for r in rows], pa.int64()),
                            pa.array([r[1] for r in rows], pa.int32()),
                            pa.array([r[2] for r in rows], pa.int32()),
                            pa.array([r[3] for r in rows], pa.binary()),
                        ],
                        names=["t1", "t2", "key", "same", "first", "n", "piece"],
                    )
                    keys, rows = [], []

    members = kept_in_files(
        whole.join(placed, ["t1", "t2"]).mapInArrow(
            cut, "t1 long, t2 long, key long, same long, first int, n int, piece binary"
        ),
        "passage-pieces",
    )
    pieces = members.groupBy("key", "same").agg(
        F.first("piece").alias("piece"), F.count("*").alias("times")
    )
    pieces = kept_in_files(pieces, "different-pieces")
    sizes = (
        pieces.groupBy("key")
        .agg(F.count("*").alias("different"), F.sum("times").alias("all"))
        .where("all > 1")
        .select("key", "different")
    )
    # Written, so that a bucket of very many pieces can be split.
    sized = pieces.join(kept_in_files(sizes, "bucket-sizes"), "key")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[int, int, bytes, int]] = []
        windows = 0

        def done() -> pa.RecordBatch:
            starts = repeated_starts([(piece, times) for _, _, piece, times in block], length)
            out = [(b[0], b[1], spans(s)) for b, s in zip(block, starts) if s]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], pa.int64()),
                    _span_column([o[2] for o in out]),
                ],
                names=["key", "same", "starts"],
            )

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                # Only between buckets may a block end.
                if windows >= BLOCK and row[0] != block[-1][0]:
                    yield done()
                    block, windows = [], 0
                block.append(row)
                windows += len(row[2]) - length + 1
        if block:
            yield done()

    small = (
        sized.where(F.col("different") <= PIECES)
        .select("key", "same", "piece", "times")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(sort, f"key long, same long, starts {_SPAN}")
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, same, piece, times in zip(*(batch.column(k).to_pylist() for k in range(4))):
                for s in range(len(piece) - length + 1):
                    digest = hashlib.blake2b(piece[s : s + length], digest_size=20).digest()
                    out.append((key, same, times, s, digest))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)],
                names=["key", "same", "times", "s", "window"],
            )

    single = (
        sized.where(F.col("different") > PIECES)
        .select("key", "same", "piece", "times")
        .mapInArrow(split, "key long, same long, times long, s int, window binary")
    )
    twice = single.groupBy("window").agg(F.sum("times").alias("all")).where("all > 1")
    large = (
        single.join(kept_in_files(twice.select("window"), "repeated-strings"), "window")
        .groupBy("key", "same")
        .agg(F.sort_array(F.collect_set(F.struct(F.col("s").alias("first"), (F.col("s") + 1).alias("end")))).alias("starts"))
    )
    starts = kept_in_files(small.union(large), "repeated-windows")
    shifted = F.transform(
        "starts",
        lambda x: F.struct(
            (x["first"] + F.col("first")).alias("first"),
            (x["end"] + F.col("first") + length - 1).alias("end"),
        ),
    )
    return (
        members.select("key", "same", "t1", "t2", "first")
        .join(starts, ["key", "same"])
        .select("t1", "t2", F.explode(shifted).alias("span"))
        .groupBy("t1", "t2")
        .agg(F.sort_array(F.collect_set("span")).alias("spans"))
    )


def remove_repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed,
    n_spans, spans (maximal ranges of removed bytes), kept_sha256.

    Texts are UTF-8 bytes, a null text none. Strings are looked for in the given
    texts, not in what is left, so all copies go, the first too. Repeated rows
    and equal texts lose all their bytes if they have ``length`` or more. Other
    columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        "doc_id",
        F.xxhash64(text).alias("t1"),
        # The constant comes first: a hash is the seed of the next column's.
        F.xxhash64(F.lit(1), text).alias("t2"),
        text.alias("text"),
    )
    found = repeated_spans(keyed.select("t1", "t2", "text"), length)
    whole = keyed.groupBy("t1", "t2").agg(
        F.first("text").alias("text"), F.count("*").alias("times")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, times, ranges in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                data = text.encode("utf-8", "surrogatepass")
                if times > 1 and len(data) >= length:
                    gone = [(0, len(data))]
                else:
                    gone = _merged([(r["first"], r["end"]) for r in ranges or ()])
                digest, at = hashlib.sha256(), 0
                for first, end in [*gone, (len(data), len(data))]:
                    digest.update(data[at:first])
                    at = end
                out.append((len(data), sum(b - a for a, b in gone), len(gone), gone, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *[pa.array([o[k] for o in out], pa.int64()) for k in range(3)],
                    _span_column([o[3] for o in out]),
                    pa.array([o[4] for o in out], pa.string()),
                ],
                names=["t1", "t2", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"],
            )

    per_text = kept_in_files(
        whole.join(found, ["t1", "t2"], "left").mapInArrow(
            finish,
            f"t1 long, t2 long, n_bytes long, n_removed long, n_spans long, spans {_SPAN}, kept_sha256 string",
        ),
        "text-spans",
    )
    return keyed.select("doc_id", "t1", "t2").join(per_text, ["t1", "t2"]).drop("t1", "t2")


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out
