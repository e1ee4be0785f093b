"""Benchmark decontamination by Wu-Manber search for many strings.

Texts and benchmark items become words of letters, digits and characters
outside ASCII, in lower case and joined by single spaces, with a space at both
ends. A window of the benchmark is a string of such words between spaces, so
that a plain occurrence of the string is an occurrence of the words.

Strings are searched in classes by length, each with its own tables. In a
class, ``m`` is the length of the shortest string and only the first ``m``
bytes of each matter to the tables:

* the shift table says for a block of bytes how far the search may move when
  the text has this block at the end of its ``m`` bytes: never past a place
  where some string could end;
* where the shift is zero, the block may be the end of some ``m`` bytes, and its
  bucket holds these strings in the order of their first bytes;
* strings found there are compared with the text.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, numbered
from millrace.session import work_path

WINDOW = 13

#: Bytes of benchmark text searched for in one pass; a larger benchmark takes more
#: passes over the documents. The tables of a pass are built on the driver. They
#: have no more than the text for each class of lengths, 50 bytes for each window
#: (a window begins at every word) and 20 MB for each class.
PASS_BYTES = 4_000_000

#: Bytes of a block for strings of at least so many bytes.
BLOCKS = ((40, 8), (16, 5), (6, 3), (3, 2))

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def normal_form(text: str | None) -> bytes:
    """Lower-case words of ``text`` with a space between and at both ends."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """All windows of ``size`` words, or the whole of a shorter item."""
    words = normal_form(text).split()
    return [
        b" " + b" ".join(words[i : i + size]) + b" "
        for i in range(max(1, len(words) - size + 1) if words else 0)
    ]


#: Most bits of the index of the shift table (a byte for each entry) and of the
#: buckets (a number for each). Smaller benchmarks have smaller tables.
SHIFT_BITS, BUCKET_BITS = 24, 20
_ODD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


class Search:
    """Tables for one class of strings of similar length.

    Strings are places in one buffer. The shift table is indexed by a hash of a
    block; blocks with one hash share the smaller shift, so nothing is passed by.
    """

    def __init__(self, text: bytes, starts: np.ndarray, ends: np.ndarray, numbers: np.ndarray):
        self.text, lengths = text, ends - starts
        self.m = m = int(lengths.min())
        self.block = block = next(b for least, b in BLOCKS if m >= least)
        self.free = min(m - block + 1, 255)
        # A quarter of the entries at most is in use, unless the limit is reached.
        bits = min(SHIFT_BITS, max(10, (4 * len(text)).bit_length()))
        self.down, self.narrow = 64 - bits, bits - min(bits, BUCKET_BITS)
        data = np.frombuffer(text, np.uint8).astype(np.uint64)
        keys = np.zeros(len(data) - block + 1, np.uint64)
        for k in range(block):
            keys |= data[k : k + len(keys)] << np.uint64(8 * k)
        hashes = ((keys * np.uint64(_ODD)) >> np.uint64(self.down)).astype(np.int64)
        shift = np.full(1 << bits, self.free, np.uint8)
        for far in range(m - block, -1, -1):
            at = hashes[starts + m - block - far]
            shift[at] = np.minimum(shift[at], min(far, 255))
        last, prefix = hashes[starts + m - block] >> self.narrow, keys[starts]
        order = np.lexsort((prefix, last))
        self.shift = shift.tobytes()
        buckets = np.arange((1 << bits - self.narrow) + 1)
        self.first = array("I", np.searchsorted(last[order], buckets).astype(np.uint32).tobytes())
        self.prefix = array("Q", prefix[order].tobytes())
        self.starts = array("q", starts[order].astype(np.int64).tobytes())
        self.ends = array("q", ends[order].astype(np.int64).tobytes())
        self.numbers = array("q", numbers[order].astype(np.int64).tobytes())

    def occurrences(self, text: bytes) -> Iterator[tuple[int, int]]:
        """Start and number of the string of every occurrence."""
        end, n, block, m = self.m, len(text), self.block, self.m
        shift, first, strings = self.shift, self.first, self.text
        down, narrow = self.down, self.narrow
        while end <= n:
            at = (int.from_bytes(text[end - block : end], "little") * _ODD & _MASK) >> down
            move = shift[at]
            if move:
                end += move
                continue
            start = end - m
            own = int.from_bytes(text[start : start + block], "little")
            bucket = at >> narrow
            stop = first[bucket + 1]
            k = bisect_left(self.prefix, own, first[bucket], stop)
            while k < stop and self.prefix[k] == own:
                if text.startswith(strings[self.starts[k] : self.ends[k]], start):
                    yield start, self.numbers[k]
                k += 1
            end += 1


class Benchmark:
    """The windows of some items, ready for search: a buffer with the words of the
    items, and for each different window its place there and its items."""

    def __init__(self, items: list[tuple[object, str | None]], size: int):
        self.names = ["" if item is None else str(item) for item, _ in items]
        buffer, at = bytearray(), 0
        known: dict[bytes, int] = {}
        starts, ends, words, owners = [], [], [], []
        for item, (_, text) in enumerate(items):
            plain = normal_form(text)
            spaces = [i for i, c in enumerate(plain) if c == 32]
            count = min(size, len(spaces) - 1)
            for i in range(max(0, len(spaces) - count) if count > 0 else 0):
                first, end = spaces[i], spaces[i + count] + 1
                number = known.setdefault(plain[first:end], len(starts))
                if number == len(starts):
                    starts.append(at + first)
                    ends.append(at + end)
                    words.append(count)
                owners.append((number, item))
            buffer += plain
            at += len(plain)
        del known
        self.words = array("q", words)
        pairs = np.array(sorted(set(owners)), np.int64).reshape(-1, 2)
        self.first = array("q", np.searchsorted(pairs[:, 0], np.arange(len(starts) + 1)).tobytes())
        self.items = array("q", pairs[:, 1].tobytes())
        begin, stop = np.array(starts, np.int64), np.array(ends, np.int64)
        # Lengths of a class differ by a factor of two.
        kinds = np.frompyfunc(int.bit_length, 1, 1)((stop - begin).astype(object)) if len(begin) else begin
        whole = bytes(buffer)
        self.searches = [
            Search(whole, begin[kinds == kind], stop[kinds == kind], np.flatnonzero(kinds == kind))
            for kind in sorted(set(kinds))
        ]

    def hits(self, text: bytes) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words inside occurrences, and the items that occur."""
        places: list[tuple[int, int]] = []
        strings: set[int] = set()
        for search in self.searches:
            for start, number in search.occurrences(text):
                places.append((start, self.words[number]))
                strings.add(number)
        if not places:
            return [], set()
        found = {
            self.names[item] for s in strings for item in self.items[self.first[s] : self.first[s + 1]]
        }
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        firsts = np.searchsorted(spaces, [start for start, _ in places])
        ranges = sorted(
            (int(first), int(first) + count) for first, (_, count) in zip(firsts, places)
        )
        return ranges, found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlaps."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def benchmark_passes(
    items: DataFrame, pass_bytes: int
) -> Iterator[list[tuple[object, str | None]]]:
    """The items in parts of at most ``pass_bytes`` of text, or a single item.

    Sizes are summed by Spark before a part comes to the driver, and parts come
    one at a time.
    """
    sized = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    parts = 1
    while True:
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("part")
        fullest = (
            sized.groupBy(part)
            .agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n"))
            .where("n > 1")
            .agg(F.max("size"))
            .first()[0]
        )
        if fullest is None or fullest <= pass_bytes:
            break
        parts *= 2
    for number in range(parts):
        yield [tuple(row) for row in sized.where(part == number).collect()]


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    size: int = WINDOW,
    share: int = 20,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with what it holds of ``items``.

    A word is hit if it lies in an occurrence of a window. A document is
    contaminated if words are hit and ``share`` times their number is at least
    the number of all words. Columns: doc_id, n_words, n_hit, n_items, items,
    items_sha256, spans (ranges of words), contaminated.

    Null and empty texts have no words. Items without words have no windows; a
    null item id counts as the empty string; repeated items count once. Other
    columns are not read. An empty benchmark leaves all documents clean.
    """
    marked = mark(
        docs.select("doc_id", "text"), items, size=size, share=share, pass_bytes=pass_bytes
    )
    return marked.drop("text")


_SPAN = "array<struct<first: int, end: int>>"
_SPAN_ARROW = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
_HITS = f"struct<n_words: long, spans: {_SPAN}, items: array<string>>"


def mark(
    docs: DataFrame,
    items: DataFrame,
    *,
    size: int = WINDOW,
    share: int = 20,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``docs`` and the columns of :func:`find_contamination`."""
    row, place = fresh("row"), fresh("hits")
    rows = docs.select(F.struct("*").alias(row))
    text = F.col(f"{row}.text")
    parts = benchmark_passes(items, pass_bytes)
    first, second = next(parts), next(parts, None)
    if second is None:
        shared = docs.sparkSession.sparkContext.broadcast(Benchmark(first, size))

        @F.pandas_udf(_HITS)
        def search(texts):
            found = [_hits(plain, *shared.value.hits(plain)) for plain in map(normal_form, texts)]
            return pd.DataFrame(found, columns=["n_words", "spans", "items"])

        current = rows.select(row, search(text).alias(place))
    else:
        rows = numbered(rows, "documents", row)
        found = search_in_passes(rows.select("row_no", text), chain((first, second), parts), size)

        @F.pandas_udf(_HITS)
        def unite(texts, spans, names):
            found = [
                _hits(
                    normal_form(text),
                    [] if own is None else [(s["first"], s["end"]) for s in own],
                    () if items is None else items,
                )
                for text, own, items in zip(texts, spans, names)
            ]
            return pd.DataFrame(found, columns=["n_words", "spans", "items"])

        current = rows.join(found, "row_no", "left").select(
            row, unite(text, "spans", "items").alias(place)
        )
    n_hit = F.aggregate(
        f"{place}.spans",
        F.lit(0).cast("long"),
        lambda total, s: total + s["end"] - s["first"],
    )
    n_words = F.col(f"{place}.n_words")
    return current.select(
        f"{row}.*",
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(f"{place}.items").cast("long").alias("n_items"),
        F.col(f"{place}.items").alias("items"),
        F.sha2(F.array_join(f"{place}.items", ","), 256).alias("items_sha256"),
        F.col(f"{place}.spans").alias("spans"),
        ((n_hit > 0) & (share * n_hit >= n_words)).alias("contaminated"),
    )


def search_in_passes(
    texts: DataFrame, parts: Iterable[list[tuple[object, str | None]]], size: int
) -> DataFrame:
    """``(row_no, spans, items)`` of the rows of ``texts(row_no, text)`` in which
    something of one of ``parts`` occurs.

    Each pass is a job of its own that writes what it finds, so neither the plan
    nor the tables in a worker grow with the number of passes.
    """
    spark = texts.sparkSession
    path = work_path(spark, "benchmark-hits")
    schema = f"row_no long, spans {_SPAN}, items array<string>"
    for part in parts:
        if not part:
            continue
        shared = spark.sparkContext.broadcast(Benchmark(part, size))

        def search(batches, shared=shared):
            bench = shared.value
            for batch in batches:
                found = []
                for number, text in zip(*(batch.column(k).to_pylist() for k in range(2))):
                    ranges, names = bench.hits(normal_form(text))
                    if names:
                        spans = [{"first": a, "end": b} for a, b in merged(ranges)]
                        found.append((number, spans, sorted(names)))
                kinds = (pa.int64(), _SPAN_ARROW, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)],
                    names=["row_no", "spans", "items"],
                )

        texts.mapInArrow(search, schema).write.mode("append").parquet(path)
        shared.destroy()
    return (
        spark.read.schema(schema)
        .parquet(path)
        .groupBy("row_no")
        .agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
    )


def _hits(
    plain: bytes, ranges: list[tuple[int, int]], names: Iterable[str]
) -> tuple[int, list[dict], list[str]]:
    """Words of a text, and what occurs in it."""
    pairs = [{"first": first, "end": end} for first, end in merged(ranges)]
    return max(0, plain.count(b" ") - 1), pairs, sorted(set(names))


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated documents, with the columns of ``docs``."""
    row = docs.select(F.struct("*").alias("doc"), F.col("text"))
    kept = mark(row, items, **options).where(~F.col("contaminated"))
    return kept.select("doc.*")
