"""SimHash near-duplicates by the generalised pigeonhole principle.

Bits that vary together form blocks. If two fingerprints differ in at most
``t`` bits and block ``i`` of ``m`` is given the threshold ``t_i`` with
``sum(t_i) = t - m + 1`` (-1: not searched), they differ in at most ``t_i`` bits
of some block. A dynamic program chooses the thresholds by the candidates and
probes expected, from counts over all fingerprints. Every fingerprint is entered
under its block values and those of up to ``t_i`` flipped bits; fingerprints
that meet are verified. A bucket beyond a bound is divided by the same
principle on its remaining bits, until no bucket is beyond it.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept_in_files, numbered
from millrace.llm.components import components

BITS = 64
SHINGLE = 3
SEED = 42
DISTANCE = 2
#: Blocks tried by the dynamic program, and the cost of an entry next to that
#: of comparing a pair inside a bucket.
BLOCK_NUMBERS = (2, 3, 4)
ENTRY_COST = 100.0
#: Fingerprints that one bucket may hold before it is divided.
BUCKET = 2048


def fingerprint_of(text: str | None) -> int:
    """Majority bits of the hashes of a text's shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        hashes = [digest(joined, SEED)]
    else:
        starts = [0, *ends[: -SHINGLE]]
        hashes = [
            digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])
        ]
    counts = np.zeros(BITS, np.int64)
    found = np.array(hashes, np.uint64)
    for part in np.split(found, range(65536, len(found), 65536)):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(majority.view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits as a signed long) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(
                [fingerprint_of(t) for t in batch.column(1).to_pylist()], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def bit_pairs(fps: DataFrame) -> np.ndarray:
    """How often two bits are set together, over all of ``fps(fp)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BITS * BITS), pa.int32()), pa.array(total.ravel())],
            names=["place", "n"],
        )

    rows = (
        fps.select("fp")
        .mapInArrow(run, "place int, n double")
        .groupBy("place")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    pairs = np.zeros(BITS * BITS)
    for row in rows:
        pairs[row["place"]] = row["n"]
    return pairs.reshape(BITS, BITS)


def correlated_blocks(pairs: np.ndarray, n: int, m: int) -> list[list[int]]:
    """The bits in ``m`` blocks, each filled with the bits closest to it."""
    share = np.diag(pairs) / max(1, n)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    close = np.abs((pairs / max(1, n) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(close, 0)
    left, blocks = list(range(BITS)), []
    for k in range(m):
        width = len(left) // (m - k)
        block = [max(left, key=lambda b: (close[b, left].max(), -b))]
        while len(block) < width:
            rest = [b for b in left if b not in block]
            block.append(max(rest, key=lambda b: (close[b, block].mean(), -b)))
        blocks.append(sorted(block))
        left = [b for b in left if b not in block]
    return blocks


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one from each dict, that add up to ``total`` at least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for so_far, (cost, chosen) in best.items():
            for t, more in options.items():
                found = (cost + more, [*chosen, t])
                if so_far + t not in new or found < new[so_far + t]:
                    new[so_far + t] = found
        best = new
    return best[total]


def _mask(bits: list[int]) -> int:
    """The bits as a signed long."""
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def plan(fps: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """Blocks with thresholds of the least expected cost."""
    n = fps.count()
    pairs = bit_pairs(fps)
    share = np.diag(pairs) / max(1, n)
    agree = np.clip(share**2 + (1 - share) ** 2, 1e-9, 1)
    tried = {m: correlated_blocks(pairs, n, m) for m in BLOCK_NUMBERS}
    flat = [(m, i, bits) for m, blocks in tried.items() for i, bits in enumerate(blocks)]
    entered = fps.select(
        F.posexplode(
            F.array(*[F.col("fp").bitwiseAND(F.lit(_mask(bits))) for _, _, bits in flat])
        ).alias("place", "key")
    )
    met = {
        row["place"]: row["met"]
        for row in entered.groupBy("place", "key")
        .agg(F.count("*").cast("double").alias("c"))
        .groupBy("place")
        .agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("met"))
        .collect()
    }
    best = None
    for m in BLOCK_NUMBERS:
        costs = []
        for place, (of, _, bits) in enumerate(flat):
            if of != m:
                continue
            odds = float(np.sum((1 - agree[bits]) / agree[bits]))
            options = {-1: 0.0}
            for t in range(distance + 1):
                entries = sum(math.comb(len(bits), d) for d in range(t + 1))
                pairs_met = met.get(place, 0.0) * sum(
                    odds**d / math.factorial(d) for d in range(2 * t + 1)
                )
                options[t] = ENTRY_COST * n * entries + pairs_met
            costs.append(options)
        cost, chosen = allocate(costs, distance - m + 1)
        if best is None or cost < best[0]:
            best = (cost, list(zip(tried[m], chosen)))
    return [(bits, t) for bits, t in best[1] if t >= 0]


def _entries(key: Column, paths: list[tuple[int, list[int], int]]) -> Column:
    """Places of a fingerprint: path number and value, with flipped bits."""
    places = []
    for path, bits, t in paths:
        for d in range(t + 1):
            for flipped in itertools.combinations(bits, d):
                value = F.col("fp").bitwiseXOR(F.lit(_mask(list(flipped))))
                value = value.bitwiseAND(F.lit(_mask(bits)))
                places.append(
                    F.struct(F.lit(path).alias("path"), key.bitwiseOR(value).alias("key"))
                )
    return F.explode(F.array(*places))


def _stars(values: list[int], distance: int) -> list[tuple[int, int]]:
    """Links that join the fingerprints of a bucket as their distances do."""
    if len(values) == 2:
        a, b = values
        return [(a, b)] if ((a ^ b) & (2**BITS - 1)).bit_count() <= distance else []
    found = np.array(values, np.int64).view(np.uint64)  # signed bits are counted by value
    parent = list(range(len(values)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for first in range(0, len(values), 256):
        part = found[first : first + 256]
        near = np.bitwise_count(part[:, None] ^ found[None, first:]) <= distance
        for i, j in np.argwhere(np.triu(near, 1)).tolist():
            a, b = top(first + i), top(first + j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(values[top(x)], values[x]) for x in range(len(values)) if top(x) != x]


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` between distinct ``fps(fp)`` whose components are those
    of all pairs at most ``distance`` bits apart."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [s for values in batch.column(0).to_pylist() for s in _stars(values, distance)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s[k] for s in out], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    blocks = plan(fps, distance)
    paths = {number: bits for number, (bits, _) in enumerate(blocks)}
    chosen = [(number, bits, t) for number, (bits, t) in enumerate(blocks)]
    entered = fps.select(_entries(F.lit(0).cast("long"), chosen).alias("e"), "fp").select(
        "e.path", "e.key", "fp"
    )
    found = None
    while True:
        entered = kept_in_files(entered, "simhash-entries")
        # Written, so that a bucket of very many fingerprints can be split.
        sizes = kept_in_files(
            entered.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1"),
            "simhash-bucket-sizes",
        )
        sized = kept_in_files(entered.join(sizes, ["path", "key"]), "simhash-buckets")
        stars = (
            sized.where(F.col("n") <= bucket)
            .groupBy("path", "key")
            .agg(F.collect_list("fp").alias("fps"))
            .select("fps")
            .mapInArrow(verify, "a long, b long")
        )
        found = stars if found is None else found.union(stars)
        large = sized.where(F.col("n") > bucket)
        full = [row["path"] for row in large.select("path").distinct().collect()]
        if not full:
            return found
        # Divide the full buckets by their remaining bits.
        parts, new = [], {}
        for path in sorted(full):
            left = [b for b in range(BITS) if b not in paths[path]]
            cuts = [[int(x) for x in part] for part in np.array_split(left, distance + 1)]
            below = []
            for cut in cuts:
                if cut:
                    number = len(paths) + len(new)
                    new[number] = sorted(paths[path] + cut)
                    below.append((number, cut, 0))
            parts.append(
                large.where(F.col("path") == path)
                .select(_entries(F.col("key"), below).alias("e"), "fp")
                .select("e.path", "e.key", "fp")
            )
        paths |= new
        entered = parts[0]
        for part in parts[1:]:
            entered = entered.union(part)


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, fp, fingerprint,
    component_id (the smallest id that links lead to) and n_links (other
    distinct fingerprints in its component).

    Null and empty texts have the fingerprint zero and link like any other.
    Repeated rows and equal texts share a fingerprint. Null ids are never the
    smallest; a component of null ids alone has a null component. Other columns
    are not read. An empty table gives no rows.
    """
    found = kept_in_files(fingerprints(docs), "fingerprints")
    distinct = kept_in_files(
        found.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints"
    )
    stars = components(links(distinct.select("fp"), distance, bucket), "simhash-links")
    rooted = kept_in_files(
        distinct.join(stars, distinct["fp"] == stars["node"], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "simhash-roots",
    )
    # Written, so that a component of very many fingerprints can be split.
    classes = kept_in_files(
        rooted.groupBy("root").agg(
            F.min("least").alias("component_id"), (F.count("*") - 1).alias("n_links")
        ),
        "simhash-components",
    )
    by_fp = rooted.select("fp", "root").join(classes, "root")
    return found.join(by_fp, "fp").select(
        "doc_id",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "n_links",
    )


def keep_one_of_each(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest
    ``doc_id`` (null first, then the first row), and all their columns."""
    base = numbered(docs, "near-duplicate-rows", F.struct("*").alias("doc"))
    own = F.struct("doc.doc_id", "row_no").alias("doc_id")
    found = near_duplicates(base.select(own, F.col("doc.text").alias("text")), distance)
    first = found.where(F.col("doc_id.row_no") == F.col("component_id.row_no"))
    return base.join(
        first.select(F.col("doc_id.row_no").alias("row_no")), "row_no", "left_semi"
    ).select("doc.*")
