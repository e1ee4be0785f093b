"""Approximate nearest neighbours by learned partitions.

The index is a tree. At each node a bounded sample of the node's vectors gives

1. a graph of nearest neighbours (largest inner products),
2. a balanced partition of that graph with few cut edges,
3. two small softmax models. *Place* repeats the partition for vectors outside
   the sample; *route* gives, for a query, the shares of its neighbours that lie
   in each part.

Every vector is placed in one leaf. A query goes to its most probable leaves
until their probabilities sum up to ``mass``, and is compared with every vector
there, in blocks of bounded size, in double precision. So the number of probes
follows the data: few where neighbours lie together, many where vectors have no
structure.

Equal vectors are one entry of the index with its smallest ids: no more than
``k + 1`` of them can be among the ``k`` nearest of anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh, kept_in_files

#: Parts of a node, and rows of a leaf from which it becomes a node.
PARTS = 16
LEAF = 4096
#: The tree has at most so many levels, so all models together have no more than
#: 2 * PARTS ** LEVELS rows of floats. Larger leaves are searched in blocks.
LEVELS = 3
#: Vectors of a node that its models are fitted on, and neighbours in the graph.
SAMPLE = 4096
DEGREE = 20
#: Probability that the probed leaves of a query have together, at least.
MASS = 0.94
#: Distinct vectors of a leaf, and queries, that are compared at once.
BLOCK = 4096
QUERIES = 1024


# ---------------------------------------------------------------- fit


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The ``degree`` rows with the largest inner product for each row, itself
    left out."""
    n = len(x)
    degree = min(degree, n - 1)
    out = np.empty((n, degree), np.int32)
    for first in range(0, n, 1024):
        near = x[first : first + 1024] @ x.T
        near[np.arange(len(near)), np.arange(first, first + len(near))] = -np.inf
        out[first : first + 1024] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    return out


def fill(gains: np.ndarray, room: int) -> np.ndarray:
    """Part of each row by falling gain, no part with more than ``room`` rows."""
    n, parts = gains.shape
    place = np.full(n, -1)
    left = np.full(parts, room)
    open_ = np.ones(parts, bool)
    while (rest := np.flatnonzero(place < 0)).size:
        own = np.where(open_, gains[rest], -np.inf)
        best = own.argmax(axis=1)
        top = own[np.arange(len(rest)), best]
        own[np.arange(len(rest)), best] = -np.inf
        second = own.max(axis=1)
        urgent = np.argsort(-(top - np.where(np.isfinite(second), second, top)), kind="stable")
        for part in np.flatnonzero(open_):
            taken = urgent[best[urgent] == part][: left[part]]
            place[rest[taken]] = part
            left[part] -= len(taken)
        open_ = left > 0
    return place


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 15) -> np.ndarray:
    """Parts of nearly equal size with few edges of ``graph`` between them.

    Starts from the nearest of ``parts`` centres under a limit of rows a part,
    then moves rows to the part that holds most of their neighbours, both ways
    along the edges, under the same limit. The best cut seen is returned.
    """
    n = len(x)
    room = -(-n // parts)
    draw = np.random.default_rng(1)
    centres = x[draw.choice(n, parts, replace=False)]
    for _ in range(8):
        place = fill(x @ centres.T - 0.5 * (centres**2).sum(axis=1), room)
        centres = np.stack([x[place == p].mean(axis=0) for p in range(parts)])
    source = np.repeat(np.arange(n), graph.shape[1])
    target = graph.ravel()
    best, best_kept = place, -1
    for _ in range(rounds):
        kept = int((place[source] == place[target]).sum())
        if kept > best_kept:
            best, best_kept = place, kept
        share = np.bincount(source * parts + place[target], minlength=n * parts).astype(float)
        share += np.bincount(target * parts + place[source], minlength=n * parts)
        gains = share.reshape(n, parts)
        gains[np.arange(n), place] += 0.5
        new = fill(gains, room)
        # Half of the rows move at a time, or pairs would swap for ever.
        moved = np.where(draw.random(n) < 0.5, new, place)
        if np.bincount(moved, minlength=parts).max() > room * 1.1:
            moved = new
        if (moved == place).all():
            break
        place = moved
    return best


def softmax(logits: np.ndarray) -> np.ndarray:
    out = np.exp(logits - logits.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, target: np.ndarray, rounds: int = 300, ridge: float = 1e-5) -> np.ndarray:
    """Weights (features + 1, parts) of a softmax model of the rows of ``target``,
    by accelerated gradient steps of a safe length."""
    n, d = x.shape
    wide = np.hstack([x, np.ones((n, 1))])
    step = 1.0 / (0.5 * np.linalg.eigvalsh(wide.T @ wide / n)[-1] + ridge)
    w = np.zeros((d + 1, target.shape[1]))
    ahead, pace = w, 1.0
    for _ in range(rounds):
        slope = wide.T @ (softmax(wide @ ahead) - target) / n + ridge * ahead
        new = ahead - step * slope
        pace, before = (1 + (1 + 4 * pace * pace) ** 0.5) / 2, pace
        ahead = new + (before - 1) / pace * (new - w)
        w = new
    return w


def fit_node(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The two models of a node, (place, route), from a sample of its vectors."""
    scale = np.sqrt((x * x).sum(axis=1).mean())
    unit = x / scale
    graph = neighbour_graph(unit, DEGREE)
    parted = balanced_partition(unit, graph, parts)
    place = fit_softmax(unit, np.eye(parts)[parted])
    wide = np.hstack([unit, np.ones((len(x), 1))])
    real = (wide @ place).argmax(axis=1)
    shares = np.zeros((len(x), parts))
    for column in graph.T:
        shares[np.arange(len(x)), real[column]] += 1
    route = fit_softmax(unit, shares / graph.shape[1])
    for model in (place, route):
        model[:-1] /= scale
    return place, route


# ---------------------------------------------------------------- tree

#: A tree: models (place, route) by the number of the node. The root is 1, the
#: children of ``node`` are ``node * PARTS + part``.
Tree = dict[int, tuple[np.ndarray, np.ndarray]]


def leaves_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    wide = np.hstack([x, np.ones((len(x), 1))])
    nodes = np.ones(len(x), np.int64)
    for _ in range(LEVELS):
        for node in np.unique(nodes):
            if node in tree:
                rows = np.flatnonzero(nodes == node)
                nodes[rows] = node * PARTS + (wide[rows] @ tree[node][0]).argmax(axis=1)
    return nodes


def routes_of(tree: Tree, x: np.ndarray, mass: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for the most probable leaves of each row, until they have
    ``mass`` of its probability."""
    wide = np.hstack([x, np.ones((len(x), 1))])
    rows, nodes, chance = np.arange(len(x)), np.ones(len(x), np.int64), np.ones(len(x))
    for level in range(LEVELS):
        parts = [(rows[:0], nodes[:0], chance[:0])]
        for node in np.unique(nodes):
            at = nodes == node
            if node not in tree:
                parts.append((rows[at], nodes[at], chance[at]))
                continue
            shares = softmax(wide[rows[at]] @ tree[node][1]) * chance[at][:, None]
            n = shares.shape[1]
            parts.append(
                (
                    np.repeat(rows[at], n),
                    np.tile(node * PARTS + np.arange(n), int(at.sum())),
                    shares.ravel(),
                )
            )
        rows, nodes, chance = (np.concatenate(p) for p in zip(*parts))
        # The loss of mass is dealt out evenly over the levels.
        order = np.lexsort((-chance, rows))
        rows, nodes, chance = rows[order], nodes[order], chance[order]
        total = np.cumsum(chance)
        starts = np.searchsorted(rows, rows)
        before = total - chance - (total[starts] - chance[starts])
        keep = before < 1 - (1 - mass) * (level + 1) / LEVELS if len(tree) > 1 else before < mass
        rows, nodes, chance = rows[keep], nodes[keep], chance[keep]
    return rows, nodes


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column without nulls, as doubles."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def _grow(entries: DataFrame, tree: Tree, dim: int) -> DataFrame:
    """``entries`` with the leaf of each vector, kept in files."""
    schema = entries.withColumn("leaf", F.lit(0).cast("long")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(batch.schema.get_field_index("v")), dim)
            yield batch.append_column("leaf", pa.array(leaves_of(tree, x), pa.int64()))

    return kept_in_files(entries.mapInArrow(place, schema), "placed-vectors")


def plant(entries: DataFrame, dim: int) -> tuple[Tree, DataFrame]:
    """The tree over the distinct vectors ``entries(v, ids)`` and the same rows
    with their ``leaf``."""
    tree: Tree = {}
    placed = entries.withColumn("leaf", F.lit(1).cast("long"))
    for level in range(LEVELS):
        # No more rows than nodes of this level.
        counts = {r.leaf: r.n for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
        if level == 0:
            parts = {1: min(PARTS, counts.get(1, 0) // 32)}
        else:
            parts = {leaf: PARTS for leaf, n in counts.items() if n > LEAF}
        parts = {leaf: n for leaf, n in parts.items() if n > 1}
        if not parts:
            break
        draw = F.pmod(F.xxhash64(F.lit(level), "v"), F.lit(1 << 30))
        drawn = placed.select("leaf", "v", draw.alias("draw"))
        shares = [(leaf, n, min(1.0, 1.3 * SAMPLE / counts[leaf])) for leaf, n in parts.items()]
        if level == 0:
            drawn = drawn.select("*", *(F.lit(x).alias(c) for c, x in zip(("parts", "share"), shares[0][1:])))
        else:
            wanted = placed.sparkSession.createDataFrame(shares, "leaf long, parts int, share double")
            drawn = drawn.join(F.broadcast(wanted), "leaf")
        drawn = drawn.where(F.col("draw") < F.col("share") * (1 << 30)).select("leaf", "parts", "draw", "v")

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("draw").head(SAMPLE)
            n = int(rows["parts"].iloc[0])
            place, route = fit_node(np.stack(rows["v"].to_numpy()).astype(float), n)
            return pd.DataFrame(
                {"leaf": [rows["leaf"].iloc[0]], "place": [place.tobytes()], "route": [route.tobytes()]}
            )

        models = drawn.groupBy("leaf").applyInPandas(fit, "leaf long, place binary, route binary")
        for row in models.collect():
            tree[row.leaf] = tuple(
                np.frombuffer(model, float).reshape(dim + 1, -1) for model in (row.place, row.route)
            )
        placed = _grow(entries, tree, dim)
    return tree, placed


# ---------------------------------------------------------------- search


def best_of_block(
    q: np.ndarray, c: np.ndarray, ids: np.ndarray, counts: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, id, score) of the ``k`` best ids for each query, best first.

    ``ids`` holds the ids of the rows of ``c`` one after the other, ``counts``
    how many each has. A product of matrices finds the rows that can be among
    the best; their scores are summed again in one order, so that equal vectors
    have equal scores wherever they stand.
    """
    rough = q @ c.T
    at = max(0, len(c) - k)
    least = np.partition(rough, at, axis=1)[:, at]
    slack = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(c, axis=1).max()
    row, col = np.nonzero(rough >= (least - slack)[:, None])
    score = np.concatenate(
        [(q[row[a : a + 65536]] * c[col[a : a + 65536]]).sum(axis=1) for a in range(0, len(row), 65536)]
    )
    first = np.cumsum(counts) - counts
    times = counts[col]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    found = ids[np.repeat(first[col], times) + within]
    row, score = np.repeat(row, times), np.repeat(score, times)
    order = np.lexsort((found, -score, row))
    row, found, score = row[order], found[order], score[order]
    top = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[top], found[top], score[top]


def _blocks(rows: DataFrame, key: Column, size: int, *columns: str) -> DataFrame:
    """``rows`` of each leaf in blocks of about ``size``: ``(leaf, block)``, the
    block a list of structs of ``columns``. ``key`` deals the rows out."""
    counts = rows.groupBy("leaf").agg(F.count("*").alias("n"))
    # At most PARTS ** LEVELS rows.
    dealt = rows.join(F.broadcast(counts), "leaf")
    number = F.pmod(F.xxhash64(F.lit(99), key), F.ceil(F.col("n") / size))
    return (
        dealt.withColumn("number", number)
        .groupBy("leaf", "number")
        .agg(F.collect_list(F.struct(*columns)).alias("block"))
        .drop("number")
    )


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    mass: float = MASS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows found with the largest
    inner product for every row where ``queries`` holds, its own id left out.

    The search is approximate; ``mass`` sets its recall, 1 compares everything.
    Scores are exact products of the given vectors in doubles; equal scores are
    ordered by id. With fewer than ``k`` other rows all that are found return.

    Null and zero vectors, vectors with a null or non-finite component, vectors
    of another length than most (the shorter of two equally frequent ones) and
    rows without id take no part. Repeated rows are one row. Other columns are
    not read. An empty table gives no rows.
    """
    v = F.col(vector_column)
    fine = (
        F.col(id_column).isNotNull()
        & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    valid = vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_column).cast("long").alias("id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    usual = valid.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = usual.n if usual else 0
    valid = valid.where(F.size("v") == dim)

    # Equal vectors are one entry. The window drops ids beyond k + 1 of a vector
    # before the shuffle.
    few = Window.partitionBy("v").orderBy("id")
    entries = kept_in_files(
        valid.select("id", "v")
        .withColumn("place", F.dense_rank().over(few))
        .where(F.col("place") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_set("id")).alias("ids")),
        "distinct-vectors",
    )
    asked = kept_in_files(
        valid.where("asks").groupBy("v").agg(F.count("*").alias("rows")).select(
            F.monotonically_increasing_id().alias("query"), "v"
        ),
        "distinct-queries",
    )
    tree, placed = plant(entries, dim)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, leaves = routes_of(tree, _matrix(batch.column(1), dim), mass)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield taken.append_column("leaf", pa.array(leaves, pa.int64()))

    routed = kept_in_files(
        asked.mapInArrow(route, asked.withColumn("leaf", F.lit(0).cast("long")).schema), "routed-queries"
    )
    # Both sides are written: adaptive joins can split a leaf of very many blocks.
    index = kept_in_files(
        _blocks(placed, F.col("v"), BLOCK, "v", "ids").withColumnRenamed("block", "rows"), "index-blocks"
    )
    asks = kept_in_files(
        _blocks(routed, F.col("query"), QUERIES, "query", "v").withColumnRenamed("block", "asks"),
        "query-blocks",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                q, c = (batch.column(i).slice(n, 1).flatten() for i in (0, 1))
                ids = c.field("ids")
                found = best_of_block(
                    _matrix(q.field("v"), dim),
                    _matrix(c.field("v"), dim),
                    ids.flatten().to_numpy(zero_copy_only=False),
                    np.diff(ids.offsets.to_numpy()),
                    k + 1,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        q.field("query").take(pa.array(found[0], pa.int64())),
                        pa.array(found[1], pa.int64()),
                        pa.array(found[2], pa.float64()),
                    ],
                    names=["query", "id", "score"],
                )

    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    tops = kept_in_files(
        asks.join(index, "leaf")
        .select("asks", "rows")
        .mapInArrow(compare, "query long, id long, score double")
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k + 1)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("top"))
        .join(asked, "query")
        .select("v", "top"),
        "nearest-of-vectors",
    )
    own = fresh("own")
    others = F.filter("top", lambda x: x["id"] != F.col(own))
    return (
        valid.where("asks")
        .select(F.col("id").alias(own), "v")
        .distinct()
        .join(tops, "v")
        .select(F.col(own), F.posexplode(F.slice(others, 1, k)).alias("place", "found"))
        .select(
            F.col(own).alias("query_id"),
            (F.col("place") + 1).alias("rank"),
            F.col("found.id").alias("vec_id"),
            F.col("found.score").alias("score"),
        )
    )
