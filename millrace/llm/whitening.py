"""Whitening of embeddings fitted on distinct vectors.

Vectors are read on a grid of ``1 / GRID``. Rows of one grid vector are grouped
first, so that a vector with very many copies is fitted and whitened once. Each
distinct vector weighs as much as it has rows, or one. The covariance is a sum
of centred products of matrices, one for each task; its eigenvectors are the
components. Whitened vectors are then joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept_in_files

GRID = 256
COMPONENTS = 4
#: Eigenvalues below this share of the trace are rounding errors: the vectors do
#: not vary there, and no component can be scaled to unit variance.
LEAST_SHARE = 1e-10
#: Products of entries and sums up to here are added in longs.
_SAFE = 1 << 62


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def summed(rows: DataFrame, values: Callable[[pa.RecordBatch], np.ndarray]) -> list:
    """Sum over all batches of ``values`` (a flat array, of doubles or of Python's
    integers), added up in each task, then in Spark for each place."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = values(batch)
                total = own if total is None else total + own
        if total is not None:
            whole = total.dtype == object
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(total))),
                    pa.array([str(x) for x in total] if whole else [None] * len(total), pa.string()),
                    pa.array([None] * len(total) if whole else total, pa.float64()),
                ],
                names=["place", "whole", "real"],
            )

    got = (
        rows.mapInArrow(add, "place long, whole string, real double")
        .groupBy("place")
        .agg(F.sum(F.col("whole").cast("decimal(38,0)")).alias("whole"), F.sum("real").alias("real"))
    )
    # As many rows as there are places: the square of the length of a vector at most.
    return [r.real if r.whole is None else int(r.whole) for r in sorted(got.collect(), key=lambda r: r.place)]


def whole_sums(x: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Exact sums of the rows of ``x``, each taken ``times``, and of ``times``."""
    if int(np.abs(x).max(initial=0)) * int(times.sum()) >= _SAFE:
        x, times = x.astype(object), times.astype(object)
    return np.array([*map(int, times @ x), int(times.sum())], object)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over dimensions of ``(n * x - sums) ** 2`` for each row."""
    top = int(np.abs(x).max(initial=0))
    wide = x.shape[1] * top * max(top, *map(abs, sums), 1)
    if wide < _SAFE:
        squares = (x * x).sum(axis=1)
        products = x @ np.array(sums, np.int64)
    else:
        entries = x.astype(object)
        squares = (entries * entries).sum(axis=1)
        products = entries @ np.array(sums, object)
    whole = sum(s * s for s in sums)
    return [n * n * int(a) - 2 * n * int(b) + whole for a, b in zip(squares, products)]


def components(covariance: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue; the
    largest entry of a vector is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(wanted, int((values > LEAST_SHARE * np.trace(covariance)).sum()))
    values, vectors = values[:keep], vectors[:, :keep]
    if not keep:
        return values, vectors
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)])


def whiten(
    vectors: DataFrame,
    wanted: int = COMPONENTS,
    multiplicity: bool = False,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error,
    exact_deviation)`` for each row and component.

    Each distinct grid vector is fitted with weight one, or with its number of
    rows if ``multiplicity``. ``n`` is the sum of the weights. Components are
    numbered from 1 by falling eigenvalue; those without variance are left out,
    so rows without any variance give none. ``deviation`` is exact, and null in
    the rare case that a long cannot hold it; ``exact_deviation`` is a
    decimal(38,0) for it, null beyond 38 digits. ``identity_error`` is measured on the whitened vectors.

    Null vectors, vectors with a null or non-finite entry and vectors of another
    length than most (the shorter of two equally frequent ones) are left out. A
    null id is kept, repeated rows are rows of their own. Grid values beyond a
    long are its largest or smallest. Other columns are not read. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col(vector_column)
    fine = v.isNotNull() & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    on_grid = F.transform(v, lambda e: F.floor(e.cast("double") * GRID).cast("long"))
    valid = vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_column).alias("vec_id"), on_grid.alias("x")
    )
    usual = valid.groupBy(F.size("x").alias("n")).count().where("n > 0").orderBy(F.desc("count"), "n").first()
    dim = usual.n if usual else 0
    # Vectors go by a strong digest from here on, so that joins carry no vectors.
    digest = F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256))
    valid = valid.where(F.size("x") == dim).withColumn("digest", digest)
    distinct = kept_in_files(
        valid.groupBy("digest").agg(
            F.first("x").alias("x"),
            (F.count("*") if multiplicity else F.max(F.lit(1).cast("long"))).alias("times"),
        ),
        "distinct-grid-vectors",
    )
    fit = distinct.select("x", "times")
    found = summed(fit, lambda batch: whole_sums(_matrix(batch.column(0), dim), batch.column(1).to_numpy()))
    *total, n = found or [0]
    if not n:
        covariance, mean = np.zeros((dim, dim)), np.zeros(dim)
    else:
        mean = np.array([s / n for s in total])

        def products(batch: pa.RecordBatch) -> np.ndarray:
            centred = _matrix(batch.column(0), dim) - mean
            return ((centred * batch.column(1).to_numpy()[:, None]).T @ centred).ravel()

        covariance = np.array(summed(fit, products)).reshape(dim, dim) / n
    values, axes = components(covariance, wanted)
    keep, scales = len(values), np.sqrt(values)
    schema = "digest binary, times long, off string, white array<double>"
    if not keep:
        white = spark.createDataFrame([], schema)
    else:

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), dim)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array([str(d) for d in deviations(x, n, total)], pa.string()),
                        pa.array(list((x - mean) @ axes / scales), pa.list_(pa.float64())),
                    ],
                    names=["digest", "times", "off", "white"],
                )

        white = kept_in_files(distinct.mapInArrow(project, schema), "whitened-vectors")
    error = identity_error(white.select("white", "times"), keep, n)
    explained = F.array(*[F.lit(float(e / np.trace(covariance))) for e in values] or [F.lit(0.0)])
    # The whitened side is written, so a vector with very many copies can be split.
    return (
        valid.select("vec_id", "digest")
        .join(white.select("digest", "off", "white"), "digest")
        .select("vec_id", "off", F.posexplode("white").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            F.col("off").try_cast("long").alias("deviation"),
            "whitened",
            F.element_at(explained, F.col("place") + 1).alias("explained"),
            F.lit(error).alias("identity_error"),
            F.col("off").try_cast("decimal(38,0)").alias("exact_deviation"),
        )
    )


def identity_error(pairs: DataFrame, keep: int, n: int) -> float:
    """Largest absolute entry of the covariance of ``pairs(white, times)`` minus
    the identity."""
    if not keep:
        return 0.0

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        w, times = _matrix(batch.column(0), keep), batch.column(1).to_numpy()
        return np.concatenate([times @ w, ((w * times[:, None]).T @ w).ravel()])

    found = np.array(summed(pairs, moments)) / n
    # Whitened vectors are centred but for rounding, so this loses no digits.
    first, second = found[:keep], found[keep:].reshape(keep, keep)
    return float(np.abs(second - np.outer(first, first) - np.eye(keep)).max())
