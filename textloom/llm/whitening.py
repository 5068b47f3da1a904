"""Whitening of embeddings: column aggregates over the upper triangle, LAPACK on the small matrix.

Entries become integers, x = floor(1024 * c) + 100000. One aggregation sums them by dimension; from
the sums come the centres, and a second aggregation, generated as Spark SQL expressions, sums the
centred products of every pair of dimensions. Both give one row, whatever the number of vectors,
so nothing but sums meets in one place: d * (d + 1) / 2 of them, in further aggregations where there
are more than MOST_PAIRS. The driver assembles the covariance, LAPACK decomposes it, and the
vectors are projected where they are, in Arrow batches.

Defined results: vectors that are null, or hold null or non-finite entries, are left out, and so are
those whose length is not the most frequent one (ties: the longer), empty ones included; entries
count as the nearest whole number of at most 2**62 / 1024; components whose eigenvalue is within
rounding of zero have no whitened form and are left out, so equal vectors only, or a single one,
give no rows; equal vectors get equal values, repeated rows are kept, and ids may be null; a
deviation of more than 38 digits is null; an empty table gives no rows; other columns, whatever
their names, are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Sums of one aggregation: those of 140 dimensions.
MOST_PAIRS = 10_000
#: Entries beyond are taken as this.
MOST = 2.0**62
#: Eigenvalues below this share of the largest are rounding.
RANK = 1e-12


@dataclass(frozen=True)
class Whitening:
    """A fit: number of vectors, exact sums of their integers, eigenvectors (columns) by falling eigenvalue, the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, x of all vectors of finite entries: their integers."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == math.inf))
    inside = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(MOST)), F.lit(-MOST))
    kept = df.filter(v.isNotNull()).filter(~bad)
    return kept.select(F.col(id_col).alias("id"), F.transform(v, lambda c: F.floor(inside(c)).cast("long") + SHIFT).alias("x"))


def of_one_length(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The vectors of the most frequent length, and that length (0: there are none)."""
    lengths = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).filter("d > 0")
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    d = top["d"] if top else 0
    return vectors.filter(F.size("x") == d), d


def pair_sums(columns: DataFrame, d: int) -> np.ndarray:
    """Sums of the products of all pairs of columns c0 .. c(d-1), as a symmetric matrix. Only the upper triangle is summed."""
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    out = np.zeros((d, d))
    for at in range(0, len(pairs), MOST_PAIRS):
        block = pairs[at : at + MOST_PAIRS]
        row = columns.selectExpr(*[f"sum(c{i} * c{j}) AS p{i}_{j}" for i, j in block]).first()
        for (i, j), total in zip(block, row):
            out[i, j] = out[j, i] = total
    return out


def fit(vectors: DataFrame, d: int) -> Whitening | None:
    """The components of integer vectors (id, x) of d dimensions; None where there are none."""
    exact = [f"sum(CAST(x[{j}] AS DECIMAL(20, 0))) AS s{j}" for j in range(d)]
    n, *sums = vectors.selectExpr("count(*) AS n", *exact).first()
    if not n or not d:
        return None
    sums = [int(s) for s in sums]
    # no x[j] is null, which Spark can't know; sums of what can't be null are simpler
    centred = vectors.selectExpr(*[f"coalesce(CAST(x[{j}] AS DOUBLE) - {s / n!r}D, 0D) AS c{j}" for j, s in enumerate(sums)])
    covariance = pair_sums(centred, d) / n
    values, basis = np.linalg.eigh(covariance)
    return Whitening(n, sums, basis[:, ::-1], values[::-1], float(np.trace(covariance)))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[list[int], np.ndarray]:
    """For each row of integers the exact sum of (n * x - S) ** 2, and (n * x - S) / n."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    y = n * (x if most < 2**63 else x.astype(object)) - np.array(sums, np.int64 if most < 2**63 else object)
    squares = y if y.dtype == np.int64 and int(np.abs(y).max(initial=0)) ** 2 * len(sums) < 2**63 else y.astype(object)
    return (squares * squares).sum(axis=1).tolist(), (y / n).astype(np.float64)


def project(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """id, deviation, w (whitened coordinates by component) of integer vectors."""
    k = min(components, int((model.values > RANK * max(model.values[0], 0.0)).sum()))
    to_white = model.vectors[:, :k] / np.sqrt(model.values[:k])
    n, sums = model.n, model.sums
    digits = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        exact = decimal.Context(prec=60)
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(sums))
            far, centred = deviations(x, n, sums)
            white = centred @ to_white
            w = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * k, pa.int32()), pa.array(white.ravel()))
            got = pa.array([exact.create_decimal(v) if v < 10**38 else None for v in far], digits)
            yield pa.RecordBatch.from_arrays([batch.column(0), got, w], names=["id", "deviation", "w"])

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {id_type}, deviation decimal(38,0), w array<double>")


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of w less the identity."""
    means = white.selectExpr(*[f"sum(w[{j}]) / {n}D AS m{j}" for j in range(k)]).first()
    centred = white.selectExpr(*[f"w[{j}] - {m!r}D AS c{j}" for j, m in enumerate(means)])
    return float(np.abs(pair_sums(centred, k) / n - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: id_col, component (from 1), n, deviation, whitened, explained, identity_error."""
    vectors, d = of_one_length(integer_vectors(df, id_col, vector_col))
    model = fit(vectors, d)
    shown = ["component int", "n long", "deviation decimal(38,0)", "whitened double", "explained double", "identity_error double"]
    if model is None or model.values[0] <= 0:
        return df.sparkSession.createDataFrame([], f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, {', '.join(shown)}")
    white = materialize(project(vectors, model, components), "whitened")
    k = min(components, int((model.values > RANK * model.values[0]).sum()))
    error = identity_error(white, model.n, k)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:k]])
    rows = white.select("id", "deviation", F.posexplode("w").alias("_place", "whitened"))
    return rows.select(
        F.col("id").alias(id_col), (F.col("_place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("_place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
