"""Whitening of embeddings by QR and the singular values of a bidiagonal matrix.

Vectors are whole numbers, so that their sums are exact.  A task centres blocks of rows by
the block's own exact mean and reduces each to the ``R`` of its QR factorisation.  Two such
reductions, with their counts and sums, make one: the rows of both ``R`` and one more row
for the distance of the means, factorised again.  No covariance is ever formed, so no
accuracy is lost to large means.  Reductions are merged 32 at a time, in as many rounds as
the number of tasks asks for, and at most 32 come to the driver, whatever the table's size.

The last ``R`` is made bidiagonal, its singular values are found by dqds and the right
vectors by twisted factorisations (``bidiagonal``).  They travel to the tasks, which
project every row; the covariance of what they write is then measured in the same way.

Dropped rows: NULL and empty vectors, those with a NULL or non-finite entry or one whose
whole number is beyond 2**53, and those of another length than the commonest (the shorter
one of a tie).  Repeated rows and NULL ids are rows like others.  Components without
variance cannot be scaled to it and are left out, so equal vectors give no rows at all.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.bidiagonal import right_singular
from siltgate.sources import staging_dir, written

COMPONENTS = 32
#: Rows of a block, and reductions that are merged by one task.
BLOCK, FAN_IN = 4096, 32
_EXACT = 2**53
#: Singular values below this share of the largest, a dimension, count as nothing.
_NOTHING = 2.0**-40


#: Rows seen so far: their number, exact sums, and ``R`` of the rows less their mean.
#: Plain tuples, which tasks can pass on without this package.
Reduced = tuple[int, tuple[int, ...], np.ndarray]


def merged(one: Reduced, two: Reduced) -> Reduced:
    (n, a, r), (m, b, q) = one, two
    apart = np.array([(y * n - x * m) / (n * m) for x, y in zip(a, b, strict=True)])
    rows = np.vstack((r, q, apart * np.sqrt(n * m / (n + m))))
    return n + m, tuple(x + y for x, y in zip(a, b, strict=True)), np.linalg.qr(rows, mode="r")


def _column_sums(x: np.ndarray) -> list[int]:
    # In int64 where nothing can overflow, else in Python's numbers.
    small = int(np.abs(x).max(initial=0)) * len(x) < 2**62
    return [int(s) for s in (x if small else x.astype(object)).sum(axis=0)]


def _centred(x: np.ndarray, sums, n: int) -> np.ndarray:
    """``x - sums / n``: whole parts are taken away exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def reduced(x: np.ndarray) -> Reduced:
    sums = _column_sums(x)
    return len(x), tuple(sums), np.linalg.qr(_centred(x, sums, len(x)), mode="r")


def products(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, mean, and products of the rows less their mean."""
    mean = x.mean(axis=0)
    return len(x), mean, (x - mean).T @ (x - mean)


def merged_products(one, two):
    (n, mean, inner), (m, other, more) = one, two
    apart = other - mean
    inner = inner + more + np.outer(apart, apart) * (n * m / (n + m))
    return n + m, mean + apart * (m / (n + m)), inner


def _blocks(batch: pa.RecordBatch, column: str, kind) -> Iterator[tuple[int, np.ndarray]]:
    rows = batch.column(batch.schema.get_field_index(column))
    for at in range(0, len(rows), BLOCK):
        part = rows.slice(at, BLOCK)
        yield at, part.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(part), -1)


def whole_vectors(vectors: DataFrame, column: str = "x") -> DataFrame:
    """Rows of ``vec_id, x`` whose entries are all there, exact, and as many as usual."""
    good = vectors.filter(
        f"size({column}) > 0 AND NOT exists({column}, v -> v IS NULL OR v > {_EXACT} OR v < -{_EXACT})"
    ).selectExpr("CAST(vec_id AS LONG) AS vec_id", f"{column} AS x")
    usual = good.groupBy(F.expr("size(x) AS d")).count().orderBy(F.desc("count"), "d").first()
    return good.filter(F.size("x") == (usual["d"] if usual else 0))


def over_rows(rows: DataFrame, column: str, kind, start: Callable, merge: Callable):
    """``start`` of every block, merged two by two to one; None if there are no rows.

    A task makes one state of its blocks.  States are merged 32 at a time, so that neither
    a task nor the driver ever holds more, however many tasks there were.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = (start(x) for batch in batches for _, x in _blocks(batch, column, kind))
        whole = reduce(merge, states, None)
        if whole is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"part": [part], "state": [pickle.dumps(whole)]})

    def both(one, two):
        return two if one is None else merge_two(one, two)

    def of_group(group: pd.DataFrame) -> pd.DataFrame:
        whole = reduce(merge, map(pickle.loads, group["state"]), None)
        return pd.DataFrame({"part": group["part"].min(), "state": [pickle.dumps(whole)]})

    merge_two, merge = merge, both
    schema = "part long, state binary"
    states = written(
        rows.select(column).mapInArrow(run, schema), staging_dir(rows.sparkSession, "states")
    )
    last = states.agg(F.max("part")).first()[0]
    lanes = 0 if last is None else last + 1
    while lanes > FAN_IN:
        lanes = -(-lanes // FAN_IN)
        states = states.withColumn("part", F.col("part") % lanes).groupBy("part").applyInPandas(of_group, schema)
    return reduce(merge, (pickle.loads(r["state"]) for r in states.orderBy("part").collect()), None)


@dataclass(frozen=True)
class Whitening:
    """``directions`` are unit columns; ``variances`` theirs; ``total`` that of all dimensions."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    total: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.sums, self.n) @ (self.directions / np.sqrt(self.variances))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n x - sums)`` squared; None if it is no 64-bit number."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        near = x - whole
        top = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if top * top * x.shape[1] < 2**63:
            y = near * self.n - np.array(rest, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = near.astype(object) * self.n - np.array(rest, object)
        return [s if s < 2**63 else None for s in (y * y).sum(axis=1)]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The directions of ``whole_vectors`` rows, by falling variance; None without rows."""
    whole = over_rows(rows, "x", np.int64, reduced, merged)
    if whole is None:
        return None
    n, sums, r = whole
    squares, directions, total = right_singular(r, components)
    there = squares > squares[:1] * (len(sums) * _NOTHING) ** 2
    return Whitening(n, sums, directions[:, there], squares[there] / n, total / n)


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened``: each row's distance and its coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _blocks(batch, "x", np.int64):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(x)),
                        pa.array(model.deviations(x), pa.int64()),
                        pa.ListArray.from_arrays(
                            np.arange(len(x) + 1, dtype=np.int32) * len(model.variances),
                            model.project(x).ravel(),
                        ),
                    ],
                    ["vec_id", "deviation", "whitened"],
                )

    return rows.select("vec_id", "x").mapInArrow(
        run, "vec_id long, deviation long, whitened array<double>"
    )


def identity_error(whitened: DataFrame) -> float:
    """Largest entry of the covariance of ``whitened`` less the identity.

    The rows are of the order of one, so their products lose nothing.
    """
    n, _, inner = over_rows(whitened, "whitened", float, products, merged_products)
    return float(np.abs(inner / n - np.eye(len(inner))).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "x") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for
    each vector of whole numbers and each component, from 1 by falling variance."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, column)
    model = fit(rows, components)
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double,"
        " identity_error double"
    )
    if model is None or not len(model.variances):
        return spark.createDataFrame([], schema)
    projected = written(project(rows, model), staging_dir(spark, "whitened"))
    error = identity_error(projected)
    explained = ", ".join(f"{v!r}D" for v in (model.variances / model.total).tolist())
    return (
        projected.selectExpr("vec_id", "deviation", "whitened", f"array({explained}) AS explained")
        .selectExpr("vec_id", "deviation", "posexplode(arrays_zip(whitened, explained)) AS (k, c)")
        .selectExpr(
            "vec_id", "CAST(k + 1 AS INT) AS component", f"{model.n}L AS n", "deviation",
            "c.whitened AS whitened", "c.explained AS explained", f"{error!r}D AS identity_error",
        )
    )


def fixed_point(embeddings: DataFrame, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """``vec_id, x``: each entry times ``scale`` in double precision, rounded down, plus ``offset``.

    An entry that is NaN, infinite or too large to be exact becomes NULL, which drops its row.
    """
    entry = f"floor(CAST(c AS DOUBLE) * {scale}D)"
    return embeddings.selectExpr(
        "vec_id",
        f"""transform(embedding, c -> IF(abs(CAST(c AS DOUBLE)) * {scale}D < {_EXACT - offset}D,
            {entry} + {offset}L, NULL)) AS x""",
    )
