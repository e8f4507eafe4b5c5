"""Embedding near-duplicates: spherical k-means cells, blocked cosine products within cells.

Vectors are unit vectors in double precision.  Equal vectors are one class that counts
as often as it occurs.  Each class has a home cell, that of the nearest centre, and also
visits the cells with a smaller number in which a partner could live: for centres ``c``
and home ``h`` with ``u = (c - h) / |c - h|`` these are the cells with ``x . u >= -margin``.

``margin = sqrt(1 - t * t)`` (``EXACT``) loses no link at the threshold ``t``: a vector
within that angle of ``x`` and beyond the border to ``c`` cannot exist otherwise.  In many
dimensions it makes nearly every vector visit nearly every cell, which is comparing all
pairs.  The default is ``REACH`` standard deviations of a difference of that length along a
border, ``REACH * sqrt(2 * (1 - t) / r)``, where ``r`` is the number of dimensions that the
vectors really use (the participation ratio of their covariance), and never more than the
exact one.  Vectors of few dimensions thus get the exact margin; others lose about one in
4,000 of the links right at the threshold that cross a border, and fewer above it.
``measured_recall`` compares every 50th vector with all to say what a table loses.

Cells are compared in blocks of ``BLOCK``: home against home, and visitors against home,
so a cell with a third of all vectors is many tasks.  A block answers with one row per
linked vector: its number of links there and one vector of its component, never with
pairs.  Centres are fitted on at most ``SAMPLE`` vectors, those with the smallest hash;
every vector is assigned and compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import hash64, whole_groups
from siltgate.llm.components import connected_components
from siltgate.sources import staging_dir, written

THRESHOLD = 0.95
#: Vectors of a cell, about, at least; there are never more cells than CELLS_A_ROOT times the
#: root of the number of vectors, so that the visits of a vector hardly grow with the table.
CELL_VECTORS = 100
CELLS_A_ROOT = 0.6
MAX_CELLS = 4096
SAMPLE = 40_000
BLOCK = 4096
#: Rows of a block that are multiplied at a time.
_STRIP = 512
#: Standard deviations of a random difference, for the margin that is not exact.
REACH = 3.5
EXACT = -1.0


def fit_centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on unit rows; the first centres are rows spread over the input."""
    if not len(x):
        return np.zeros((0, x.shape[1]))
    k = min(k, len(x))
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = np.concatenate(
            [(x[i : i + 8192] @ centres.T).argmax(axis=1) for i in range(0, len(x), 8192)]
        )
        order = np.argsort(home, kind="stable")
        starts = np.searchsorted(home[order], np.arange(k))
        sums = np.add.reduceat(np.vstack([x[order], np.zeros((1, x.shape[1]))]), starts, axis=0)
        sums[np.bincount(home, minlength=k) == 0] = 0
        norms = np.linalg.norm(sums, axis=1)
        centres[norms > 1e-12] = sums[norms > 1e-12] / norms[norms > 1e-12, None]
    return np.unique(centres, axis=0)


def _units(rows) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for NULL, zero and non-finite ones."""
    out = []
    for row in rows:
        x = None
        if row is not None:
            x = np.array([np.nan if v is None else v for v in row], dtype=float)
        # Scaled by the largest component first, so that no square overflows.
        top = np.abs(x).max() if x is not None and len(x) else 0.0
        good = np.isfinite(top) and top > 0 and np.isfinite(x).all()
        out.append((x / top) / np.linalg.norm(x / top) if good else None)
    return out


def dimensions_used(x: np.ndarray) -> float:
    """Participation ratio of the covariance of rows: how many dimensions they spread over."""
    if len(x) < 2:
        return 1.0
    spread = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2
    return float(spread.sum() ** 2 / max((spread**2).sum(), 1e-300))


def margin_of(sample: np.ndarray, threshold: float) -> float:
    exact = float(np.sqrt(max(0.0, 1 - threshold * threshold)))
    return min(exact, REACH * float(np.sqrt(2 * (1 - threshold) / max(dimensions_used(sample), 1.0))))


def _classes(vectors: DataFrame) -> DataFrame:
    """``vec_id, d, v, x``: each vector as a unit vector in bytes, its length and a name for
    what it is; NULL for those that link with nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = _units(batch["embedding"])
            packed = [None if u is None else u.tobytes() for u in units]
            hashed = hash64([p or b"" for p in packed]).view(np.int64)
            names = [
                None if p is None else int(h) for p, h in zip(packed, hashed, strict=True)
            ]
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"].astype("Int64"),
                    "d": [0 if u is None else len(u) for u in units],
                    "v": pd.array(names, dtype="Int64"),
                    "x": packed,
                }
            )

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInPandas(
        run, "vec_id long, d int, v long, x binary"
    )


def _cells(classes: DataFrame, centres: np.ndarray, margin: float) -> DataFrame:
    """``v, n, x, cell, home``: each class in its home cell and in the cells it visits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = centres @ centres.T
        for batch in batches:
            if not len(batch):
                continue
            x = np.frombuffer(b"".join(batch["x"]), float).reshape(len(batch), -1)
            near = x @ centres.T
            home = near.argmax(axis=1)
            apart = np.sqrt(np.maximum(2 - 2 * gram[home], 1e-12))
            goes = (near - near[np.arange(len(x)), home, None]) >= -margin * apart - 1e-9
            goes &= np.arange(len(centres)) <= home[:, None]
            row, cell = np.nonzero(goes)
            out = batch.iloc[row][["v", "n", "x"]]
            yield out.assign(cell=cell.astype(np.int32), home=cell == home[row])

    return classes.mapInPandas(run, "v long, n long, x binary, cell int, home boolean")


def _parts(placed: DataFrame) -> DataFrame:
    """``cell, part, side, v, n, x``: home blocks against home blocks and against visitors.

    Sides 0 and 1 are compared with each other; side 2 is a block with itself.
    """
    sizes = placed.groupBy("cell").agg(
        F.expr(f"CAST(ceil(count_if(home) / {BLOCK}) AS INT) AS hs"),
        F.expr(f"CAST(ceil(count_if(NOT home) / {BLOCK}) AS INT) AS vs"),
    )
    own = placed.join(sizes.filter("hs > 0"), "cell").selectExpr(
        "*", "CAST(pmod(xxhash64(v), IF(home, hs, vs)) AS INT) AS own"
    )
    return own.selectExpr(
        "cell", "v", "n", "x",
        "explode(IF(home,"
        " concat(transform(sequence(0, hs - 1), j -> struct("
        "   least(j, own) * (hs + vs) + greatest(j, own) AS part,"
        "   IF(j = own, 2, IF(own < j, 0, 1)) AS side)),"
        "  transform(slice(sequence(0, hs + vs - 1), hs + 1, vs), j -> struct(own * (hs + vs) + j AS part, 0 AS side))),"
        " transform(sequence(0, hs - 1), j -> struct(j * (hs + vs) + hs + own AS part, 1 AS side)))) AS p",
    ).select("cell", "p.part", "p.side", "v", "n", "x")


def block_links(
    left: np.ndarray,
    right: np.ndarray,
    n_left: np.ndarray,
    n_right: np.ndarray,
    threshold: float,
    itself: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """Number of links of each row, left rows before right ones, and a row of its component.

    ``n_left`` and ``n_right`` say how many equal vectors a row stands for; ``itself``
    that both sides are the same block.
    """
    a, b = len(left), len(right)
    near = np.empty((a, b), dtype=bool)
    for k in range(0, a, _STRIP):
        near[k : k + _STRIP] = left[k : k + _STRIP] @ right.T >= threshold
    if itself:
        np.fill_diagonal(near, False)
    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    total = a if itself else a + b
    at_row, at_column = rows, columns if itself else a + columns
    near = near[np.ix_(rows, columns)]
    links = np.zeros(total, dtype=np.int64)
    links[at_row] = near @ n_right[columns]
    if not itself:
        links[at_column] = n_left[rows] @ near
    label = np.arange(total)
    while len(rows):
        new = label.copy()
        for k in range(0, len(rows), _STRIP):
            some, at = near[k : k + _STRIP], at_row[k : k + _STRIP]
            of_rows = np.where(some, label[at_column], total).min(axis=1)
            of_columns = np.where(some, label[at][:, None], total).min(axis=0)
            new[at] = np.minimum(new[at], of_rows)
            new[at_column] = np.minimum(new[at_column], of_columns)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return links, label


def _compare(parts: DataFrame, threshold: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, ("cell", "part")):
            found = one(part)
            if len(found):
                yield found

    def one(part: pd.DataFrame) -> pd.DataFrame:
        side, v, n = (part[c].to_numpy() for c in ("side", "v", "n"))
        x = np.frombuffer(b"".join(part["x"]), float).reshape(len(part), -1)
        itself = bool((side == 2).any())
        first = np.flatnonzero(side == (2 if itself else 0))
        second = first if itself else np.flatnonzero(side == 1)
        if not len(first) or not len(second):
            return pd.DataFrame({"v": [], "n_links": [], "w": []})
        links, label = block_links(x[first], x[second], n[first], n[second], threshold, itself)
        rows = first if itself else np.concatenate((first, second))
        hit = links > 0
        return pd.DataFrame(
            {"v": v[rows[hit]], "n_links": links[hit], "w": v[rows[label[hit]]]}
        )

    return (
        parts.repartition("cell", "part")
        .sortWithinPartitions("cell", "part", "v")
        .mapInPandas(run, "v long, n_links long, w long")
    )


def _links_of(
    classes: DataFrame, dim: int, n: int, threshold: float, cell_vectors: int, margin: float | None
) -> DataFrame:
    """``v, n_links, w`` of the vectors of one length: links of each block, and who they join."""
    spark = classes.sparkSession
    k = max(1, min(MAX_CELLS, n // cell_vectors, int(CELLS_A_ROOT * n**0.5)))
    sample = classes.select("v", "x").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toPandas()
    x = np.frombuffer(b"".join(sample["x"]), float).reshape(len(sample), dim)
    if margin is None:
        margin = margin_of(x, threshold)
    elif margin == EXACT:
        margin = float(np.sqrt(max(0.0, 1 - threshold * threshold)))
    placed = _cells(classes.select("v", "n", "x"), fit_centres(x, k), margin)
    placed = written(placed, staging_dir(spark, "cells"))
    return written(_compare(_parts(placed), threshold), staging_dir(spark, "links"))


def measured_recall(
    vectors: DataFrame, threshold: float = THRESHOLD, every: int = 50, margin: float | None = None
) -> tuple[int, int]:
    """Links found and links there are, of the vectors whose id is divisible by ``every``.

    Those vectors are compared with all others, in blocks; both counts are of links to other
    rows, copies included.
    """
    spark = vectors.sparkSession
    asked = vectors.filter(F.expr(f"vec_id % {every} = 0")).select("vec_id").distinct()
    got = near_vectors(vectors, threshold, margin=margin).join(asked, "vec_id", "left_semi")
    n_found = got.agg(F.sum("n_links")).first()[0] or 0
    units = _classes(vectors).filter("v IS NOT NULL").selectExpr("*", "monotonically_increasing_id() AS row")
    units = written(units, staging_dir(spark, "recall"))
    queries = units.filter(F.expr(f"vec_id % {every} = 0"))
    parts = [-(-rows.count() // BLOCK) or 1 for rows in (queries, units)]
    own = [f"CAST(pmod(xxhash64(row), {n}) AS INT)" for n in parts]
    each = [f"explode(sequence(0, {n - 1}))" for n in parts]
    dealt = queries.selectExpr("d", f"{own[0]} AS a", f"{each[1]} AS b", "true AS asks", "x").unionByName(
        units.selectExpr("d", f"{each[0]} AS a", f"{own[1]} AS b", "false AS asks", "x")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, ("d", "a", "b")):
            x = np.frombuffer(b"".join(part["x"]), float).reshape(len(part), -1)
            asks, n = part["asks"].to_numpy(), 0
            for k in range(0, int(asks.sum()), _STRIP):
                n += int((x[asks][k : k + _STRIP] @ x[~asks].T >= threshold).sum())
            yield pd.DataFrame({"n": [n]})

    counted = (
        dealt.repartition("d", "a", "b").sortWithinPartitions("d", "a", "b").mapInPandas(run, "n long")
    )
    n_there = counted.agg(F.sum("n")).first()[0] or 0
    return int(n_found), int(n_there) - queries.count()  # each row is found beside itself


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    cell_vectors: int = CELL_VECTORS,
    margin: float | None = None,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (vec_id, embedding).

    NULL, zero and non-finite vectors link with nothing, vectors of one length only with
    each other.  Rows with a NULL id count as partners and keep a NULL component of their own
    if alone.  ``margin`` is that of the module's text, ``EXACT`` the one that loses nothing.
    """
    spark = vectors.sparkSession
    rows = written(_classes(vectors), staging_dir(spark, "vectors"))
    classes = rows.filter("v IS NOT NULL").groupBy("v").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"), F.min("d").alias("d"), F.min("x").alias("x")
    )
    classes = written(classes, staging_dir(spark, "vectors"))
    found = None
    for d, n in sorted((r["d"], r["n"]) for r in classes.groupBy("d").agg(F.count("*").alias("n")).collect()):
        links = _links_of(classes.filter(F.col("d") == d), d, n, threshold, cell_vectors, margin)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = spark.createDataFrame([], "v long, n_links long, w long")
    labels = connected_components(found.selectExpr("v AS a", "w AS b"))
    links = found.groupBy("v").agg(F.sum("n_links").alias("n_links"))
    named = (
        labels.join(classes.select("v", "least"), "v")
        .groupBy("label")
        .agg(F.min("least").alias("component_id"))
    )
    of_class = (
        classes.select("v", "n", "least")
        .join(links, "v", "left")
        .join(labels.join(named, "label").select("v", "component_id"), "v", "left")
        .selectExpr(
            "v", "coalesce(n_links, 0) + n - 1 AS n_links", "coalesce(component_id, least) AS component_id"
        )
    )
    return (
        rows.select("vec_id", "v")
        .join(of_class, "v", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
