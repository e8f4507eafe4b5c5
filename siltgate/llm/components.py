"""Connected components of a distributed list of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.sources import staging_dir, written

MAX_ROUNDS = 60
TASK_EDGES = 200_000
MIN_TASKS = 6


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``v, label``: every vertex of an edge with the smallest vertex it can reach.

    Alternating star contraction: each round hangs all larger neighbours of a vertex, then
    all smaller ones, under the smallest; the number of rounds grows with the logarithm of
    the longest path.  Minima are pre-aggregated, so finding the smallest neighbour of a
    vertex with most of the edges costs one row per task; hanging its neighbours under that
    one is a join by the vertex, whose 16-byte rows meet in one task unless adaptive skew
    handling cuts them.  Each round is written to the shared folder, so a lost executor costs
    no earlier round.  No edge, label or component comes to the driver, only a count and a
    checksum per round.
    """
    spark = edges.sparkSession
    stars = written(
        edges.selectExpr(f"greatest({a}, {b}) AS u", f"least({a}, {b}) AS v")
        .filter("u > v")
        .distinct(),
        staging_dir(spark, "edges"),
    )
    before = None
    for _ in range(MAX_ROUNDS):
        seen = stars.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")
        ).first()
        if before == seen or not seen["n"]:
            break
        before = seen
        tasks = max(MIN_TASKS, seen["n"] // TASK_EDGES)
        stars = written(
            _small_star(_large_star(stars, tasks), tasks), staging_dir(spark, "stars")
        )
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (
        stars.selectExpr("u AS v", "v AS label")
        .unionByName(stars.selectExpr("v", "v AS label").distinct())
    )


# A round is several small shuffles.  ``coalesce`` lets one task read many of their
# partitions where there are few edges; it never makes a task larger than TASK_EDGES
# would and does nothing where there are many.


def _large_star(stars: DataFrame, tasks: int) -> DataFrame:
    both = stars.unionByName(stars.selectExpr("v AS u", "u AS v")).coalesce(tasks)
    least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u AS c", "least(u, m) AS m")
    return (
        both.filter("v > u")
        .join(least.coalesce(tasks), F.col("u") == F.col("c"))
        .selectExpr("v AS u", "m AS v")
        .filter("u > v")
        .coalesce(tasks)
        .distinct()
        .coalesce(tasks)
    )


def _small_star(stars: DataFrame, tasks: int) -> DataFrame:
    least = stars.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c").coalesce(tasks)
    moved = stars.join(least, F.col("u") == F.col("c")).selectExpr("v AS u", "m AS v")
    return (
        moved.filter("u > v")
        .coalesce(tasks)
        .unionByName(least.selectExpr("c AS u", "m AS v"))
        .distinct()
        .coalesce(tasks)
    )
