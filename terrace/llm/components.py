"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stored


ROWS_PER_TASK = 50_000
LEAST_TASKS = 8


def _stars(edges: DataFrame, tasks: int) -> DataFrame:
    """One large-star and one small-star step; ``edges`` has u and v.

    ``tasks`` follows the number of edges: rounds are many and edges few,
    so a task per shuffle partition would cost more than its rows.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
    large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = (large.where(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).coalesce(tasks).distinct())
    lowest = down.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
    moved = down.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct().coalesce(tasks)


def components(edges: DataFrame) -> DataFrame:
    """u, v: every node but the least of its component, with that least node.

    ``edges``: u, v of one orderable type, any direction, repeats allowed.
    Each round is written to the shared folder, which cuts its lineage; the
    rounds end when no node is both a child and a root or has two roots.
    """
    edges = stored(edges.where(F.col("u") != F.col("v")).distinct(), "components")
    tasks = max(LEAST_TASKS, edges.count() // ROWS_PER_TASK)
    while True:
        edges = stored(_stars(edges, tasks), "components")
        roles = edges.select("u", F.lit(1).alias("child")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("child")))
        busy = (roles.groupBy("u").agg(F.sum("child").alias("n"), F.min("child").alias("least"))
                .where((F.col("n") > 1) | ((F.col("n") == 1) & (F.col("least") == 0))))
        if busy.coalesce(tasks).isEmpty():
            return edges
