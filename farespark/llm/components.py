"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation and a join on the node, so neither a
component nor the list of links is ever held by one task or the driver.
Each round is cut with ``checkpoint()`` in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespark.session import checkpoint_root


def _smaller_ends(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smaller_ends(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = _smaller_ends(e)
    rest = e.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    ``edges``: two columns u, v (long); order, repeats and self links do
    not matter, rows with a null end are ignored. An empty input gives an
    empty result.
    """
    checkpoint_root(edges.sparkSession)
    e = (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u is not null and v is not null and u != v")
        .distinct()
        .checkpoint()
    )
    before = _state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        e = _small_star(_large_star(e)).checkpoint()
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not converge")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
