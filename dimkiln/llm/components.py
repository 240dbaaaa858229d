"""Connected components of an edge table, by alternating stars.

Large-star and small-star steps (Kiveris et al., 2014) rewrite the edges until
every node points at the smallest node of its component. Each step is a partial
aggregation and a join; the edges and the per-node minima are written to the
shared folder in every step, which cuts the lineage and lets Spark split the
partition of a node that has very many edges. Only row counts and checksums
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkiln.llm.common import materialise


def _minima(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours v."""
    return materialise(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                       "components-min")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_minima(both), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    minima = _minima(down)
    moved = down.join(minima, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = minima.select("u", F.col("m").alias("v"))
    return moved.union(own).filter(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return int(row[0]), int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots themselves.

    ``root`` is the smallest node of the component. Loops and repeated edges are
    allowed; no edges give no rows.
    """
    now = materialise(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), "components-edges")
    state = _state(now)
    while state[0]:
        now = materialise(_small_star(materialise(_large_star(now), "components-large")), "components-small")
        last, state = state, _state(now)
        if state == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
