"""Connected components of an edge table, by alternating large and small stars.

Every round is two aggregations and two joins over edges; nothing is gathered on the
driver but the count and a checksum of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.sources.storage import materialize


def _smallest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least of u and its neighbours beside them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least.withColumn("least", F.least("u", "least")), "u")


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) the frame (node, root): root is the least node that node reaches.

    Only nodes with an edge to another node are returned. Edges with a null end are
    left out; repeated edges count once; no edges give no rows.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    pairs = materialize(pairs.distinct(), "components")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = _smallest(large.distinct())
        links = small.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
            small.select("u", F.col("least").alias("v"))
        )
        pairs = materialize(links.where("u <> v").distinct(), "components")
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
