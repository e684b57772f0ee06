"""Connected components of an edge list, as alternating large-star and
small-star rounds over DataFrames (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.plans.strategy import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``edges``; root is the smallest node
    reachable. Self-loops, repeats and both directions are allowed; a null end
    drops the edge.

    Every round is one partial aggregate (the smallest neighbour) and one
    equi-join back on the node, written to the shared checkpoint folder; the
    number of rounds grows with the logarithm of the component size. A star
    centre with many leaves is a skewed key of a plain join, which adaptive
    execution splits; nothing is gathered per node or per component.
    """
    e = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    e = materialize(e, "cc")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(
                F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
                F.struct(F.col("u"), F.col("m").alias("v")),
            )).alias("e")
        ).select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        e = materialize(small, "cc")
        sign = e.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum((F.hash("v", "u")).cast("long"))
        ).first()
        if sign == seen:
            break
        seen = sign
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
