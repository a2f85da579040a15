"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from savora.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every linked node, the component being its smallest node.

    ``links`` holds pairs ``(u, v)``.  Each round ties the larger neighbours of a node to its
    smallest one, then the smaller ones; the number of rounds grows with the logarithm of a component's
    size.  Rounds are stored, so none is computed twice.
    """
    edges = stored(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
        large = (both.filter("v > u").join(least, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("least").alias("v"))).distinct(), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
