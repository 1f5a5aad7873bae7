"""Connected components as DataFrame joins: alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import written


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges(a, b)``, undirected, any ordered type -> ``(node, component)``,
    the component being its smallest node. Edges with a null end and loops are
    ignored; nodes without another one do not appear.

    Each round points every node's larger neighbours at its smallest one, then
    does the same among smaller neighbours, until the edges no longer change.
    The minima are tables of their own, so that the join back has plain
    exchanges on both sides and a hub with most of the edges can be split.
    Every round's edges are a table in the shared folder.
    """
    e = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    e = written(spark, e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        both = e.union(e.select("b", "a"))
        low = written(spark, both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star-low")
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = written(spark, large, "star")
        least = written(spark, large.groupBy("a").agg(F.min("b").alias("m")), "star-low")
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        e = written(spark, small, "star")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
