"""Connected components of a table of links, in a few joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilcount.session import new_work_folder


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node reachable, for every node of `links` (a, b: long). No links, no rows.

    In a round every node takes the smallest component among its own and its neighbours', and then that of the node it
    points to, so that distances halve. Each round is written, which cuts the lineage, and rounds end when none changes.
    Sums are combined before the shuffle, so a node with very many links is no hot key.
    """
    spark = links.sparkSession
    folder = new_work_folder(spark, "components")
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where(F.col("a") != F.col("b"))
    both.distinct().write.parquet(f"{folder}/links")
    edges = spark.read.parquet(f"{folder}/links")
    start = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component"))
    start.write.parquet(f"{folder}/0")
    labels, rounds = spark.read.parquet(f"{folder}/0"), 0
    while True:
        rounds += 1
        offered = edges.join(labels, edges.b == labels.node).groupBy(F.col("a").alias("of")).agg(F.min("component").alias("offered"))
        nearer = labels.join(offered, labels.node == F.col("of")).select(
            "node", F.col("component").alias("before"), F.least("component", "offered").alias("target")
        )
        jump = labels.select(F.col("node").alias("target"), F.col("component").alias("beyond"))
        step = nearer.join(jump, "target").select(
            "node", F.least("target", "beyond").alias("component"), (F.least("target", "beyond") != F.col("before")).alias("changed")
        )
        step.write.parquet(f"{folder}/{rounds}")
        written = spark.read.parquet(f"{folder}/{rounds}")
        labels = written.select("node", "component")
        if written.where("changed").isEmpty():
            return labels
