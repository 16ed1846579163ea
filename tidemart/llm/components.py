"""Connected components of a graph of links, by hooking and pointer jumping in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows as a table in the shared folder: the lineage is cut, and a row has one
    value however often an executor is lost."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(spark: SparkSession, links: DataFrame, root: str) -> DataFrame:
    """(node, label) of every node of `links` (a, b): label is the least node reachable.

    In each round every node hooks onto its least neighbour, parents are followed to
    their roots, and links are moved to the roots; links inside a root's tree go. A
    group shrinks to half at least, so rounds grow with the logarithm of its size. Rows
    are joined by unique nodes with the growing side on the left: a node with very many
    links is split by AQE, and minima merge before the shuffle.
    """
    labels = None
    graph = links.select("a", "b").where("a <> b")
    k = 0
    while True:
        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b"))
        hooks = written(least.select("node", F.least("node", "_b").alias("parent")), f"{root}/hook-{k}")
        step = 0
        while True:
            up = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("_top"))
            moved = hooks.join(up, "parent", "left").select(
                "node",
                F.coalesce("_top", "parent").alias("parent"),
                (F.coalesce("_top", "parent") != F.col("parent")).alias("_moved"),
            )
            step += 1
            hooks = written(moved, f"{root}/hook-{k}-{step}")
            done = hooks.where("_moved").isEmpty()
            hooks = hooks.drop("_moved")
            if done:
                break
        if labels is None:
            labels = hooks.withColumnRenamed("parent", "label")
        else:
            over = hooks.select(F.col("node").alias("label"), F.col("parent").alias("_over"))
            labels = written(
                labels.join(over, "label", "left").select("node", F.coalesce("_over", "label").alias("label")),
                f"{root}/labels-{k}",
            )
        to_a = hooks.select(F.col("node").alias("a"), F.col("parent").alias("_a"))
        to_b = hooks.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        lifted = graph.join(to_a, "a").join(to_b, "b").where("_a <> _b")
        graph = written(
            lifted.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), f"{root}/links-{k}"
        )
        if graph.isEmpty():
            return labels
        k += 1
