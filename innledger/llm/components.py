"""Connected components of a graph given by its links, without gathering a component anywhere.

In every round each node takes the smallest of itself and its neighbours as parent, then its parent's parent's and so on
four times over, and links are moved from nodes to these; links within one node disappear. A chain shrinks to a quarter in
a round, a star at once. When no link is left, the moves of all rounds are followed from the first to the last. The tables of each round are written to the shared folder, so that a lost executor costs one round at most and
both sides of each join are read from files, which lets Spark split the links of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def components(spark: SparkSession, links: DataFrame, folder: str) -> DataFrame:
    """`node`, `component`: the smallest node reachable, for every node of `links` (a, b: long)."""

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    def followed(first: DataFrame, then: DataFrame) -> DataFrame:
        """`then` applied after `first`; a node that `then` doesn't know stays."""
        up = then.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        return first.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"))

    def parent_of(side: str, parents: DataFrame) -> DataFrame:
        return parents.select(F.col("node").alias(side), F.col("parent").alias(f"p{side}"))

    links = kept(links.select("a", "b").where("a <> b").distinct(), "links0")
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        n = len(rounds)
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        smallest = ends.groupBy("node").agg(F.min("other").alias("least"))
        once = kept(smallest.select("node", F.least("node", "least").alias("parent")), f"parents{n}")
        parents = kept(followed(followed(once, once), followed(once, once)), f"moves{n}")
        rounds.append(parents)
        moved = links.join(parent_of("a", parents), "a").join(parent_of("b", parents), "b")
        moved = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        links = kept(moved.where("a <> b").distinct(), f"links{n + 1}")
    if not rounds:
        return spark.createDataFrame([], "node long, component long")
    labels = rounds[0]
    for parents in rounds[1:]:
        labels = followed(labels, parents)
    labels = labels.withColumnRenamed("parent", "component")
    return kept(labels, "labels")
