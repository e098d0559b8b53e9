"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import written


def components(links: DataFrame, label: str = "stage") -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); the root is the smallest node that can be reached.

    Every round takes the smallest label among a node's neighbours and then the
    label of that label, so chains shorten by half. Labels are minima, which
    combine before the shuffle, and a node with very many links only lengthens
    one side of a join that Spark can split. Each round is written to the shared
    folder; the driver sees the number of changed labels.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter(F.col("a") != F.col("b")).distinct(), f"{label}-links")
    found = written(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), f"{label}-roots"
    )
    while True:
        near = (
            both.join(found, F.col("b") == F.col("node"))
            .select(F.col("a").alias("node"), "root")
            .unionByName(found)
            .groupBy("node")
            .agg(F.min("root").alias("root"))
        )
        jumped = near.alias("n").join(found.alias("f"), F.col("n.root") == F.col("f.node")).select(
            "n.node", F.least("n.root", "f.root").alias("root")
        )
        after = written(
            jumped.join(found.withColumnRenamed("root", "was"), "node"), f"{label}-roots"
        )
        changed = after.filter(F.col("root") != F.col("was")).limit(1).count()
        found = after.drop("was")
        if not changed:
            return found
