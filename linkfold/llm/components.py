"""Connected components of links in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for the nodes of links(a, b): the least node that can be reached.

    Every round takes the least component among a node and its neighbours, then that one's own, so chains shrink fast. All
    of it are joins and aggregates over tables in the shared folder; nothing is gathered.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct()
    both = written(both, "links")
    now = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "components")
    for _ in range(rounds):
        near = both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_near"))
        step = now.join(near, "node").select("node", F.col("component").alias("_was"), F.least("component", "_near").alias("_to"))
        jump = now.select(F.col("node").alias("_to"), F.col("component").alias("component"))
        step = written(step.join(jump, "_to").select("node", "component", (F.col("component") != F.col("_was")).alias("_new")), "components")
        dropped(now)
        now = step
        if step.filter("_new").isEmpty():
            dropped(both)
            now = step.select("node", "component")
            now._written_to = step._written_to
            return now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
