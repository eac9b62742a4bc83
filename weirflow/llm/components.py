"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is a grouping with map-side minimum and a join, so a node with a third of all links is a
join that Spark may split, never a group in one task.  The number of rounds grows with the logarithm
of the component's size.  After each round the links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import write_table


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    turned = links.join(least, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return turned.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(hi, lo) with hi > lo -> (node, root) for each node that has a link; root is the least node
    that can be reached.  No links give no rows."""
    current, before = links.select("hi", "lo"), None
    for _ in range(max_rounds):
        current = write_table(_small(_large(current)), "components")
        row = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        state = (row["n"], row["h"])
        if state == before or not row["n"]:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(current.select("lo", "lo").distinct())
        before = state
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
