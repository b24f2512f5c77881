"""Connected components of links, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; a component's name is its smallest node.

    Each round gives a node the smallest name among its neighbours', then the name's own name, which halves the way to the
    smallest node.  A round is kept in the shared folder, so lineage stays short.  Nodes are not null; repeated links and
    links of a node to itself change nothing; no links give no rows.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionAll(
        links.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct()
    both = checkpointed(both)
    names = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component"))
    names = checkpointed(names)
    while True:
        theirs = names.select(F.col("node").alias("other"), F.col("component").alias("theirs"))
        nearest = both.join(theirs, "other").groupBy("node").agg(F.min("theirs").alias("nearest"))
        step = names.join(nearest, "node").select("node", F.col("component").alias("old"), F.least("component", "nearest").alias("name"))
        above = step.select(F.col("node").alias("name"), F.col("name").alias("named"))
        step = checkpointed(step.join(above, "name").select("node", "old", F.col("named").alias("component")))
        names = step.select("node", "component")
        if step.where("component <> old").isEmpty():
            return names
