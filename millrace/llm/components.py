"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); a component is named by its least node.

    Each round a node takes the least name among its neighbours' and its own, then the name its name
    has. Names are stored after every round; rounds end when none changed, so a component of
    diameter d takes about log d of them. Sums are made before the shuffle, so a hub costs one row
    per task. No links give no rows.
    """
    both = cut_lineage(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    names = cut_lineage(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")),
        "names",
    )
    while True:
        near = (
            both.join(names, both["b"] == names["node"])
            .groupBy("a")
            .agg(F.min("component").alias("near"))
            .withColumnRenamed("a", "of")
        )
        moved = names.join(near, names["node"] == near["of"]).select(
            "node", "component", F.least("component", "near").alias("least")
        )
        moved = cut_lineage(moved, "names")
        of = names.select(F.col("node").alias("named"), F.col("component").alias("further"))
        after = cut_lineage(
            moved.join(of, moved["least"] == of["named"], "left").select(
                "node", F.least("least", "further").alias("component"), F.col("component").alias("old")
            ),
            "names",
        )
        if after.where("component <> old").isEmpty():
            return after.select("node", "component")
        names = after.select("node", "component")
