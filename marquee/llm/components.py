"""Connected components of links, by tables only.

Every node takes the smallest label of its neighbours and then the label of that
label, until nothing changes. Labels are combined before they are shuffled, so a
node with very many links is no problem; each round is written, which cuts the
lineage and survives lost executors. Nothing but one count leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.sources.storage import scratch_path, write_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for all nodes that
    have a link. Nodes may be of any type that can be ordered; links to oneself,
    repeated ones and either direction do not matter; none may be null."""
    spark = links.sparkSession
    ends = [F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ((a, b), (b, a))]
    edges = write_table(
        links.select(F.inline(F.array(*ends))).distinct(), scratch_path(spark, "edges")
    )
    labels = write_table(
        edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), scratch_path(spark, "labels")
    )
    while True:
        near = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("root").alias("near"))
        better = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        # The label of the label: paths halve in each round.
        above = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = better.join(above, "root", "left").select(
            "node", F.least("root", F.coalesce("above", "root")).alias("root"), (F.least("root", F.coalesce("above", "root")) < F.col("old")).alias("moved")
        )
        jumped = write_table(jumped, scratch_path(spark, "labels"))
        labels = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return labels
