"""Connected components of a graph of links, by labels that sink to the least number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``least``: the least node of its component, for nodes of ``links`` (a, b).

    Each round takes the least label among neighbours, then the label of that label, so long
    chains shrink fast. Labels are written each round. Ends when no label changes.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both, "links")
    labels = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("least")),
        "labels",
    )
    while True:
        near = (
            edges.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("n"))
            .agg(F.min("least").alias("near"))
        )
        sunk = written(
            labels.join(written(near, "near-labels"), F.col("node") == F.col("n"))
            .select("node", F.col("least").alias("old"), F.least("least", "near").alias("least")),
            "labels",
        )
        jumped = written(
            sunk.join(sunk.select(F.col("node").alias("n"), F.col("least").alias("further")), F.col("least") == F.col("n"))
            .select("node", "old", F.least("least", "further").alias("least")),
            "labels",
        )
        if jumped.where("old <> least").isEmpty():
            return jumped.select("node", "least")
        labels = jumped.select("node", "least")
