"""Connected components of a link table, as joins of least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.session import stage


def component_labels(links: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for every node of ``links`` (a, b).

    Every round a node takes the least of its own label, its neighbours' labels and its label's
    label, which halves long chains. Labels are written after each round, so the lineage stays
    short and a lost executor costs only its tasks. The joins meet two plain shuffles each, so
    adaptive execution can split a node that holds a large part of all links.
    """
    both = stage(
        links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l"))
        .select("l.a", "l.b")
        .distinct(),
        "links",
    )
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")),
        "labels",
    )
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        following = stage(
            labels.join(above, "label", "left")
            .join(heard, "node", "left")
            .select("node", F.least("label", "above", "heard").alias("label"), (F.least("above", "heard") < F.col("label")).alias("changed")),
            "labels",
        )
        labels = following.select("node", "label")
        if following.where("changed").isEmpty():
            return labels
