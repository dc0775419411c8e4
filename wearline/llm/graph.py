"""Connected components of a set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import stage, stage_counted


def components(links: DataFrame) -> DataFrame:
    """(node, label) for links (a, b): label is the smallest node of the component.

    Each round takes the smallest label among the neighbours and then follows the label once
    (pointer jumping), so that long chains take a logarithmic number of rounds. Labels are written
    between rounds; a lost executor re-reads them.
    """
    links = stage(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stage(links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = links.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = stage(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("lower")), "labels")
        target = lower.select(F.col("node").alias("lower"), F.col("lower").alias("next"))
        jumped = lower.join(target, "lower").select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved"))
        jumped, _ = stage_counted(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.where("moved").limit(1).count() == 0:
            return labels
