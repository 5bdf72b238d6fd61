"""Connected sets of rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def written(df: DataFrame) -> DataFrame:
    """``df`` in the session's checkpoint folder, without its lineage; a temporary folder only where all tasks run on this machine."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None and context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="synapark-graph-"))
    return df.checkpoint()


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, cluster``: the least node that each of ``nodes`` (node) reaches over ``edges`` (a, b).

    Each round a node takes the least label among its neighbours, and then the label
    of that label, which halves the way: rounds grow with the logarithm of the
    longest path. Labels are combined before they are shuffled.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    label = written(nodes.select("node", F.col("node").alias("cluster")).distinct())
    while True:
        least = both.join(label, both["b"] == label["node"]).groupBy("a").agg(F.min("cluster").alias("near"))
        step = label.join(least, label["node"] == least["a"], "left").select("node", "cluster", F.least("cluster", F.coalesce("near", "cluster")).alias("to"))
        up = step.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        new = written(step.join(up, "to").select("node", "cluster", F.least("to", "beyond").alias("new")))
        label = new.select("node", F.col("new").alias("cluster"))
        if new.where("new <> cluster").isEmpty():
            return label
