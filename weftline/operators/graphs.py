"""Connected components of an edge table by label propagation with pointer jumps.

Every round is written as a checkpoint, so lost executors cost one round.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as written to the folder that all executors share."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        at = sc.getConf().get("spark.checkpoint.dir")
        if at is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            at = tempfile.mkdtemp(prefix="weftline-")
        sc.setCheckpointDir(at)
    return df.checkpoint()


def components(edges: DataFrame, most: int = 50) -> DataFrame:
    """vertex, component (smallest vertex) of all vertices of u, v."""
    both = checkpointed(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct())
    labels = checkpointed(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l")))
    for _ in range(most):
        near = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("l").alias("m"))
        step = labels.join(near, "u", "left").select("u", F.least("l", F.coalesce("m", "l")).alias("l"))
        jump = step.select(F.col("u").alias("l"), F.col("l").alias("up"))
        new = checkpointed(step.join(jump, "l", "left").select("u", F.least("l", F.coalesce("up", "l")).alias("l")))
        moved = new.join(labels.withColumnRenamed("l", "old"), "u").where("l <> old").isEmpty()
        labels = new
        if moved:
            return labels.select(F.col("u").alias("vertex"), F.col("l").alias("component"))
    raise RuntimeError("components did not settle")
