"""Dealing rows to as many tasks as the input's size asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of input files for a task.
TASK_BYTES = 8_000_000
#: A source that doesn't know its size says a very large one.
MOST_TASKS = 100_000


def task_count(df: DataFrame) -> int:
    """Tasks for what is made of the tables that df reads: the session's shuffle partitions at least."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    every = [leaves.apply(i) for i in range(leaves.size())]
    # a checkpoint has the guessed size of the plan that it replaces
    known = sum(int(str(x.stats().sizeInBytes())) for x in every if x.nodeName() != "LogicalRDD")
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-known // TASK_BYTES), MOST_TASKS))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by the keys, over so many tasks that the memory of one doesn't grow with the tables.

    Joins, windows and aggregates on these keys, or on more, need no further
    exchange. For keys that few rows share: a hot key stays in one task.
    """
    return df.repartition(task_count(df), *keys)
