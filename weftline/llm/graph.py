"""Connected components of distributed edge tables.

Edges are first contracted where they lie: a task unites its own, a bounded
number, and gives their stars. Then alternating large and small stars (Kiveris
et al., 2014) link vertices to smaller ones until each component is a star
around its smallest vertex. Rounds are tables in the shared folder; nothing is
collected but sums. The steps are the same for every number of edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import materialise

MAX_ROUNDS = 60
#: Edges that one task contracts on average: 16 bytes each.
TASK_EDGES = 200_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of u to the smallest vertex around u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges of each partition as stars around the smallest vertices, by union and find."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(v: int) -> int:
            while up.setdefault(v, v) != v:
                up[v] = v = up[up[v]]
            return v

        for batch in stream:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    up[max(a, b)] = min(a, b)
        stars = [(v, root(v)) for v in list(up)]
        stars = [x for x in stars if x[0] != x[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in stars], pa.int64()) for i in (0, 1)], names=["u", "v"])

    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(run, "u long, v long")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every vertex has one link at most, and none that others link to has one."""
    sides = edges.select(F.col("u").alias("x"), F.lit(1).alias("from"), F.lit(0).alias("to")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("from"), F.lit(1).alias("to")))
    return sides.groupBy("x").agg(F.sum("from").alias("n"), F.max("to").alias("to")).where("n > 1 OR n = 1 AND to = 1").isEmpty()


def components(edges: DataFrame, task_edges: int | None = None) -> DataFrame:
    """vertex, component (its smallest vertex) of every vertex that has an edge.

    edges: u, v of type long. Self-loops and repeated edges don't matter; no
    edges give no rows.
    """
    edges = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "cc-edges")
    tasks = -(-edges.count() // (task_edges or TASK_EDGES))
    if tasks:
        edges = materialise(_contracted(edges.repartition(tasks)), "cc-edges")
    for _ in range(MAX_ROUNDS):
        if not tasks or _are_stars(edges):
            break
        edges = materialise(_small_star(_large_star(edges)), "cc-edges")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
