"""Windowed counts over streams: an extension, as the batch engine has no streams.

Watermarks bound the state; late rows beyond them are dropped by the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per event type and window of ts, streaming or not."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if events.isStreaming else rows
    per = rows.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return per.select(F.col("window.start").alias("start"), "event_type", "n", "value")


def supporting_counts(alignments: DataFrame, genes: DataFrame) -> DataFrame:
    """Running support per gene of arriving alignments: stream against a static table."""
    hits = alignments.join(genes, (F.col("ref_name") == F.col("chromosome")) & (F.col("s") <= F.col("ge")) & (F.col("gs") <= F.col("e")))
    return hits.groupBy("gene_id").agg(F.approx_count_distinct("fragment").alias("support"))
