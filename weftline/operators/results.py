"""Annotations in long and wide form, and views of the results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.fusions import adjusted_identity
from weftline.operators.tasks import dealt

FEATURES = ["break_adj_entropy_min", "cdna_breakseqs_percident", "genome_breakseqs_percident", "est_breakseqs_percident", "splitr_span_pvalue", "splitr_pos_pvalue", "splitr_min_pvalue", "breakpoint_homology", "span_coverage_min", "breakseqs_estislands_percident", "num_splice_variants", "splice_score", "max_repeat_proportion", "mean_map_count"]


def collated(annotations: DataFrame, names: list[str], key: str = "cluster_id") -> DataFrame:
    """One row per key and one column per annotation; the list saves a pass over the data."""
    return annotations.groupBy(key).pivot("anno_type", sorted(names)).agg(F.max("value"))


def as_annotations(wide: DataFrame, names: list[str], key: str = "cluster_id") -> DataFrame:
    return wide.select(key, *[F.col(n).cast("string") for n in names]).unpivot([key], names, "anno_type", "value")


def max_identity(hits: DataFrame, max_gap: int | None = None) -> DataFrame:
    """Best matches / query size per cluster among hits with bounded target gaps."""
    rows = hits if max_gap is None else hits.where(F.col("t_gap_bases") <= max_gap)
    return rows.groupBy("cluster_id").agg(F.max(F.col("matches") / F.col("q_size")).alias("pid"))


def overlap_extents(hits: DataFrame, least: float = 0.9) -> DataFrame:
    """How far good hits reach from the left end, and how early they start to the right end."""
    part = F.col("matches") / (F.col("q_end") - F.col("q_start") + 1)
    good = hits.where(part >= least)
    return good.groupBy("cluster_id").agg(F.max(F.when(F.col("q_start") == 1, F.col("q_end"))).alias("max_left_end"), F.min(F.when(F.col("q_end") == F.col("q_size"), F.col("q_start"))).alias("min_right_start"))


def splice_variants(fusions: DataFrame) -> DataFrame:
    """Distinct pairs of break points per ordered pair of stranded genes, on every fusion."""
    a, b = (F.struct(F.col(f"gene{k}").alias("gene"), F.col(f"strand{k}").alias("strand"), F.col(f"pos{k}").alias("pos")) for k in (1, 2))
    lo, hi = F.least(a, b), F.greatest(a, b)
    rows = fusions.withColumn("pair", F.concat_ws(":", lo["gene"], lo["strand"], hi["gene"], hi["strand"])).withColumn("at", F.concat_ws(":", lo["pos"], hi["pos"]))
    counts = rows.groupBy("pair").agg(F.countDistinct("at").alias("num_splice_variants"))
    return rows.join(counts, "pair").drop("pair", "at")


def mapping_stats(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Per cluster: least, most and mean product of end counts, and how many exceed 1."""
    product = dealt(counts, "fragment").groupBy("fragment").agg(F.max(F.when(F.col("read_end") == 0, F.col("n_alignments"))).alias("n0"), F.max(F.when(F.col("read_end") == 1, F.col("n_alignments"))).alias("n1"))
    product = product.select("fragment", (F.coalesce("n0", F.lit(1)) * F.coalesce("n1", F.lit(1))).alias("n"))
    return members.join(product, "fragment").groupBy("cluster_id").agg(F.min("n").alias("min_map_count"), F.max("n").alias("max_map_count"), F.avg("n").alias("mean_map_count"), F.count_if(F.col("n") > 1).alias("num_multi_map"))


def circos_rows(results: DataFrame) -> DataFrame:
    """Two link rows per fusion: link, chromosome, start, end, orf."""
    side = lambda n: F.struct(F.concat(F.lit("hs"), F.col(f"chr{n}")).alias("chromosome"), F.col(f"pos{n}").alias("start"), F.col(f"pos{n}").alias("end"))
    return results.select(F.col("cluster_id").alias("link"), F.explode(F.array(side(1), side(2))).alias("x"), "orf").select("link", "x.chromosome", "x.start", "x.end", "orf")


def circos_points(cnv: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Plot points of the given copy number levels: chromosome, start, end, value. cnv: chr, start, end, level, value."""
    return cnv.where(F.col("level").isin(*levels)).select(F.concat(F.lit("hs"), F.col("chr")).alias("chromosome"), "start", "end", "value")


def identity_column(pid, size, len1, len2):
    return F.coalesce(adjusted_identity(pid, size, len1, len2), F.lit(0.0))
