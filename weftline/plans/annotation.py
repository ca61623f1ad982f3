"""Annotation of predicted junctions: one wide row per cluster.

Inputs are tables of earlier stages. Booleans stay booleans and missing values
null; the sinks render them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import fusions as fu
from weftline.functions import intervals as iv
from weftline.functions import sequences as sq
from weftline.operators import genemodels as gm
from weftline.operators import intervals as ij
from weftline.operators import reads as rd
from weftline.operators import results as rs
from weftline.plans.pipeline import Reference
from weftline.sources.config import Settings

#: Target gaps up to which a hit counts, per kind of target.
MAX_GAP = {"genome": 2000, "cdna": 10_000_000, "est": 10_000}


def genomic_breaks(breaks: DataFrame, reference: Reference) -> DataFrame:
    """Breaks on the genome with their genes.

    A break on ``gene|transcript`` goes through the transcript's exons, any
    other belongs to the nearest gene of its chromosome.
    """
    on_transcript = F.contains(F.col("ref_name"), F.lit("|"))
    rows = breaks.where(on_transcript).withColumns({"gene_id": sq.gene_of(F.col("ref_name")), "transcript_id": sq.transcript_of(F.col("ref_name"))})
    places = gm.to_genome(rows.select("transcript_id", F.col("break_pos").alias("t_pos")).distinct(), reference.exons)
    models = reference.exons.groupBy("transcript_id").agg(F.min("strand").alias("model"))
    rows = rows.join(places.withColumnRenamed("t_pos", "break_pos"), ["transcript_id", "break_pos"]).join(models, "transcript_id")
    rows = rows.select("cluster_id", "cluster_end", "gene_id", "transcript_id", "chromosome", F.col("g_pos").cast("long").alias("pos"), gm.remapped_strand(F.col("strand"), F.col("model")).alias("strand"))
    free = breaks.where(~on_transcript).select("cluster_id", "cluster_end", F.col("ref_name").alias("chromosome"), F.col("break_pos").cast("long").alias("pos"), "strand")
    genes = reference.genes.select("gene_id", "chromosome", F.col("gs").cast("long").alias("gs"), F.col("ge").cast("long").alias("ge"))
    near = ij.nearest(free.select("chromosome", "pos"), genes, "chromosome", "pos", "gene_id", ("gs", "ge"))
    free = free.join(near.drop("distance"), ["chromosome", "pos"], "left")
    return rows.unionByName(free.withColumn("transcript_id", F.lit(None).cast("string")).select(*rows.columns))


def coding_parts(reference: Reference, coding: DataFrame) -> DataFrame:
    """gene_id, side, ps, pe of coding exon parts and of untranslated ones."""
    genes = reference.exons.select("transcript_id", "gene_id").distinct()
    parts = coding.select("transcript_id", F.lit("coding").alias("side"), F.col("s").alias("ps"), F.col("e").alias("pe"))
    parts = parts.unionByName(reference.utrs.select("transcript_id", "side", F.col("s").alias("ps"), F.col("e").alias("pe")))
    return parts.join(genes, "transcript_id").select("gene_id", "side", "ps", "pe")


def sides(breaks: DataFrame, reference: Reference, coding: DataFrame) -> DataFrame:
    """One row per cluster with gene, position, strands and location of both sides."""
    genes = reference.genes.select("gene_id", F.col("strand").alias("gene_strand"), F.col("gs").alias("gene_start"), F.col("ge").alias("gene_end"))
    rows = genomic_breaks(breaks, reference)
    plain = genes.select("gene_id", F.col("gene_strand").alias("strand"), F.col("gene_start").alias("gs"), F.col("gene_end").alias("ge"))
    places = gm.gene_locations(rows.where("gene_id IS NOT NULL").select("gene_id", "pos"), plain, coding_parts(reference, coding))
    rows = rows.join(genes, "gene_id", "left").join(places, ["gene_id", "pos"], "left")
    side = lambda k: rows.where(F.col("cluster_end") == k - 1).select("cluster_id", F.col("gene_id").alias(f"gene{k}"), F.col("transcript_id").alias(f"transcript{k}"), F.col("chromosome").alias(f"gene_chromosome{k}"), F.col("gene_strand").alias(f"gene_strand{k}"), F.col("gene_start").alias(f"gene_start{k}"), F.col("gene_end").alias(f"gene_end{k}"), gm.remapped_strand(F.col("strand"), F.col("gene_strand")).alias(f"gene_align_strand{k}"), F.col("pos").alias(f"genomic_break_pos{k}"), F.col("strand").alias(f"genomic_strand{k}"), F.coalesce("location", F.lit("")).alias(f"gene_location{k}"))
    return side(1).join(side(2), "cluster_id")


def break_concordant(breaks: DataFrame, pairs: DataFrame, bias: int = 10) -> DataFrame:
    """Concordant pairs that span each break with ``bias`` bases to spare.

    breaks: cluster_id, cluster_end, ref_name, break_pos. pairs: ref_name, s, e.
    """
    points = breaks.select("cluster_id", "cluster_end", F.col("ref_name").alias("break_ref"), "break_pos")
    inner = pairs.select("ref_name", (F.col("s") + bias).alias("ps"), (F.col("e") - bias).alias("pe"))
    found = ij.point_join(points, inner, [("break_ref", "ref_name")], "break_pos", ("ps", "pe"), 1000)
    return found.groupBy("cluster_id", "cluster_end").agg(F.count("*").alias("n_concordant"))


def interrupted(breaks: DataFrame, exons: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exonic bases and aligned bases before and after each break, in genomic order.

    breaks: cluster_id, cluster_end, gene_id, pos. pairs: gene_id, s, e on the genome.
    """
    merged = ij.islands(exons.select("gene_id", "s", "e"), ["gene_id"]).select("gene_id", "s", "e")
    points = breaks.select("cluster_id", "cluster_end", "gene_id", "pos")

    def sums(parts: DataFrame, what: str) -> DataFrame:
        before = iv.overlap_size(F.col("s"), F.col("e"), F.lit(-(2**40)), F.col("pos") - 1)
        after = iv.overlap_size(F.col("s"), F.col("e"), F.col("pos") + 1, F.lit(2**40))
        return points.join(parts, "gene_id").groupBy("cluster_id", "cluster_end").agg(F.sum(before).alias(f"{what}_before"), F.sum(after).alias(f"{what}_after"))

    sizes = sums(merged, "size").join(sums(pairs.select("gene_id", "s", "e"), "count"), ["cluster_id", "cluster_end"], "left")
    sizes = sizes.fillna(0, ["count_before", "count_after"])
    c = F.col
    return sizes.withColumn("interrupted_index", fu.index_ratio(c("count_before"), c("size_before"), c("count_after"), c("size_after")))


def repeat_proportions(regions: DataFrame, repeats: DataFrame) -> DataFrame:
    """Per cluster and end the largest overlap with one repeat, over the region's length."""
    other = repeats.select(F.col("chromosome").alias("rep_chromosome"), F.col("s").alias("rs"), F.col("e").alias("re"))
    hits = ij.overlap_join(regions, other, [("ref_name", "rep_chromosome")], ("s", "e"), ("rs", "re"), 5000)
    top = hits.groupBy("cluster_id", "cluster_end").agg(F.max(iv.overlap_size(F.col("s"), F.col("e"), F.col("rs"), F.col("re"))).alias("top"))
    size = regions.select("cluster_id", "cluster_end", iv.length(F.col("s"), F.col("e")).alias("size"))
    return size.join(top, ["cluster_id", "cluster_end"], "left").select("cluster_id", "cluster_end", (F.coalesce("top", F.lit(0)) / F.col("size")).alias("repeat_proportion"))


def annotate(breaks: DataFrame, members: DataFrame, junctions: DataFrame, reference: Reference, coding: DataFrame, hits: dict[str, DataFrame], expression: DataFrame, counts: DataFrame, repeats: DataFrame, fraglength_mean: float, readlength_min: int, library: str = "", settings: Settings = Settings()) -> DataFrame:
    """All annotations of the clusters that have a junction sequence.

    junctions: cluster_id, sequence with its bar. hits: query alignments of the
    sequences by target (genome, cdna, est). counts: fragment, read_end, n_alignments.
    """
    c = F.col
    rows = sides(breaks, reference, coding).join(junctions.select("cluster_id", "sequence"), "cluster_id").withColumn("library_name", F.lit(library))
    pair = reference.adjacent.select(c("gene1").alias("__lo"), c("gene2").alias("__hi")).distinct()
    rows = rows.join(pair, (F.least("gene1", "gene2") == c("__lo")) & (F.greatest("gene1", "gene2") == c("__hi")), "left").withColumn("adjacent", c("__lo").isNotNull()).drop("__lo", "__hi")
    rows = rows.withColumns(fu.event_flags(c("gene_chromosome1"), c("gene_chromosome2"), c("genomic_strand1"), c("genomic_strand2"), c("genomic_break_pos1"), c("genomic_break_pos2"), c("adjacent")))
    variants = rs.splice_variants(rows.select("cluster_id", *[c(f"gene{k}") for k in (1, 2)], *[c(f"genomic_strand{k}").alias(f"strand{k}") for k in (1, 2)], *[c(f"genomic_break_pos{k}").alias(f"pos{k}") for k in (1, 2)])).select("cluster_id", "num_splice_variants")
    rows = rows.join(variants, "cluster_id")
    left, right = sq.junction_context(c("sequence"))
    rows = rows.withColumns({"__left": left, "__right": right})
    rows = rows.withColumns({"break_adj_entropy1": sq.pair_entropy(c("__left")), "break_adj_entropy2": sq.pair_entropy(c("__right")), "splice_score": sq.splice_score(F.substring("__right", 1, 2), F.reverse(F.substring(F.reverse("__left"), 1, 2)))})
    rows = rows.withColumn("break_adj_entropy_min", F.least("break_adj_entropy1", "break_adj_entropy2"))
    rows = rows.join(members.groupBy("cluster_id").agg(F.countDistinct("fragment").alias("span_count")), "cluster_id", "left")
    covered = ij.islands(members, ["cluster_id", "cluster_end", "ref_name"]).groupBy("cluster_id", "cluster_end").agg((F.sum(iv.length(c("s"), c("e"))) / F.lit(fraglength_mean - readlength_min)).alias("v"))
    bounds = members.groupBy("cluster_id", "cluster_end", "ref_name").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    for k in (1, 2):
        rows = rows.join(covered.where(c("cluster_end") == k - 1).select("cluster_id", c("v").alias(f"span_coverage{k}")), "cluster_id", "left")
        rows = rows.join(repeat_proportions(bounds, repeats).where(c("cluster_end") == k - 1).select("cluster_id", c("repeat_proportion").alias(f"repeat_proportion{k}")), "cluster_id", "left")
        rows = rows.join(expression.select(c("gene").alias(f"gene{k}"), c("expression").alias(f"expression{k}")), f"gene{k}", "left")
    rows = rows.fillna(0.0, ["expression1", "expression2"]).withColumns({"span_coverage_min": F.least("span_coverage1", "span_coverage2"), "span_coverage_max": F.greatest("span_coverage1", "span_coverage2"), "max_repeat_proportion": F.greatest("repeat_proportion1", "repeat_proportion2")})
    at = F.instr("sequence", "|")
    total = F.length("sequence") - 1
    for kind, found in hits.items():
        best = rs.max_identity(found, MAX_GAP.get(kind)).withColumnRenamed("pid", "__pid")
        rows = rows.join(best, "cluster_id", "left").withColumn(f"{kind}_breakseqs_percident", F.coalesce(fu.adjusted_identity(c("__pid"), total, at - 1, total - at + 1), F.lit(0.0))).drop("__pid")
    if "genome" in hits:
        free = rs.max_identity(hits["genome"]).select("cluster_id", (c("pid") > settings.percent_identity_threshold).alias("altsplice"))
        rows = rows.join(free, "cluster_id", "left").fillna(False, ["altsplice"])
    near = [hits[k] for k in ("genome", "cdna") if k in hits]
    if near:
        both = near[0] if len(near) == 1 else near[0].unionByName(near[1])
        extents = rs.overlap_extents(both, settings.percent_identity_threshold)
        rows = rows.join(extents, "cluster_id", "left").withColumn("breakpoint_homology", F.coalesce(fu.homology(c("max_left_end"), c("min_right_start")), F.lit(0))).drop("max_left_end", "min_right_start")
    return rows.join(rs.mapping_stats(members.select("cluster_id", "fragment").distinct(), counts), "cluster_id", "left").drop("__left", "__right")


def est_identity(hits: DataFrame, islands: DataFrame, slack: int = 300) -> DataFrame:
    """Best identity of hits that lie inside a merged EST region, widened by slack."""
    merged = ij.islands(islands, ["chromosome"], gap=0).select(F.col("chromosome").alias("island_chromosome"), F.col("s").alias("rs"), F.col("e").alias("re"))
    inside = ij.overlap_join(hits, merged, [("t_name", "island_chromosome")], ("t_start", "t_end"), ("rs", "re"), 100_000, how="within", slack=slack)
    return rs.max_identity(inside)


def concordant_clusters(scores: DataFrame, clusters: DataFrame, least: float = 0.8) -> DataFrame:
    """Clusters none of whose local realignments reaches the share of the best score."""
    return rd.keep_ids(clusters, scores.where(F.col("percent") >= least), "cluster_id", "id", invert=True)
