"""End-to-end jobs: reference tables, discovery of junctions, supporting reads.

External aligners are inputs here: their alignments come as tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import fusions as fu
from weftline.functions import stats as st
from weftline.functions.intervals import bins, length, overlaps
from weftline.functions.sequences import reverse_complement, window
from weftline.operators import alignment as al
from weftline.operators import clusters as cl
from weftline.operators import genemodels as gm
from weftline.operators import intervals as ij
from weftline.operators import reads as rd
from weftline.operators.classify import classify
from weftline.operators.results import FEATURES
from weftline.sources.config import Settings


@dataclass(frozen=True)
class Reference:
    """The dimension tables of a gene model."""

    exons: DataFrame
    genes: DataFrame
    utrs: DataFrame
    adjacent: DataFrame


def build_reference(models: DataFrame) -> Reference:
    """Tables from GTF rows: exons, gene bounds, untranslated parts, neighbours."""
    exons = models.where("feature = 'exon'").select("gene_id", "transcript_id", "chromosome", "strand", "s", "e")
    coding = models.where("feature = 'CDS'").select("transcript_id", "s", "e")
    genes = gm.gene_regions(exons)
    return Reference(exons, genes, gm.utrs(exons, coding), ij.adjacency(genes, "chromosome", "gene_id", ("gs", "ge")))


def discordant(rows: DataFrame, genes: DataFrame, settings: Settings = Settings(), suppressed: DataFrame | None = None, excluded: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Alignments of fragments in none of the exclusion sets and with both ends.

    rows: fragment, read_end, ref_name, strand, s, e. ``suppressed`` and
    ``excluded`` are tables with a column fragment (ribosomal, immune, prefilter).
    """
    sets = [rd.unmappable(rd.alignment_counts(rows, ["fragment", "read_end"]), settings.max_paired_alignments), rd.same_gene(rows, genes), rd.same_region(rows, settings.dna_concordant_length // 2), *excluded]
    if suppressed is not None:
        sets.append(suppressed)
    gone = sets[0].select("fragment")
    for x in sets[1:]:
        gone = gone.unionByName(x.select("fragment"))
    return rd.both_ends(rd.keep_ids(rows, gone.distinct(), "fragment", "fragment", invert=True))


#: A pair of bins: reference, strand and bin of either end.
BIN_PAIR = ["ref_name0", "strand0", "bin0", "ref_name1", "strand1", "bin1"]


def binned_pairs(rows: DataFrame, reach: int, size: int = 32768) -> DataFrame:
    """The pairs of alignments of a fragment's two ends, in every pair of bins that they touch.

    An end lies in every bin that it touches when widened by the reach, so the
    pairs of one junction share a pair of bins wherever the edges are. The
    smaller end by reference, strand, bin and position comes first, whichever
    read end it is. x and y are the ends' outer positions along their strands.
    """
    held = rows.select("fragment", "read_end", "ref_name", "strand", "s", "e")
    cut = held.withColumn("bin", F.explode(bins(F.greatest(F.col("s") - reach, F.lit(0)), F.col("e") + reach, size)))
    # of a read's alignments that touch the same range in a bin the first one stays
    cut = cut.withColumn("place", F.struct("ref_name", "strand", "bin"))
    cut = rd.non_overlapping(cut, ["fragment", "read_end", "place"], reach, ["s", "e"]).drop("place")
    end = F.struct("ref_name", "strand", "bin", "s", "e", "read_end")
    side = lambda k, x: cut.where(F.col("read_end") == k).select("fragment", end.alias(x))
    both = side(0, "a").join(side(1, "b"), "fragment")
    both = both.select("fragment", F.least("a", "b").alias("end0"), F.greatest("a", "b").alias("end1"))
    names = [F.col(f"end{k}.{c}").alias(f"{c}{k}") for k in (0, 1) for c in ("ref_name", "strand", "bin", "s", "e", "read_end")]
    outer = lambda k: F.when(F.col(f"strand{k}") == "+", F.col(f"e{k}")).otherwise(-F.col(f"s{k}"))
    sizes = {"len1": length(F.col("s0"), F.col("e0")), "len2": length(F.col("s1"), F.col("e1"))}
    return both.select("fragment", *names).withColumns({"x": outer(0), "y": outer(1), **sizes})


def find_clusters(rows: DataFrame, mean: float, sd: float, settings: Settings = Settings()) -> DataFrame:
    """Cluster rows of discordant alignments: bin pairs, mixture, cover, new numbers.

    The cover removes clusters that several pairs of bins give.
    """
    reach = int(mean + 10 * sd)
    near = rd.same_region(rows, reach)
    pairs = binned_pairs(rd.keep_ids(rows, near, "fragment", "fragment", invert=True), reach)
    found = cl.discordant_clusters(pairs, BIN_PAIR, mean, sd, settings.clustering_precision, settings.span_count_threshold)
    numbered = cl.renumbered(found, [*BIN_PAIR, "component"]).select(*BIN_PAIR, F.col("new_id").alias("cluster_id"), "fragment")
    covered = cl.set_cover(numbered.select("cluster_id", "fragment"), settings.span_count_threshold)
    kept = numbered.join(covered, ["cluster_id", "fragment"]).join(pairs, [*BIN_PAIR, "fragment"])
    end = lambda k: F.struct(F.lit(k).alias("cluster_end"), *[F.col(f"{c}{k}").alias(c) for c in ("read_end", "ref_name", "strand", "s", "e")])
    ends = kept.select("cluster_id", "fragment", F.explode(F.array(end(0), end(1))).alias("x"))
    ends = ends.select("cluster_id", "x.cluster_end", "fragment", "x.read_end", "x.ref_name", "x.strand", "x.s", "x.e")
    return cl.without_mixed_mt(ends, settings.mt_chromosome)


def split_tasks(regions: DataFrame, mean: float, sd: float, min_read: int, max_read: int) -> DataFrame:
    """Where the break of each region may lie, and the sequence window around it."""
    longest = int(mean + 3 * sd)
    size, plus = length(F.col("s"), F.col("e")), F.col("strand") == "+"
    rows = regions.withColumn("push", F.least(F.lit(max_read), F.floor(size / 2)))
    rows = rows.withColumn("break_length", F.lit(longest) - size - F.lit(min_read) + 2 * F.col("push"))
    rows = rows.withColumn("break_start", F.when(plus, F.col("e") - F.col("push") + 1).otherwise(F.col("s") + F.col("push") - 1))
    start = F.when(plus, F.col("break_start") - F.lit(max_read)).otherwise(F.col("break_start") - F.col("break_length") + 1)
    return rows.withColumn("window_start", start).withColumn("window_length", F.col("break_length") + F.lit(max_read)).drop("push")


def mate_regions(tasks: DataFrame, exons: DataFrame, mean: float, sd: float, min_read: int, max_read: int) -> DataFrame:
    """Where the mates of split reads may lie: cluster_id, cluster_end, ref_name, strand, s, e.

    tasks: rows of :func:`split_tasks`; a ref_name ``gene|transcript`` of exons is
    carried to the genome first. Besides the genomic region there is one for
    every transcript that overlaps it. exons: gene_id, transcript_id, chromosome,
    strand, s, e.
    """
    longest, shortest = int(mean + 3 * sd), int(mean - 3 * sd)
    keys = ["cluster_id", "cluster_end"]
    rows = tasks.select(*keys, "ref_name", "strand", F.col("break_start").cast("long").alias("pos"), (F.lit(shortest) - F.col("break_length") - max_read + 1).cast("long").alias("ext_min"), F.lit(longest - min_read).cast("long").alias("ext_max"))
    models = exons.groupBy("gene_id", "transcript_id", "chromosome", F.col("strand").alias("t_strand")).agg(F.min("s").alias("gs"), F.max("e").alias("ge"))
    named = F.concat_ws("|", "gene_id", "transcript_id")
    known = models.select(named.alias("ref_name"), "transcript_id", "t_strand")
    # a table's bytes say little of its exons, so nothing is broadcast
    rows = rows.join(known.hint("merge"), "ref_name", "left")
    at = rows.where("transcript_id IS NOT NULL").select("transcript_id", F.col("pos").alias("t_pos")).distinct()
    on = gm.to_genome(at, exons).withColumnsRenamed({"t_pos": "pos", "chromosome": "t_chromosome"})
    rows = rows.join(on.hint("merge"), ["transcript_id", "pos"], "left")
    strand = F.when(F.col("transcript_id").isNull(), F.col("strand")).otherwise(F.when(F.col("strand") == F.col("t_strand"), "+").otherwise("-"))
    rows = rows.select(*keys, F.coalesce("t_chromosome", "ref_name").alias("ref_name"), strand.alias("strand"), F.coalesce("g_pos", "pos").alias("pos"), "ext_min", "ext_max")
    plus = F.col("strand") == "+"
    rows = rows.withColumns({"s": F.when(plus, F.col("pos") - F.col("ext_max")).otherwise(F.col("pos") + F.col("ext_min")), "e": F.when(plus, F.col("pos") - F.col("ext_min")).otherwise(F.col("pos") + F.col("ext_max"))})
    found = ij.overlap_join(rows, models.drop("t_strand").hint("merge"), [("ref_name", "chromosome")], ("s", "e"), ("gs", "ge"), 10_000)
    other = lambda c: F.when(F.col(c) == "+", "-").otherwise("+")
    points = found.select(*keys, "transcript_id", named.alias("ref_name"), "pos", other("strand").alias("strand"), "ext_min", "ext_max")
    carried = gm.remap_extended(points, exons, [*keys, "ref_name"]).select(*keys, "ref_name", other("remap_strand").alias("strand"), F.col("ts").alias("s"), F.col("te").alias("e"))
    return rows.select(*keys, "ref_name", "strand", "s", "e").unionByName(carried)


def task_windows(tasks: DataFrame, references: DataFrame) -> DataFrame:
    """The window sequences; end 0 on the strand of its alignments, end 1 on the other.

    references: ref_name, seq, for transcripts and cut chromosomes.
    """
    rows = tasks.join(references, "ref_name").withColumn("window", window(F.col("seq"), F.col("window_start").cast("int"), F.col("window_length").cast("int")))
    turn = (F.col("strand") == "-") == (F.col("cluster_end") == 0)
    return rows.drop("seq").withColumn("window", F.when(turn, reverse_complement(F.col("window"))).otherwise(F.col("window")))


def predict_breaks(windows: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best split, junction sequence and break positions per cluster with split reads.

    candidates: cluster_id, fragment, read_end, read. Clusters without a split vanish.
    """
    side = lambda k: windows.where(F.col("cluster_end") == k).select("cluster_id", F.col("window").alias(f"ref{k + 1}"), F.col("strand").alias(f"strand{k}"), F.col("window_start").alias(f"ws{k}"), F.length("window").alias(f"wl{k}"))
    both = side(0).join(side(1), "cluster_id")
    reads = candidates.dropDuplicates(["cluster_id", "fragment", "read_end"]).join(both, "cluster_id").withColumnRenamed("cluster_id", "fusion_id")
    best = al.best_splits(al.split_reads(reads)).withColumnRenamed("fusion_id", "cluster_id").join(both, "cluster_id")
    first = fu.split_break(F.col("strand0"), F.col("ws0"), F.col("wl0"), F.col("ref_split1"), True)
    second = fu.split_break(F.when(F.col("strand1") == "+", "-").otherwise("+"), F.col("ws1"), F.col("wl1"), F.col("ref_split2"), False)
    none = F.lit("")
    return best.select("cluster_id", "split_count", "mean_left", "mean_right", al.junction_sequence(none, F.col("ref1"), F.col("ref_split1"), F.col("ref2"), F.col("ref_split2"), none).alias("sequence"), first.alias("break0"), second.alias("break1"))


def with_pvalues(spans: DataFrame, splits: DataFrame, mean: float, sd: float, cov: float, read_max: int, split_mean: float, split_cov: float) -> DataFrame:
    """Clusters with the p-values of their span lengths and of their split positions."""
    pos, least = fu.split_position(F.col("mean_left"), F.col("mean_right"))
    rows = splits.withColumns({"x": pos, "y": least}).join(spans, "cluster_id")
    return rows.withColumns({"splitr_span_pvalue": F.expr(st.span_pvalue_sql("mean_length", "n_fragments", mean, sd, cov, read_max)), "splitr_pos_pvalue": F.expr(st.split_pvalue_sql("x", "split_count", split_mean, split_cov, True)), "splitr_min_pvalue": F.expr(st.split_pvalue_sql("y", "split_count", split_mean, split_cov, False))}).drop("x", "y")


def classified(results: DataFrame, controls: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Results with probabilities, and those above the threshold."""
    scored = classify(results, controls, FEATURES, F.col("validated") == "Y")
    return scored, scored.where(F.col("probability") > settings.probability_threshold)


def supporting_reads(rows: DataFrame, members: DataFrame, regions: DataFrame) -> DataFrame:
    """Alignments of a cluster's fragments that overlap its region on its strand.

    members: cluster_id, fragment. regions: cluster_id, strand, rs, re.
    """
    wanted = members.join(regions.withColumnRenamed("strand", "region_strand"), "cluster_id")
    found = rows.drop("cluster_id").join(wanted, "fragment")
    return found.where((F.col("strand") == F.col("region_strand")) & overlaps(F.col("s"), F.col("e"), F.col("rs"), F.col("re")))
