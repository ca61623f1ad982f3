"""Exon tables and the maps between transcript and genome positions.

An exon table has one row per exon: transcript_id, chromosome, strand, s, e.
Positions are 1-based; a transcript runs along its strand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.intervals import point_join
from weftline.operators.tasks import dealt


def with_offsets(exons: DataFrame) -> DataFrame:
    """Exons with the transcript range that they cover: ts, te, and the whole length.

    Few bytes of a table can hold many exons, so joins with them are never broadcast.
    """
    along = Window.partitionBy("transcript_id").orderBy(F.when(F.col("strand") == "+", F.col("s")).otherwise(-F.col("s")))
    size = F.col("e") - F.col("s") + 1
    te = F.sum(size).over(along.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(size).over(Window.partitionBy("transcript_id"))
    return exons.withColumn("te", te).withColumn("ts", F.col("te") - size + 1).withColumn("t_length", total).hint("merge")


def exon_arrays(exons: DataFrame) -> DataFrame:
    """One row per transcript with its sorted exons."""
    return exons.groupBy("transcript_id", "chromosome", "strand").agg(F.sort_array(F.collect_list(F.struct(F.col("s").alias("start"), F.col("e").alias("end")))).alias("exons"))


def to_genome(positions: DataFrame, exons: DataFrame) -> DataFrame:
    """transcript_id, t_pos with the genomic position; beyond the ends it goes on linearly."""
    off = with_offsets(exons)
    inside = F.col("t_pos").between(F.col("ts"), F.col("te"))
    before = (F.col("ts") == 1) & (F.col("t_pos") < 1)
    after = (F.col("te") == F.col("t_length")) & (F.col("t_pos") > F.col("t_length"))
    at = F.when(F.col("strand") == "+", F.col("s") + F.col("t_pos") - F.col("ts")).otherwise(F.col("e") - (F.col("t_pos") - F.col("ts")))
    return positions.join(off, "transcript_id").where(inside | before | after).select("transcript_id", "t_pos", "chromosome", at.alias("g_pos"))


def to_transcript(positions: DataFrame, exons: DataFrame, strict: bool = False) -> DataFrame:
    """transcript_id, g_pos with the transcript position.

    Intronic positions go to the start of the next exon along the strand and
    those past the end to the length, or are left out if ``strict``.
    """
    off = with_offsets(exons)
    joined = positions.join(off, "transcript_id")
    exact = F.when(F.col("strand") == "+", F.col("g_pos") - F.col("s") + F.col("ts")).otherwise(F.col("e") - F.col("g_pos") + F.col("ts"))
    held = F.col("g_pos").between(F.col("s"), F.col("e"))
    if strict:
        return joined.where(held).select("transcript_id", "g_pos", exact.alias("t_pos"))
    ahead = F.when(F.col("strand") == "+", F.col("s") > F.col("g_pos")).otherwise(F.col("e") < F.col("g_pos"))
    best = F.min(F.when(held, exact).when(ahead, F.col("ts")))
    return joined.groupBy("transcript_id", "g_pos").agg(F.coalesce(best, F.max("t_length")).alias("t_pos"))


def region_to_genome(regions: DataFrame, exons: DataFrame) -> DataFrame:
    """transcript_id, rs, re with the genomic pieces, one per exon touched."""
    off = with_offsets(exons)
    lo, hi = F.greatest("rs", "ts"), F.least("re", "te")
    pieces = regions.join(off, "transcript_id").where(lo <= hi)
    plus = F.col("strand") == "+"
    start = F.when(plus, F.col("s") + lo - F.col("ts")).otherwise(F.col("e") - (hi - F.col("ts")))
    end = F.when(plus, F.col("s") + hi - F.col("ts")).otherwise(F.col("e") - (lo - F.col("ts")))
    return pieces.select("transcript_id", "rs", "re", "chromosome", start.alias("gs"), end.alias("ge"))


def exon_position(positions: DataFrame, exons: DataFrame) -> DataFrame:
    """transcript_id, exon_no (from 0 by start), x_pos (from 1 along the strand) on the genome."""
    number = F.row_number().over(Window.partitionBy("transcript_id").orderBy("s")) - 1
    at = F.when(F.col("strand") == "+", F.col("s") + F.col("x_pos") - 1).otherwise(F.col("e") - F.col("x_pos") + 1)
    return positions.join(exons.withColumn("exon_no", number).hint("merge"), ["transcript_id", "exon_no"]).select("transcript_id", "exon_no", "x_pos", at.alias("g_pos"))


def remap_extended(points: DataFrame, exons: DataFrame, keys: list[str]) -> DataFrame:
    """Windows around genomic points, on transcripts: keys, transcript_id, remap_strand, ts, te.

    points: keys, transcript_id, pos, strand, ext_min, ext_max. Along the point's
    strand the window reaches from ext_min to ext_max beyond the point's exon, or
    the next one's start; it begins at that exon at the earliest. Points beyond
    the last exon and windows outside the transcript are left out.
    """
    size = F.col("e") - F.col("s") + 1
    ahead = lambda first: Window.partitionBy("transcript_id").orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    sized = dealt(exons, "transcript_id").select("transcript_id", F.col("strand").alias("t_strand"), "s", "e", F.coalesce(F.sum(size).over(ahead("s")), F.lit(0)).alias("before_plus"), F.coalesce(F.sum(size).over(ahead(F.desc("e"))), F.lit(0)).alias("before_minus"), F.sum(size).over(Window.partitionBy("transcript_id")).alias("t_length"))
    plus = F.col("strand") == "+"
    at, first, last = F.when(plus, F.col("pos")).otherwise(-F.col("pos")), F.when(plus, F.col("s")).otherwise(-F.col("e")), F.when(plus, F.col("e")).otherwise(-F.col("s"))
    before = F.when(plus, F.col("before_plus")).otherwise(F.col("before_minus"))
    held = dealt(points, "transcript_id").join(sized.hint("merge"), "transcript_id").where(at <= last)
    own = [*keys, "transcript_id", "pos", "strand", "ext_min", "ext_max"]
    near = held.groupBy(*own).agg(F.min(F.struct(first.alias("first"), before.alias("before"), "t_strand", "t_length")).alias("x")).select(*own, "x.*")
    shift = F.when(F.col("strand") == "+", F.col("pos")).otherwise(-F.col("pos")) - F.col("first") + 1
    edge = lambda ext: F.greatest(shift + F.col(ext), F.lit(1)) + F.col("before")
    near = near.where(shift + F.col("ext_max") >= 1).withColumns({"lo": edge("ext_min"), "hi": edge("ext_max")}).where("lo <= t_length")
    same = F.col("strand") == F.col("t_strand")
    turned = lambda c: F.col("t_length") - F.col(c) + 1
    return near.select(*keys, "transcript_id", remapped_strand(F.col("strand"), F.col("t_strand")).alias("remap_strand"), F.when(same, F.col("lo")).otherwise(turned("hi")).alias("ts"), F.when(same, F.col("hi")).otherwise(turned("lo")).alias("te"))


def unspliced(genes: DataFrame, bases: DataFrame) -> DataFrame:
    """Whole gene regions as sequences along their strands: gene_id, sequence. genes: gene_id, chromosome, strand, gs, ge."""
    whole = genes.select(F.col("gene_id").alias("transcript_id"), "chromosome", "strand", F.col("gs").alias("s"), F.col("ge").alias("e"))
    return spliced(whole, bases).withColumnRenamed("transcript_id", "gene_id")


def remapped_strand(strand: Column, model: Column) -> Column:
    return F.when(strand == model, "+").otherwise("-")


def gene_regions(exons: DataFrame) -> DataFrame:
    return exons.groupBy("gene_id", "chromosome", "strand").agg(F.min("s").alias("gs"), F.max("e").alias("ge"), F.count("*").alias("n_exons"))


def utrs(exons: DataFrame, cds: DataFrame) -> DataFrame:
    """Exon parts outside the coding range; the side follows the strand."""
    span = cds.groupBy("transcript_id").agg(F.min("s").alias("cs"), F.max("e").alias("ce"))
    rows = exons.join(span.hint("merge"), "transcript_id")
    left = rows.where("s < cs").select("transcript_id", "chromosome", "s", F.least(F.col("e"), F.col("cs") - 1).alias("e"), F.when(F.col("strand") == "+", "utr5p").otherwise("utr3p").alias("side"))
    right = rows.where("e > ce").select("transcript_id", "chromosome", F.greatest(F.col("s"), F.col("ce") + 1).alias("s"), "e", F.when(F.col("strand") == "+", "utr3p").otherwise("utr5p").alias("side"))
    return left.unionByName(right)


def gene_locations(points: DataFrame, genes: DataFrame, parts: DataFrame, size: int = 10_000) -> DataFrame:
    """Class of each point in its gene: coding, utr5p, utr3p, intron, upstream, downstream.

    points: gene_id, pos. genes: gene_id, strand, gs, ge. parts: gene_id, side, ps, pe.
    """
    wanted = points.select("gene_id", "pos").distinct()
    own = parts.select(F.col("gene_id").alias("__gene"), "side", "ps", "pe")
    hits = point_join(wanted, own, [("gene_id", "__gene")], "pos", ("ps", "pe"), size)
    rank = F.when(F.col("side") == "coding", 0).when(F.col("side") == "utr5p", 1).otherwise(2)
    best = hits.groupBy("gene_id", "pos").agg(F.min(rank).alias("rank"))
    plus = F.col("strand") == "+"
    named = F.when(F.col("pos") < F.col("gs"), F.when(plus, "upstream").otherwise("downstream")).when(F.col("pos") > F.col("ge"), F.when(plus, "downstream").otherwise("upstream"))
    inside = F.when(F.col("rank") == 0, "coding").when(F.col("rank") == 1, "utr5p").when(F.col("rank") == 2, "utr3p").otherwise("intron")
    named = F.coalesce(named, inside)
    return wanted.join(genes.hint("merge"), "gene_id").join(best.hint("merge"), ["gene_id", "pos"], "left").select("gene_id", "pos", named.alias("location"))


def spliced(exons: DataFrame, bases: DataFrame, tail: int = 0) -> DataFrame:
    """Transcript sequences: exon windows of the chromosomes, joined along the strand.

    bases: chromosome, chunk (from 0), chunk_size, seq. An exon takes its piece
    from each chunk that it touches, so no chromosome is one string.
    """
    size = F.col("chunk_size")
    cut = exons.join(bases, "chromosome").where((F.col("s") <= (F.col("chunk") + 1) * size) & (F.col("e") > F.col("chunk") * size))
    lo = F.greatest(F.col("s") - F.col("chunk") * size, F.lit(1))
    hi = F.least(F.col("e") - F.col("chunk") * size, size)
    pieces = cut.withColumn("piece", F.substring(F.col("seq"), lo.cast("int"), (hi - lo + 1).cast("int")))
    whole = pieces.groupBy("transcript_id", "strand").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s", "chunk", "piece"))), lambda x: x["piece"]), "").alias("seq"))
    seq = F.when(F.col("strand") == "+", F.col("seq")).otherwise(F.reverse(F.translate("seq", "ACGTacgt", "TGCAtgca")))
    return whole.select("transcript_id", F.concat(seq, F.repeat(F.lit("A"), F.lit(tail))).alias("sequence"))
