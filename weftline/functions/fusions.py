"""Measures of a candidate junction, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def homology(left_end: Column, right_start: Column) -> Column:
    """Bases of the junction that both sides explain."""
    return F.greatest(left_end - right_start + 1, F.lit(0))


def adjusted_identity(pid: Column, size: Column, len1: Column, len2: Column) -> Column:
    """Identity scaled to the shorter side, not below 0."""
    return F.greatest(F.lit(0.0), 1 - (1 - pid) * size / F.least(len1, len2))


def event_flags(chr1: Column, chr2: Column, strand1: Column, strand2: Column, pos1: Column, pos2: Column, adjacent: Column) -> dict[str, Column]:
    """Booleans per kind of rearrangement."""
    same = chr1 == chr2
    inversion = same & (strand1 == strand2)
    first, second = F.when(pos1 < pos2, strand1).otherwise(strand2), F.when(pos1 < pos2, strand2).otherwise(strand1)
    eversion = same & ~inversion & (first == "-") & (second == "+")
    deletion = same & ~inversion & ~eversion
    return {"interchromosomal": ~same, "inversion": inversion, "eversion": eversion, "deletion": deletion, "read_through": deletion & adjacent}


def in_frame(q1: Column, q2: Column, t1: Column, t2: Column) -> Column:
    return F.pmod(q1 - q2, F.lit(3)) == F.pmod(t1 - t2, F.lit(3))


def index_ratio(count_before: Column, size_before: Column, count_after: Column, size_after: Column) -> Column:
    """Reads per base before a break against after it, both smoothed by one."""
    return (count_before / (size_before + 1) + 1) / (count_after / (size_after + 1) + 1)


def splicing_index(concordant: Column, span: Column) -> Column:
    return F.when(span > 0, concordant / span)


def fusion_region(strand: Column, s: Column, e: Column, break_pos: Column) -> tuple[Column, Column]:
    """An aligned region extended to its break, on the side where the break lies."""
    plus = strand == "+"
    return F.when(plus, s).otherwise(F.least(s, break_pos)), F.when(plus, F.greatest(e, break_pos)).otherwise(e)


def break_region(strand: Column, s: Column, e: Column, mean: float, sd: float) -> tuple[Column, Column]:
    """Where the break beyond a cluster's region must lie, in strand space."""
    top = F.when(strand == "+", e).otherwise(-s)
    low = F.when(strand == "+", s).otherwise(-e)
    return top + 1, 2 * (top + 1) - (top - low + 1) - 1 - 2 + F.lit(int(mean + 3 * sd))


def split_position(left: Column, right: Column, anchor: int = 4) -> tuple[Column, Column]:
    """Where a read is split, from 0 to 1, and the relative size of its smaller part."""
    free = left + right - 2 * anchor
    pos = F.greatest(left - anchor, F.lit(0)) / free
    return F.when(free > 0, pos), F.when(free > 0, F.greatest(F.least(left, right) - anchor, F.lit(0)) / F.floor(free / 2))


def implied_length(strand: Column, s: Column, e: Column, break_pos: Column) -> Column:
    """Bases from a read's far end to the break."""
    return F.when(strand == "+", break_pos - s + 1).otherwise(e - break_pos + 1)


def split_break(strand: Column, seq_start: Column, seq_len: Column, s: Column, first: bool) -> Column:
    """Genomic break of a split position in a window sequence, per side and strand."""
    if first:
        return F.when(strand == "+", seq_start + s - 1).otherwise(seq_start + seq_len - s)
    return F.when(strand == "+", seq_start + s + 1).otherwise(seq_start + seq_len - s - 2)


def exon_boundaries(blocks: DataFrame) -> DataFrame:
    """The first pair of exon blocks of a junction that meet at exon boundaries, per cluster that has one.

    blocks: cluster_id, side (1 or 2, the gene), block (order in its side),
    target, strand, q_start, q_end, t_start, t_end, t_size. A block that ends
    right before a block of the other side starts must reach the end of its exon
    along its strand, and the other the start of its own. Gives cluster_id,
    target1, pos1, target2, pos2: the exon positions that override the break.
    """
    plus = F.col("strand") == "+"
    leaves, enters = F.when(plus, F.col("t_size")).otherwise(F.lit(1)), F.when(plus, F.lit(1)).otherwise(F.col("t_size"))
    out = blocks.where(F.when(plus, F.col("t_end")).otherwise(F.col("t_start")) == leaves)
    into = blocks.where(F.when(plus, F.col("t_start")).otherwise(F.col("t_end")) == enters)
    out = out.select("cluster_id", "side", (F.col("q_end") + 1).alias("at"), F.struct("block", "target", leaves.cast("long").alias("pos")).alias("a"))
    into = into.select("cluster_id", (3 - F.col("side")).alias("side"), F.col("q_start").alias("at"), F.struct("block", "target", enters.cast("long").alias("pos")).alias("b"))
    met = out.join(into, ["cluster_id", "side", "at"])
    first, second = F.when(F.col("side") == 1, F.col("a")).otherwise(F.col("b")), F.when(F.col("side") == 1, F.col("b")).otherwise(F.col("a"))
    best = met.groupBy("cluster_id").agg(F.min(F.struct(first["block"].alias("k1"), second["block"].alias("k2"), first.alias("one"), second.alias("two"))).alias("x"))
    return best.select("cluster_id", F.col("x.one.target").alias("target1"), F.col("x.one.pos").alias("pos1"), F.col("x.two.target").alias("target2"), F.col("x.two.pos").alias("pos2"))
