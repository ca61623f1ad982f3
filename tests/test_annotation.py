"""The annotation job on a planted junction."""

import pytest
from pyspark.sql import functions as F

from weftline.operators import reads as rd
from weftline.plans import annotation as an
from weftline.plans.pipeline import build_reference

GTF = "feature string, gene_id string, transcript_id string, chromosome string, strand string, s int, e int"


@pytest.fixture(scope="module")
def reference(spark):
    rows = [("exon", "g1", "t1", "1", "+", 101, 200), ("exon", "g1", "t1", "1", "+", 301, 400), ("CDS", "g1", "t1", "1", "+", 151, 200), ("exon", "g2", "t2", "2", "-", 1001, 1100), ("CDS", "g2", "t2", "2", "-", 1001, 1050), ("exon", "g3", "t3", "1", "+", 450, 500), ("CDS", "g3", "t3", "1", "+", 450, 500)]
    models = spark.createDataFrame(rows, GTF)
    return build_reference(models), models.where("feature = 'CDS'")


def test_annotate(spark, reference):
    ref, coding = reference
    breaks = spark.createDataFrame([(1, 0, "g1|t1", "+", 150), (1, 1, "2", "-", 1060), (2, 0, "1", "+", 180), (2, 1, "1", "-", 470)], "cluster_id long, cluster_end int, ref_name string, strand string, break_pos int")
    members = spark.createDataFrame([(c, k, f, "1" if c == 2 or k == 0 else "2", s + f, s + f + 49) for c in (1, 2) for f in range(6) for k, s in ((0, 100), (1, 460))], "cluster_id long, cluster_end int, fragment long, ref_name string, s long, e long")
    junctions = spark.createDataFrame([(1, "ACGTACGTAG|GTACCATGCA"), (2, "A" * 30 + "|" + "C" * 30)], "cluster_id long, sequence string")
    hits = spark.createDataFrame([(1, 18, 20, 0, 1, 12), (1, 19, 20, 0, 8, 20), (2, 30, 60, 5000, 1, 30)], "cluster_id long, matches int, q_size int, t_gap_bases int, q_start int, q_end int")
    counts = rd.alignment_counts(members.select("fragment", F.col("cluster_end").alias("read_end"), "ref_name", "s", "e"), ["fragment", "read_end"])
    expression = spark.createDataFrame([("g1", 7.5)], "gene string, expression double")
    repeats = spark.createDataFrame([("1", 110, 119, "L")], "chromosome string, s long, e long, type string")
    rows = {r.cluster_id: r for r in an.annotate(breaks, members, junctions, ref, coding, {"genome": hits, "cdna": hits.limit(0)}, expression, counts, repeats, 250.0, 50, "lib").collect()}
    one, two = rows[1], rows[2]
    assert (one.gene1, one.transcript1, one.genomic_break_pos1, one.genomic_strand1, one.gene_location1) == ("g1", "t1", 350, "+", "utr3p")
    assert (one.gene2, one.genomic_break_pos2, one.gene_align_strand2, one.gene_location2) == ("g2", 1060, "+", "utr5p")
    assert one.interchromosomal and not one.inversion and not one.adjacent
    assert (two.gene1, two.gene2, two.adjacent, two.deletion, two.read_through) == ("g1", "g3", True, True, True)
    assert (two.gene_location1, two.gene_location2) == ("coding", "coding")
    assert (one.span_count, one.expression1, one.expression2, one.num_splice_variants) == (6, 7.5, 0.0, 1)
    assert one.span_coverage1 == pytest.approx(55 / 200)
    assert one.repeat_proportion1 == pytest.approx(10 / 55) and one.max_repeat_proportion == pytest.approx(10 / 55)
    assert one.genome_breakseqs_percident == pytest.approx(0.9) and two.genome_breakseqs_percident == 0.0
    assert one.altsplice and not two.altsplice and one.breakpoint_homology == 5
    assert one.splice_score == 4 and two.break_adj_entropy1 == pytest.approx(two.break_adj_entropy2)
    assert one.mean_map_count >= 1 and one.library_name == "lib"


def test_counts_around_breaks(spark, reference):
    ref, _ = reference
    breaks = spark.createDataFrame([(1, 0, "g1", 320, "t", 50)], "cluster_id long, cluster_end int, gene_id string, pos int, ref_name string, break_pos int")
    pairs = spark.createDataFrame([("g1", "t", 10, 90), ("g1", "t", 45, 90), ("g1", "t", 330, 339)], "gene_id string, ref_name string, s int, e int")
    assert an.break_concordant(breaks, pairs).first().n_concordant == 1
    r = an.interrupted(breaks, ref.exons, pairs).first()
    assert (r.size_before, r.size_after, r.count_before, r.count_after) == (119, 80, 127, 10)
    assert r.interrupted_index == pytest.approx((127 / 120 + 1) / (10 / 81 + 1))


def test_est_islands(spark):
    hits = spark.createDataFrame([(1, 9, 10, "1", 100, 200), (1, 10, 10, "1", 100, 900), (2, 9, 10, "2", 1, 2)], "cluster_id long, matches int, q_size int, t_name string, t_start int, t_end int")
    islands = spark.createDataFrame([("1", 390, 450), ("1", 300, 400)], "chromosome string, s int, e int")
    assert {r.cluster_id: r.pid for r in an.est_identity(hits, islands).collect()} == {1: 0.9}
