"""Unit tests of operators, kernels, readers and jobs on small inputs."""

import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from weftline.functions import fusions as fu
from weftline.functions import sequences as sq
from weftline.functions import stats as st
from weftline.operators import alignment as al
from weftline.operators import classify as cy
from weftline.operators import clusters as cl
from weftline.operators import genemodels as gm
from weftline.operators import intervals as ij
from weftline.operators import reads as rd
from weftline.operators import results as rs
from weftline.operators.graphs import components
from weftline.plans import pipeline
from weftline.plans.registry import QUERIES
from weftline.sources import adapters as ad
from weftline.sources import config, formats, readers, sinks


def spans(spark, rows, names="k string, s int, e int, id int"):
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def random_spans(spark):
    rng = random.Random(1)
    make = lambda n: [(rng.choice("ab"), s := rng.randint(0, 900), s + rng.randint(0, 80), i) for i in range(n)]
    return make(150), make(120)


def test_interval_joins_against_brute_force(spark, random_spans):
    left, right = random_spans
    a, b = spans(spark, left), spans(spark, right, "rk string, rs int, re int, rid int")
    got = {(r.id, r.rid) for r in ij.overlap_join(a, b, [("k", "rk")], ("s", "e"), ("rs", "re"), 37).collect()}
    assert got == {(x[3], y[3]) for x in left for y in right if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2]}
    got = ij.overlap_join(a, b, [("k", "rk")], ("s", "e"), ("rs", "re"), 37, how="within", slack=9).select("id", "rid").collect()
    want = [(x[3], y[3]) for x in left for y in right if x[0] == y[0] and x[1] >= y[1] - 9 and x[2] <= y[2] + 9]
    assert sorted(map(tuple, got)) == sorted(want)
    got = ij.point_join(a, b, [("k", "rk")], "s", ("rs", "re"), 50).select("id", "rid").collect()
    assert sorted(map(tuple, got)) == sorted((x[3], y[3]) for x in left for y in right if x[0] == y[0] and y[1] <= x[1] <= y[2])


def test_nearest_against_brute_force(spark, random_spans):
    left, right = random_spans
    points = spans(spark, left).select("k", "s")
    genes = spans(spark, right, "k string, rs int, re int, rid int")
    got = {(r.k, r.s): (r.distance, r.rid) for r in ij.nearest(points, genes, "k", "s", "rid", ("rs", "re"), 40).collect()}
    for k, s in {(x[0], x[1]) for x in left}:
        assert got[k, s] == min((max(0, y[1] - s, s - y[2]), y[3]) for y in right if y[0] == k)


def test_nearest_across_ranges(spark, random_spans):
    points, genes = random_spans
    df = spans(spark, points).select("k", "s")
    own = spans(spark, genes, "k string, gs int, ge int, g int")
    rows = lambda **o: sorted(map(tuple, ij.nearest(df, own, "k", "s", "g", ("gs", "ge"), 50, **o).collect()))
    assert rows(width=7) == rows(width=100_000)


def test_tasks_follow_the_size(spark, monkeypatch):
    from weftline.operators import tasks

    rows = ad.aln(spark, SMALL)
    assert tasks.task_count(rows) == 4
    monkeypatch.setattr(tasks, "TASK_BYTES", 1000)
    assert tasks.task_count(rows) > 100
    for made in (rd.alignment_counts(rows, ["fragment", "read_end"]), rd.bin_pairs(rows, 2048, 0, 3), cl.dedupe_positions(rows.withColumn("cluster_end", F.col("read_end"))), QUERIES["chr_pairs"](spark, SMALL)):
        assert f", {tasks.task_count(rows)}), REPARTITION_BY_NUM" in made._jdf.queryExecution().executedPlan().toString()
    for name in ("fusion_candidates", "remap_extended"):
        assert "REPARTITION_BY_NUM" in QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_joins_with_exons_are_not_broadcast(spark):
    assert "BroadcastHashJoin" not in QUERIES["mate_regions"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_islands_and_depth(spark, random_spans):
    rows = random_spans[0]
    merged = ij.islands(spans(spark, rows), ["k"]).collect()
    covered = {(x[0], p) for x in rows for p in range(x[1], x[2] + 1)}
    assert {(r.k, p) for r in merged for p in range(r.s, r.e + 1)} == covered
    assert sum(r.e - r.s + 1 for r in merged) == len(covered)
    depth = {}
    for x in rows:
        for p in range(x[1], x[2] + 1):
            depth[x[0], p] = depth.get((x[0], p), 0) + 1
    assert {(r.k, p): r.depth for r in ij.depth(spans(spark, rows), ["k"]).collect() for p in range(r.s, r.e + 1)} == depth


def test_backward_interval_is_ignored(spark):
    a, b = spans(spark, [("a", 10, 5, 1)]), spans(spark, [("a", 0, 50, 2)], "rk string, rs int, re int, rid int")
    assert ij.overlap_join(a, b, [("k", "rk")], ("s", "e"), ("rs", "re"), 10).count() == 0


def test_normal_functions(spark):
    xs = [x / 7 for x in range(-63, 64)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", st.normal_cdf("x").alias("p")).collect()
    assert max(abs(r.p - 0.5 * math.erfc(-r.x / math.sqrt(2))) for r in rows) < 1e-14
    assert st.normal_quantile(0.025) == pytest.approx(-1.959963984540054)
    p = spark.range(1).select(F.expr(st.span_pvalue_sql("cast(210 as double)", "9", 200.0, 30.0, 100.0, 95)).alias("p")).first().p
    assert p == pytest.approx(2 * NormalDist().cdf(-10 / math.sqrt(900 / 9 + 8 * 100 / 9)))


def test_sequence_functions(spark):
    rows = spark.createDataFrame([("AACCGGTTN", "AAAA|CCCC")], "s string, j string")
    left, right = sq.junction_context(F.col("j"), 3)
    r = rows.select(sq.reverse_complement(F.col("s")).alias("rc"), sq.hamming(F.lit("GTAG"), F.lit("GAAC")).alias("h"), left.alias("l"), right.alias("r"), sq.window(F.col("s"), F.lit(-1), F.lit(5), pad=True).alias("w"), sq.pair_entropy(F.lit("AAAA")).alias("e")).first()
    assert (r.rc, r.h, r.l, r.r, r.w) == ("NAACCGGTT", 2, "AAA", "CCC", "NNAAC")
    assert r.e == pytest.approx(-(2 / 3) * math.log2(2 / 3))  # non-overlapping count, divided by length - 1


def test_garbage_test_computes_its_text_once(spark):
    rows = spark.range(1).selectExpr("regexp_replace('AACGTxx', '[^ACGT]+', '') AS s", "id").select(F.concat("s", F.col("id").cast("string")).alias("s"))
    kept = rows.where(~sq.is_garbage(F.col("s"), 0.4, 0.5))
    assert [r.s for r in kept.collect()] == ["AACGT0"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(") <= 2
    texts = [("",), (None,), ("ACGT" * 5,), ("A" * 11 + "CGT" * 3,), ("ACGTNNNNNNNNACGTACGT",)]
    found = spark.createDataFrame(texts, "s string").select("s", sq.is_garbage(F.col("s"), 0.5, 0.3).alias("bad")).collect()
    assert [r.bad for r in found] == [False, None, False, True, True]


def test_mate_and_expression_filters_reject(spark):
    rows = spark.createDataFrame([("x", 0)], "qname string, flag int")
    with pytest.raises(Exception, match="neither"):
        rd.mate(rows, 1).collect()
    for test in ("> 1; drop", "like 'a'", "> flag", "> 1 or true"):
        with pytest.raises(ValueError):
            rd.expression_filter(rows, "flag", test)
    assert rd.expression_filter(rows, "qname", "== 'x'").count() == 1


def test_merge_read_stats(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.randint(-300, 300), rng.randint(30, 50)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, z int, len int")
    n = F.abs("z")
    parts = df.groupBy("k").agg(F.count("*").alias("frag_count"), F.avg(n).alias("fraglength_mean"), F.stddev_pop(n).alias("fraglength_stddev"), F.min("len").alias("readlength_min"), F.max("len").alias("readlength_max"))
    empty = parts.limit(1).select(F.lit("z").alias("k"), F.lit(0).cast("long").alias("frag_count"), F.lit(None).cast("double").alias("fraglength_mean"), F.lit(None).cast("double").alias("fraglength_stddev"), F.lit(None).cast("int").alias("readlength_min"), F.lit(None).cast("int").alias("readlength_max"))
    got, want = rd.merge_read_stats(parts.unionByName(empty)).first(), rd.read_stats(df, "z", "len").first()
    assert list(got) == pytest.approx(list(want))


# --- clustering ----------------------------------------------------------------------------


def test_mixture_step_is_the_maximum():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(1, 9))
        model = cl.PairModel(rng.integers(0, 400, n), rng.integers(0, 400, n), rng.integers(0, 300, n), float(rng.uniform(5, 60)))
        r = rng.random(n)
        value = lambda a, b: float((r * model.log_density(np.array([a]), np.array([b]))[0]).sum())  # noqa: B023, E731
        a, b = model.best_point(r)
        best = value(a, b)
        for da in np.linspace(-60, 60, 25):
            for db in np.linspace(-60, 60, 25):
                assert value(a + da, b + db) <= best + 1e-6


def test_mixture_likelihood_rises_and_groups_are_found():
    rng = np.random.default_rng(2)
    centres = [(1000, 5000), (1600, 5900)]
    x, y = (np.concatenate([c[i] - rng.integers(0, 120, 20) for c in centres]) for i in (0, 1))
    u = np.concatenate([np.full(20, sum(c)) for c in centres]) - x - y + rng.normal(0, 15, 40)
    for k in (1, 2, 3):
        trace = cl.PairModel(x, y, u, 30.0).fit(k)[3]
        assert all(b >= a - 1e-6 for a, b in zip(trace, trace[1:], strict=False))
    found = cl.cluster_pairs(x, y, u, 240.0, 30.0, 0.99, 5)
    assert any(set(m) >= set(range(5, 15)) and not set(m) & set(range(20, 40)) for m in found)


def test_groups_fitted_together_agree_to_the_last_bit(spark):
    rng = np.random.default_rng(12)
    groups = []
    for n in (5, 6, 9, 15, 23, 70):
        for spread in (3000, 33000):
            x, y = rng.integers(0, spread, n), rng.integers(-spread, 0, n)
            x[1], y[1] = x[0], y[0]
            groups.append((x, y, 3000.0 - rng.integers(2, 100, n)))
    for n, k in ((6, 1), (6, 3), (6, 6), (9, 4)):
        some = [g for g in groups if len(g[0]) == n]
        a, b, last = cl.PairModels(*(np.stack([g[i].astype(float) for g in some]) for i in range(3)), 1000.0).fit(k)
        for i, g in enumerate(some):
            own = cl.PairModel(*g, 1000.0).fit(k)
            assert a[i].tolist() == own[0].tolist() and b[i].tolist() == own[1].tolist() and last[i] == own[3][-1]
    found = cl.cluster_groups(groups, 3000.0, 1000.0, 0.95, 5)
    want = [cl.cluster_pairs(*g, 3000.0, 1000.0, 0.95, 5) for g in groups]
    assert [[m.tolist() for m in f] for f in found] == [[m.tolist() for m in w] for w in want] and any(want)


def test_set_cover(spark):
    rng = random.Random(3)
    rows = list({(c, rng.randrange(60) + 100 * (c % 2)) for c in range(14) for _ in range(rng.randint(1, 25))})
    got = [tuple(r) for r in cl.set_cover(spark.createDataFrame(rows, "cluster_id long, fragment long")).collect()]
    sets, want = {}, []
    for c, f in rows:
        sets.setdefault(c, set()).add(f)
    while any(sets.values()):
        c = min(sets, key=lambda c: (-len(sets[c]), c))
        claimed = set(sets[c])
        want += [(c, f) for f in claimed]
        for s in sets.values():
            s -= claimed
    assert sorted(got) == sorted(want)
    assert len({f for _, f in got}) == len(got)


def test_greedy_cover_in_pieces():
    rng = random.Random(15)
    pairs = sorted({(rng.randrange(200), rng.randrange(30)) for _ in range(900)})
    column = lambda part, i: np.array([p[i] for p in part])
    take = lambda step, most: [(int(c), int(f)) for a, b in cl.greedy_cover([(column(pairs[k : k + step], 1), column(pairs[k : k + step], 0)) for k in range(0, len(pairs), step)], 1, most) for c, f in zip(a, b, strict=True)]
    sets, want = {}, []
    for f, c in pairs:
        sets.setdefault(c, set()).add(f)
    while any(sets.values()):
        c = min(sets, key=lambda c: (-len(sets[c]), c))
        claimed = set(sets[c])
        want += [(c, f) for f in sorted(claimed)]
        for x in sets.values():
            x -= claimed
    assert take(1000, 1 << 20) == take(7, 5) == want


def test_components_and_linkage(spark):
    edges = [(1, 2), (2, 3), (10, 11), (i := 20, i + 1), (21, 22), (22, 20)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 20: 20, 21: 20, 22: 20}
    d = np.abs(np.subtract.outer([0, 1, 10, 11, 30], [0, 1, 10, 11, 30])).astype(float)
    assert sorted(cl.linkage(d, 5)) == [[0, 1], [2, 3], [4]]


def test_linkage_without_a_matrix(spark):
    rng = np.random.default_rng(13)
    for case in range(12):
        x = rng.normal(size=(int(rng.integers(1, 60)), 1 + case % 4))
        x[len(x) // 2 :] = x[: len(x) - len(x) // 2] + 0.01 * (case % 2) * rng.normal(size=(len(x) - len(x) // 2, x.shape[1]))
        threshold = float(rng.uniform(0.05, 3))
        want = np.zeros(len(x), int)
        for group in cl.linkage(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), threshold):
            want[group] = group[0]
        for block in (1 << 21, 40):
            assert cl.vector_linkage(x, threshold, block).tolist() == want.tolist()
    # all differences of these at once would be 8 GB
    x = rng.normal(size=(4000, 64))
    assert len(cl.vector_linkage(x / np.linalg.norm(x, axis=1)[:, None], 1.2)) == 4000


def test_mito_and_regions(spark):
    rows = [(1, 0, 5, "MT", "+", 1, 9), (1, 1, 5, "1", "-", 3, 8), (2, 0, 6, "1", "+", 1, 9), (2, 1, 6, "2", "+", 2, 4), (3, 0, 7, "MT", "+", 1, 2), (3, 1, 7, "MT", "+", 5, 6), (4, 0, 8, "1", "+", 1, 2)]
    df = spark.createDataFrame(rows, "cluster_id long, cluster_end int, fragment long, ref_name string, strand string, s int, e int")
    assert {r.cluster_id for r in cl.without_mixed_mt(df).collect()} == {2, 3, 4}
    assert {r.cluster_id for r in cl.regions(df).collect()} == {1, 2, 3}


# --- alignment -----------------------------------------------------------------------------


def plain_matrix(read, ref, s):
    m = [[0] * (len(ref) + 1) for _ in range(len(read) + 1)]
    for j in range(1, len(read) + 1):
        m[j][0] = j * s.gap
        for i in range(1, len(ref) + 1):
            m[j][i] = max(m[j - 1][i - 1] + (s.match if read[j - 1] == ref[i - 1] else s.mismatch), m[j - 1][i] + s.gap, m[j][i - 1] + s.gap)
    return m


def test_alignment_matrix_and_splits():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ("".join(rng.choice("ACGT") for _ in range(rng.randint(0, 14))) for _ in range(2))
        assert al.score_matrix(a, b, al.LOCAL).tolist() == plain_matrix(a, b, al.LOCAL)
    ref1, ref2 = "TTTTTACGTACGGA", "CCATGCATGGTTTT"
    read = ref1[3:14] + ref2[2:12]
    found = al.split_alignments(read, ref1, ref2)
    assert (14, 1, 11, 10, 20) in found
    assert all(x[2] + x[3] == len(read) for x in found)
    assert al.split_alignments("A" * 20, "C" * 30, "G" * 30) == []
    assert "|" in al.render(read, 11, ref1, ref2, 14, 1)


def test_very_many_tied_splits(spark):
    rng = random.Random(14)

    def plain(read, ref1, ref2):
        n, left, right = len(read), plain_matrix(read, ref1, al.Scores()), plain_matrix(read[::-1], ref2[::-1], al.Scores())
        best = [(max(left[j]), max(right[n - j])) for j in range(n + 1)]
        total = [sum(v for v in b if v >= 8) for b in best]
        if max(total) < int(0.9 * 2 * n):
            return []
        found = {}
        for j in (j for j in range(n + 1) if total[j] == max(total) and min(best[j]) >= 8):
            for i1 in (i for i, v in enumerate(left[j]) if v == best[j][0]):
                for i2 in (i for i, v in enumerate(right[n - j]) if v == best[j][1]):
                    found.setdefault((i1, len(ref2) - i2 - 1), (i1, len(ref2) - i2 - 1, j, n - j, min(best[j])))
        return [found[k] for k in sorted(found)]

    several = 0
    for _ in range(40):
        unit = "".join(rng.choice("AC") for _ in range(rng.randint(1, 4)))
        ref1, ref2 = (unit * rng.randint(4, 9) + "".join(rng.choice("AG") for _ in range(rng.randint(0, 5))) for _ in range(2))
        read = unit * 6
        want = plain(read, ref1, ref2)
        several += len({x[2] for x in want}) > 1
        assert al.split_alignments(read, ref1, ref2) == want
        assert [tuple(r) for part in al.split_parts(read, ref1, ref2, most=3) for r in part.tolist()] == want
    assert several
    rows = spark.createDataFrame([(1, 7, 0, "A" * 24, "A" * 2000, "A" * 2000)], "fusion_id long, fragment long, read_end int, read string, ref1 string, ref2 string")
    # a place i of ref1 meets all of ref2 but 23 - min(i, 20) places
    assert al.split_reads(rows).count() == sum(1977 + min(i, 20) for i in range(4, 2001))


def test_local_scores_and_kmers(spark):
    rows = spark.createDataFrame([(1, "ACGTACGT", "ACGT"), (2, "CCCC", "GGGG"), (3, None, "A")], "id long, reference string, sequence string")
    assert {r.id: (r.score, r.percent) for r in al.local_scores(rows).collect()} == {1: (40, 1.0), 2: (0, 0.0), 3: (0, 0.0)}
    counts = {r.kmer: r.n for r in al.kmer_counts(rows.where("reference is not null"), "reference", 4).collect()}
    assert counts == {"ACGT": 2, "CGTA": 1, "GTAC": 1, "TACG": 1, "CCCC": 1}
    assert al.kmer_path({"ACG": 2, "CGT": 2, "GTT": 1}, "ACG", "GTT") == "ACGTT"
    assert al.kmer_path({"ACG": 2}, "ACG", "TTT") is None


def test_adaboost_takes_every_row(spark):
    rows = spark.range(150_001).selectExpr("cast(id as double) AS f", "cast(id >= 150000 or id % 3 = 0 as int) AS y")
    assert cy.train(rows, ["f"], F.col("y"), rounds=1)[0].threshold == 149_999.5
    with pytest.raises(ValueError):
        cy.train(rows, ["f"], F.col("y"), rounds=1, max_rows=1000)


def test_adaboost(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = ((x[:, 0] > 0.2) | (x[:, 1] > 1)).astype(int)
    model = cy.fit(x, y, ["a", "b", "c"], 40)
    rows = spark.createDataFrame([(*map(float, v), int(t)) for v, t in zip(x, y, strict=True)], "a double, b double, c double, y int")
    out = rows.withColumn("p", cy.probability(model)).collect()
    assert np.mean([(r.p > 0.5) == bool(r.y) for r in out]) > 0.95
    empty = cy.classify(rows.limit(0), rows, ["a", "b", "c"], F.col("y"))
    assert "probability" in empty.columns and empty.count() == 0
    assert cy.fit(x, np.ones(300, int), ["a", "b", "c"]) == []


# --- gene models ---------------------------------------------------------------------------

EXONS = [("t+", "1", "+", 101, 110), ("t+", "1", "+", 201, 205), ("t-", "2", "-", 11, 20), ("t-", "2", "-", 31, 34)]


def test_remap_round_trip(spark):
    exons = spark.createDataFrame(EXONS, "transcript_id string, chromosome string, strand string, s int, e int")
    points = [(t, p) for t, n in (("t+", 15), ("t-", 14)) for p in range(1, n + 1)]
    there = gm.to_genome(spark.createDataFrame(points, "transcript_id string, t_pos int"), exons)
    back = gm.to_transcript(there.select("transcript_id", "g_pos"), exons, strict=True).collect()
    assert sorted((r.transcript_id, r.t_pos) for r in back) == sorted(points)
    beyond = gm.to_genome(spark.createDataFrame([("t+", 0), ("t+", 17), ("t-", 16)], "transcript_id string, t_pos int"), exons).collect()
    assert {(r.transcript_id, r.t_pos): r.g_pos for r in beyond} == {("t+", 0): 100, ("t+", 17): 207, ("t-", 16): 9}
    intron = gm.to_transcript(spark.createDataFrame([("t+", 150), ("t+", 999), ("t-", 25)], "transcript_id string, g_pos int"), exons).collect()
    assert {(r.transcript_id, r.g_pos): r.t_pos for r in intron} == {("t+", 150): 11, ("t+", 999): 15, ("t-", 25): 5}


def test_reference_tables_from_gtf(spark, tmp_path):
    line = '{c}\tprotein_coding\t{f}\t{s}\t{e}\t.\t{d}\t.\tgene_id "{g}"; transcript_id "{t}"; gene_name "N{g}"; exon_number "1";'
    rows = [("1", "exon", 101, 200, "+", "g1", "t1"), ("1", "CDS", 121, 180, "+", "g1", "t1"), ("1", "exon", 301, 400, "-", "g2", "t2"), ("1", "CDS", 301, 350, "-", "g2", "t2"), ("1", "gene", 1, 2, "+", "g1", "t1"), ("2", "exon", 5, 9, "+", "g3", "t3")]
    (tmp_path / "m.gtf").write_text("#!x\n" + "\n".join(line.format(c=c, f=f, s=s, e=e, d=d, g=g, t=t) for c, f, s, e, d, g, t in rows))
    models = readers.gtf(spark, str(tmp_path / "m.gtf"))
    ref = pipeline.build_reference(models)
    assert {(r.gene_id, r.gs, r.ge) for r in ref.genes.collect()} == {("g1", 101, 200), ("g2", 301, 400), ("g3", 5, 9)}
    assert {(r.transcript_id, r.s, r.e, r.side) for r in ref.utrs.collect()} == {("t1", 101, 120, "utr5p"), ("t1", 181, 200, "utr3p"), ("t2", 351, 400, "utr5p")}
    assert [(r.gene1, r.gene2) for r in ref.adjacent.collect()] == [("g1", "g2")]
    assert readers.gtf(spark, str(tmp_path / "m.gtf"), chromosomes=("2",)).count() == 1
    (tmp_path / "bad.gtf").write_text('1\tx\texon\t1\t2\t.\t+\t.\ttranscript_id "t";')
    with pytest.raises(Exception, match="gene_id"):
        readers.gtf(spark, str(tmp_path / "bad.gtf")).collect()


# --- files ---------------------------------------------------------------------------------


def test_fastq_import(spark, tmp_path):
    for end in (1, 2):
        (tmp_path / f"r{end}.fastq").write_text("".join(f"@read{i}/{end} extra\n{'ACGT'[i % 4] * 5}\n+\n@@@II\n" for i in range(50 if end == 1 else 48)))
    one, two = (readers.fastq(spark, str(tmp_path / f"r{k}.fastq")) for k in (1, 2))
    reads, names = readers.import_pairs(one, two)
    assert reads.count() == 96 and names.count() == 48
    assert {(r.fragment, r.name1, r.name2) for r in names.collect()} == {(i, f"read{i}", f"read{i}") for i in range(48)}
    assert all(r.sequence == "ACGT"[r.fragment % 4] * 5 and r.quality == "@@@II" for r in reads.collect())
    with pytest.raises(ValueError):
        readers.fastq(spark, "reads.txt")


def test_fasta_chunks_and_splicing(spark, tmp_path):
    rng = random.Random(6)
    seqs = {c: "".join(rng.choice("ACGT") for _ in range(n)) for c, n in (("1", 333), ("2", 50))}
    (tmp_path / "g.fa").write_text("".join(f">{c} note\n" + "\n".join(s[i : i + 37] for i in range(0, len(s), 37)) + "\n" for c, s in seqs.items()))
    bases = readers.fasta(spark, str(tmp_path / "g.fa"), 64)
    whole = {c: "".join(r.seq for r in sorted((r for r in bases.collect() if r.chromosome == c), key=lambda r: r.chunk)) for c in seqs}
    assert whole == seqs
    exons = spark.createDataFrame(EXONS, "transcript_id string, chromosome string, strand string, s int, e int")
    out = {r.transcript_id: r.sequence for r in gm.spliced(exons, bases, 3).collect()}
    plus = seqs["1"][100:110] + seqs["1"][200:205]
    minus = (seqs["2"][10:20] + seqs["2"][30:34])[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert out == {"t+": plus + "AAA", "t-": minus + "AAA"}


def test_sam_reader(spark, tmp_path):
    rows = ["@HD\tVN:1", "f1/1\t16\tg|t\t10\t9\t5M\t*\t0\t0\tACGTA\tIIIII\tXM:i:3\tNM:i:0", "f2\t128\t1\t7\t9\t5M\t*\t0\t0\tACG\tIII", "f3/2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI"]
    (tmp_path / "a.sam").write_text("\n".join(rows))
    sam = readers.sam(spark, str(tmp_path / "a.sam"))
    got = {tuple(r) for r in readers.alignments(sam).collect()}
    assert got == {("f1", 0, "g|t", "-", 10, 14), ("f2", 1, "1", "+", 7, 9)}
    assert [r.qname for r in sam.where(rd.suppressed(F.col("tags"))).collect()] == ["f1/1"]


def test_psl_and_exon_regions(spark, tmp_path):
    (tmp_path / "p.psl").write_text("psLayout\n10\t0\t0\t0\t0\t0\t1\t50\t+\tq\t20\t0\t10\tchrM\t99\t4\t64\t2\t4,6,\t0,4,\t4,58,\n")
    r = readers.psl(spark, str(tmp_path / "p.psl")).first()
    assert (r.q_start, r.t_start, r.t_name, r.block_sizes, r.t_starts) == (1, 5, "MT", [4, 6], [4, 58])
    exons = spark.createDataFrame([("g", *x) for x in EXONS], "gene_id string, transcript_id string, chromosome string, strand string, s int, e int")
    sinks.exon_region_text(exons).coalesce(1).write.text(str(tmp_path / "regions"))
    assert {tuple(r) for r in readers.exon_regions(spark, str(tmp_path / "regions")).collect()} == {tuple(r) for r in exons.collect()}


def test_tsv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, True, None, [1, 2]), (2, False, "x", [])], "cluster_id long, orf boolean, note string, starts array<int>")
    sinks.write_tsv(rows.coalesce(1), str(tmp_path / "t"))
    text = next((tmp_path / "t").glob("part*")).read_text()
    assert text == "cluster_id\torf\tnote\tstarts\n1\tY\t\t1,2\n2\tN\tx\t\n"


def test_stats_file(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("a\tb\n1\t2\n")
    assert readers.single_stats(spark, str(tmp_path / "s.tsv")) == {"a": "1", "b": "2"}
    (tmp_path / "s2.tsv").write_text("a\tb\n")
    with pytest.raises(ValueError):
        readers.single_stats(spark, str(tmp_path / "s2.tsv"))


def test_partitions_by_chromosome_pair(spark, tmp_path):
    rows = spark.createDataFrame([("1", "2", i) for i in range(10)] + [("1", "1", 11)], "chr1 string, chr2 string, fragment long")
    sinks.write_chromosome_pairs(rows, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("chr2 = 2").count() == 10


def test_formats(spark):
    old = spark.createDataFrame([("m:1:2:ACG:hhh",), ("m:1:3:AC:40 -5",)], "value string")
    assert [(r.name, r.sequence, r.quality) for r in formats.scarf(old).collect()] == [("m:1:2", "ACG", "III"), ("m:1:3", "AC", "I" + chr(33 + 1))]
    r = spark.range(1).select(formats.colour_space(F.lit("T00123")).alias("c"), formats.numbers_to_letters(F.lit("0 40"), False).alias("n"), formats.to_old_scale(F.lit("!I")).alias("o")).first()
    assert (r.c, r.n, r.o) == ("ACGT"[0:1] + "CGT", "!I", "@h")


def test_config():
    values = config.parse("a = 1 # one\nb = $(a)2\nlist1 = x\nlist2 = y\nset = p, q\nspan_count_threshold = 7\n")
    assert values["b"] == "12"
    assert config.numbered(values, "list") == ["x", "y"] and config.listed(values, "set") == {"p", "q"}
    assert config.settings(values).span_count_threshold == 7
    with pytest.raises(ValueError):
        config.parse("a = $(b)\nb = $(a)")


# --- jobs ----------------------------------------------------------------------------------


def test_discovery_finds_a_planted_junction(spark):
    rng = random.Random(8)
    rows = []
    for f in range(30):
        a, b = 10_000 - rng.randint(0, 150), 50_000 + rng.randint(0, 100)
        rows += [(f, 0, "1", "+", a - 50, a), (f, 1, "2", "-", b, b + 50)]
    for f in range(100, 140):  # ends in one place: concordant
        s = rng.randint(0, 10**6)
        rows += [(f, 0, "3", "+", s, s + 50), (f, 1, "3", "-", s + 100, s + 150)]
    rows += [(500, 0, "4", "+", 5, 55)]  # one end only
    aln = spark.createDataFrame(rows, "fragment long, read_end int, ref_name string, strand string, s long, e long")
    genes = spark.createDataFrame([("g", "9", 1, 2)], "gene_id string, chromosome string, gs long, ge long")
    left = pipeline.discordant(aln, genes)
    assert {r.fragment for r in left.select("fragment").distinct().collect()} == set(range(30))
    found = pipeline.find_clusters(left, 250.0, 40.0).collect()
    assert len({r.cluster_id for r in found}) == 1
    assert len({r.fragment for r in found}) >= 28  # the model's precision leaves out the outermost
    assert {(r.cluster_end, r.ref_name) for r in found} == {(0, "1"), (1, "2")}
    regions = cl.regions(spark.createDataFrame(found))
    tasks = pipeline.split_tasks(regions, 250.0, 40.0, 40, 50)
    assert tasks.count() == 2 * len({r.cluster_id for r in found})


def test_clusters_cross_bin_edges_and_exchanged_ends(spark):
    rows = []
    for f in range(6):  # ends on either side of a bin edge
        a, b = 32_768 - 30 + 12 * f, 98_304 - 30 + 12 * f
        rows += [(f, 0, "1", "+", a, a + 50), (f, 1, "2", "-", b, b + 50)]
        # read ends exchanged in every other fragment, on two chromosomes and in one bin
        k = f % 2
        rows += [(10 + f, k, "3", "+", 10_000 + f, 10_050 + f), (10 + f, 1 - k, "4", "-", 20_000 + f, 20_050 + f)]
        rows += [(20 + f, k, "5", "+", 10_000 + f, 10_050 + f), (20 + f, 1 - k, "5", "+", 20_000 + f, 20_050 + f)]
    aln = spark.createDataFrame(rows, "fragment long, read_end int, ref_name string, strand string, s long, e long")
    found = pipeline.find_clusters(aln, 250.0, 40.0).collect()
    whole = {}
    for r in found:
        whole.setdefault(r.cluster_id, []).append(r)
    assert sorted({x.fragment for x in group} == set(range(10 * k, 10 * k + 6)) for k, group in enumerate(sorted(whole.values(), key=lambda g: min(x.fragment for x in g)))) == [True] * 3
    assert sorted((r.fragment, r.read_end, r.ref_name, r.strand, r.s, r.e) for r in found) == sorted(rows)
    assert all(len({(x.ref_name, x.s // 15_000) for x in group if x.cluster_end == k and x.fragment >= 10}) <= 1 for group in whole.values() for k in (0, 1))


def test_bin_pairs_have_clusters_that_fit(spark):
    """Members of every cluster lie together: break point, lengths and overshoot within the model's bounds."""
    rows = QUERIES["em_clusters"](spark, SMALL).collect()
    assert rows
    pairs = {}
    for p in pipeline.binned_pairs(ad.aln(spark, SMALL), 600).collect():
        pairs.setdefault((*(p[k] for k in pipeline.BIN_PAIR), p.fragment), []).append((p.x, p.y, p.len1 + p.len2))
    groups = {}
    for r in rows:
        groups.setdefault((*(r[k] for k in pipeline.BIN_PAIR), r.component), []).append(r.fragment)
    for key, members in groups.items():
        assert len(members) == len(set(members)) >= 5
        held = [pairs[(*key[:-1], f)] for f in members]
        # some choice of one pair per fragment has gaps within twice the width of the inner 95% of 1,000
        lows, highs = [min(3000 - n + x + y for x, y, n in h) for h in held], [max(3000 - n + x + y for x, y, n in h) for h in held]
        assert max(lows) - min(highs) <= 2 * 1.96 * 1000 + 1e-6


def test_exon_boundaries_by_hand(spark):
    names = "cluster_id long, side int, block int, target string, strand string, q_start int, q_end int, t_start int, t_end int, t_size int"
    blocks = [(1, 1, 0, "a0", "+", 1, 10, 5, 13, 14), (1, 1, 1, "a1", "+", 1, 10, 5, 14, 14), (1, 2, 0, "b0", "-", 11, 20, 3, 9, 9), (1, 2, 1, "b1", "+", 11, 20, 1, 9, 12)]
    blocks += [(2, 1, 0, "a", "-", 21, 30, 4, 8, 8), (2, 2, 0, "b", "-", 1, 20, 1, 20, 25), (3, 1, 0, "a", "+", 1, 10, 1, 9, 10), (3, 2, 0, "b", "+", 11, 20, 1, 9, 10)]
    found = {r.cluster_id: tuple(r)[1:] for r in fu.exon_boundaries(spark.createDataFrame(blocks, names)).collect()}
    assert found == {1: ("a1", 14, "b0", 9), 2: ("a", 8, "b", 1)}


def test_merge_keeps_the_order(spark):
    side = lambda rows: spark.createDataFrame(rows, "qname string, line long")
    out = rd.merge_ordered(side([("2/1", 0), ("2/1", 1), ("10/1", 2)]), side([("1/2", 0), ("2/2", 1), ("11/2", 2)]), "line").collect()
    assert [(r.qname, r.line) for r in out] == [("1/2", 0), ("2/1", 0), ("2/1", 1), ("2/2", 1), ("10/1", 2), ("11/2", 2)]


def test_sums_below_across_ranges(spark):
    rng = random.Random(12)
    rows = [(rng.choice("ab"), rng.randint(0, 300), rng.randint(1, 9)) for _ in range(200)]
    points = [(rng.choice("abc"), rng.randint(-5, 310)) for _ in range(80)]
    given, asked = spark.createDataFrame(rows, "k string, p long, n long"), spark.createDataFrame(points, "k string, at long")
    for reached in (False, True):
        out = ij.sums_below(asked, given, "k", "at", "p", "n", "total", reached, width=32).collect()
        want = [(k, at, sum(n for c, p, n in rows if c == k and (p < at or reached and p == at))) for k, at in points]
        assert sorted((r.k, r.at, r.total) for r in out) == sorted(want)


def test_unspliced_and_another_clusterer(spark):
    bases = spark.createDataFrame([("1", k, 4, "ACGTTGCAGG"[4 * k : 4 * k + 4]) for k in range(3)], "chromosome string, chunk int, chunk_size int, seq string")
    region = spark.createDataFrame([("g", "1", "-", 2, 9)], "gene_id string, chromosome string, strand string, gs int, ge int")
    assert gm.unspliced(region, bases).first().sequence == "CTGCAACG"
    pairs = spark.createDataFrame([("k", f, float(f), 1.0, 5, 5) for f in range(6)], "key string, fragment long, x double, y double, len1 long, len2 long")
    out = cl.discordant_clusters(pairs, ["key"], 10.0, 1.0, least=3, clusterer=lambda x, *_: [np.flatnonzero(x < 3), np.flatnonzero(x >= 3)])
    assert sorted((r.component, r.fragment) for r in out.collect()) == [(int(f >= 3), f) for f in range(6)]


def test_binned_clusters_cross_bin_edges(spark):
    rows = [(c, f, x, 100.0, 50, 50) for c in (1, 2) for f, x in enumerate((3980.0, 3990.0, 4010.0, 4020.0))]
    pairs = spark.createDataFrame(rows, "cluster_id long, fragment long, x double, y double, len1 long, len2 long")
    found = cl.binned_clusters(pairs, "cluster_id", 4000, 4000.0, 1500.0, least=3).collect()
    assert sorted((r.cluster_id, r.fragment) for r in found) == [(c, f) for c in (1, 2) for f in range(4)]
    assert len({(r.cluster_id, r.xbin, r.component) for r in found}) == 2


def test_predicted_break_sequence(spark):
    rng = random.Random(9)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    w0, w1 = seq(80), seq(80)
    junction = w0[:40] + w1[30:]
    windows = spark.createDataFrame([(1, 0, "+", 1000, w0), (1, 1, "-", 5000, w1)], "cluster_id long, cluster_end int, strand string, window_start long, window string")
    reads = [(1, i, 0, junction[40 - k : 40 - k + 40]) for i, k in enumerate(range(12, 28))] + [(1, 0, 0, junction[28:68])]
    out = pipeline.predict_breaks(windows, spark.createDataFrame(reads, "cluster_id long, fragment long, read_end int, read string")).collect()
    assert len(out) == 1 and out[0].split_count == 16
    assert out[0].sequence.replace("|", "") == junction
    assert out[0].sequence.split("|")[0] == w0[:40]
    assert out[0].break0 == 1000 + 40 - 1


# --- whole tables --------------------------------------------------------------------------


def test_every_point_and_cluster(spark):
    rows, genes = ad.aln(spark, SMALL).collect(), ad.gene(spark, SMALL).collect()
    points = {(r.ref_name, r.s) for r in rows}
    want = set()
    for c, s in points:
        own = [(max(0, g.gs - s, s - g.ge), g.gene_id) for g in genes if g.chromosome == c]
        if own:
            want.add((c, s, *min(own)))
    got = QUERIES["nearest_gene"](spark, SMALL).collect()
    assert len(got) == len(want) and {(r.chromosome, r.s, r.distance, r.gene_id) for r in got} == want
    bounds, of = {}, {}
    for r in rows:
        lo, hi = bounds.get((r.cluster_id, r.strand), (r.s, r.e))
        bounds[r.cluster_id, r.strand] = min(lo, r.s), max(hi, r.e)
        of.setdefault(r.fragment, set()).add(r.cluster_id)
    want = sorted((r.fragment, r.line, c) for r in rows for c in of[r.fragment] if (c, r.strand) in bounds and r.s <= bounds[c, r.strand][1] and bounds[c, r.strand][0] <= r.e)
    assert sorted((r.fragment, r.line, r.cluster_id) for r in QUERIES["supporting_reads"](spark, SMALL).collect()) == want


def test_whole_texts(spark):
    texts = {r.seq_id: r.sequence for r in ad.seq(spark, SMALL).where("sequence IS NOT NULL").collect()}
    plain = {r.doc_id: "".join(c for c in (r.text or "").upper() if c in "ACGT") for r in ad.table(spark, SMALL, "documents").collect()}
    assert max(len(x) for x in texts.values()) > 40 and all(plain[k] == x for k, x in texts.items())
    back = str.maketrans("ACGT", "TGCA")
    run = lambda name: QUERIES[name](spark, SMALL).collect()
    want = {}
    for x in texts.values():
        for i in range(len(x) - 7):
            want[x[i : i + 8]] = want.get(x[i : i + 8], 0) + 1
    assert {r.kmer: r.n for r in run("kmer_counts")} == want
    assert {r.seq_id: r.rc for r in run("revcomp") if r.rc is not None} == {k: x[::-1].translate(back) for k, x in texts.items()}
    bad = lambda x: x and any(x.count(c) > len(x) * 0.4 or c * math.ceil(len(x) * 0.1) in x for c in "ACGTN")
    assert {r.seq_id: r.sequence for r in run("garbage_filter")} == {k: x for k, x in texts.items() if not bad(x)}

    def entropy(x):
        shares = [x.count(a + b) / (len(x) - 1) for a in "ACGT" for b in "ACGT"]
        return -sum(p * math.log2(p) for p in shares if p)

    got = {r.seq_id: r.entropy for r in run("entropy")}
    assert got.keys() == {k for k, x in texts.items() if len(x) > 1}
    assert all(abs(v - entropy(texts[k])) < 1e-5 for k, v in got.items())
    joined = {k: "".join(x[k % 25 * 3 + 120 * n : k % 25 * 3 + 120 * n + 30] for n in range(3)) for k, x in texts.items()}
    want = {k: (x if k % 2 == 0 else x[::-1].translate(back)) + "AAAAA" for k, x in joined.items()}
    got = {r.transcript_id: r.sequence for r in run("spliced_sequence")}
    assert got == {k: want[k] for k, x in joined.items() if x}
    longest = max(texts, key=lambda k: len(texts[k]))
    query = texts[longest][3:13] + texts[longest][14:26]
    assert {r.id: r.score for r in run("local_align")}[longest] == al.local_score(query, texts[longest])
    assert longest in {r.fusion_id for r in run("split_align")} and len(texts[longest]) != 40


def test_split_writers_and_edges(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"r{i}", "ACGT", "IIII") for i in range(10)], "fragment long, name string, sequence string, quality string")
    chunks = sinks.write_chunks(rows.coalesce(1), f"{tmp_path}/chunks", sinks.fastq_text(F.col("name"), F.col("sequence"), F.col("quality")), "fragment", 4).collect()
    assert sorted((r.first_fragment, r.last_fragment, r.n) for r in chunks) == [(0, 3, 4), (4, 7, 4), (8, 9, 2)]
    for r in spark.read.text(f"{tmp_path}/chunks/*/*.txt", wholetext=True).collect():
        assert r.value.count("@r") in (2, 4)
    sinks.write_round_robin(rows, f"{tmp_path}/parts", F.concat(F.lit(">"), F.col("name"), F.lit("\n"), F.col("sequence")), "fragment", 3)
    parts = spark.read.text(f"{tmp_path}/parts").where("value LIKE '>%'")
    assert {(r.part, r.value) for r in parts.collect()} == {(i % 3, f">r{i}") for i in range(10)}
    (tmp_path / "edges.txt").write_text("a\t1\na\t2\nb\t2\n")
    assert sorted(map(tuple, readers.edge_list(spark, f"{tmp_path}/edges.txt").collect())) == [("a", "1"), ("a", "2"), ("b", "2")]
    points = rs.circos_points(spark.createDataFrame([("1", 5, 9, 3, 0.5), ("X", 1, 2, 6, -1.0)], "chr string, start long, end long, level int, value double"), (1, 2, 3))
    assert [tuple(r) for r in points.collect()] == [("hs1", 5, 9, 0.5)]
