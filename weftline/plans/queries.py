"""Queries over the bundled tables, one or more per operator, with DuckDB text.

``Q`` maps a name to the Spark function and the SQL, which is None where the
algorithm has no SQL form.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import fusions as fu
from weftline.functions import intervals as iv
from weftline.functions import sequences as sq
from weftline.functions import stats as st
from weftline.operators import genemodels as gm
from weftline.operators import intervals as ij
from weftline.operators import reads as rd
from weftline.operators import results as rs
from weftline.operators.tasks import dealt
from weftline.sources import adapters as ad
from weftline.sources import formats, readers, sinks
from weftline.sources.adapters import ALN, EXON, FLAGS, GENE, HITS, MEMBER, OFF, SEQ, rounded

Q: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None, name: str | None = None):
    """Register a Spark function under its name; its result is rounded for comparison."""

    def put(f):
        Q[name or f.__name__] = (lambda spark, d: rounded(f(spark, d)), sql)
        return f

    return put


def tab(spark, d, name):
    return ad.table(spark, d, name)


# --- filters -------------------------------------------------------------------------------


@query(f"WITH {FLAGS} SELECT qname, flag::BIGINT AS flag FROM flags WHERE (flag & 2) <> 0")
def flag_concordant(spark, d):
    return rd.concordant(ad.flags(spark, d)).select("qname", "flag")


@query(f"WITH {FLAGS} SELECT qname, flag::BIGINT AS flag FROM flags WHERE (flag & 4) = 0")
def flag_mapped(spark, d):
    return rd.mapped(ad.flags(spark, d)).select("qname", "flag")


@query(f"WITH {FLAGS} SELECT qname, flag::BIGINT AS flag FROM flags WHERE (flag & 64) <> 0")
def flag_mate(spark, d):
    return rd.mate(ad.flags(spark, d), 1).select("qname", "flag")


@query(f"WITH {FLAGS} SELECT regexp_replace(qname, '/[12]', '') AS fragment FROM flags")
def read_ids(spark, d):
    return ad.flags(spark, d).select(rd.fragment_of(F.col("qname")).alias("fragment"))


@query(f"WITH {FLAGS} SELECT fragment, price FROM flags WHERE price > 150000.5")
def expr_filter(spark, d):
    return rd.expression_filter(ad.flags(spark, d), "price", "> 150000.5").select("fragment", "price")


@query(f"WITH {FLAGS} SELECT fragment, status FROM flags WHERE status = 'F'")
def equal_filter(spark, d):
    return rd.equal_filter(ad.flags(spark, d), "status", "F").select("fragment", "status")


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line FROM aln WHERE NOT (ref_name = concat('c', (fragment % 10)::VARCHAR) AND (abs(e - fragment * 3) < 5000 OR abs(s - fragment * 3 - 100) < 5000))")
def near_gene_filter(spark, d):
    rows = ad.aln(spark, d).withColumns({"c2": F.concat(F.lit("c"), (F.col("fragment") % 10).cast("string")), "s2": F.col("fragment") * 3, "e2": F.col("fragment") * 3 + 100})
    return rd.far_genes(rows, "ref_name", "c2", "s", "e", "s2", "e2", 5000).select("fragment", "line")


@query(f"WITH {HITS} SELECT query, matches::BIGINT AS matches FROM hits WHERE matches::DOUBLE / q_size > 0.9")
def psl_pid_filter(spark, d):
    return ad.hits(spark, d).where(F.col("matches") / F.col("q_size") > 0.9).select("query", "matches")


@query(f"WITH {HITS} SELECT query, matches::BIGINT AS matches FROM hits WHERE matches::DOUBLE / q_size >= 0.5 AND t_end - t_start <= 1200")
def psl_concordant_filter(spark, d):
    return ad.hits(spark, d).where((F.col("matches") / F.col("q_size") >= 0.5) & (F.col("t_end") - F.col("t_start") <= 1200)).select("query", "matches")


@query(f"WITH {SEQ} SELECT seq_id, substring(sequence, 1, 25) AS trimmed FROM seq")
def trim(spark, d):
    return ad.seq(spark, d).select("seq_id", sq.trimmed(F.col("sequence"), 25).alias("trimmed"))


_GARBAGE = " OR ".join(f"length(sequence) - length(replace(sequence, '{c}', '')) > length(sequence) * 0.4::DOUBLE OR contains(sequence, repeat('{c}', ceil(length(sequence) * 0.1::DOUBLE)::INT))" for c in "ACTGN")


@query(f"WITH {SEQ} SELECT seq_id, sequence FROM seq WHERE NOT (length(sequence) > 0 AND ({_GARBAGE}))")
def garbage_filter(spark, d):
    return ad.seq(spark, d).where(~sq.is_garbage(F.col("sequence"), 0.4, 0.1))


@query("SELECT p_partkey, p_type FROM part WHERE p_type IN (SELECT DISTINCT p_type FROM part WHERE p_partkey < 3) AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21')")
def isin_filter(spark, d):
    part = tab(spark, d, "part")
    kinds = part.where("p_partkey < 3").select("p_type")
    return rd.keep_ids(part.where(F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#13", "Brand#21")), kinds, "p_type", "p_type").select("p_partkey", "p_type")


@query(f"WITH {ALN}, {GENE} SELECT a.fragment, a.line::BIGINT AS line, coalesce(g.chromosome, a.ref_name) AS chromosome FROM aln a LEFT JOIN gene g ON a.cluster_id * 7 = g.gene_id")
def chromosome_map(spark, d):
    known = ad.gene(spark, d).select((F.col("gene_id")).alias("g"), "chromosome")
    rows = ad.aln(spark, d)
    return rows.join(known, rows["cluster_id"] * 7 == known["g"], "left").select("fragment", "line", F.coalesce("chromosome", "ref_name").alias("chromosome"))


@query(f"WITH {FLAGS} SELECT fragment FROM flags WHERE regexp_extract(tags, 'XM:i:([0-9]+)', 1)::INT > 0")
def tag_extract(spark, d):
    return ad.flags(spark, d).where(rd.suppressed(F.col("tags"))).select("fragment")


@query(f"WITH {MEMBER} SELECT cluster_id, count(*)::BIGINT AS n FROM member GROUP BY 1 HAVING count(*) >= 590")
def min_cluster_size(spark, d):
    return ad.member(spark, d).groupBy("cluster_id").agg(F.count("*").alias("n")).where("n >= 590")


@query("SELECT p_partkey, replace(concat('hs', (p_size % 24)::VARCHAR), 'hs23', 'hsX') AS chromosome FROM part WHERE p_size IN (1, 3, 5, 23, 47)")
def level_filter(spark, d):
    name = F.when(F.col("p_size") % 24 == 23, "hsX").otherwise(F.concat(F.lit("hs"), (F.col("p_size") % 24).cast("string")))
    return tab(spark, d, "part").where(F.col("p_size").isin(1, 3, 5, 23, 47)).select("p_partkey", name.alias("chromosome"))


# --- semi joins and set operations ---------------------------------------------------------

_IDS = "ids AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F')"


def _ids(spark, d):
    return tab(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))


@query(f"WITH {ALN}, {_IDS} SELECT fragment, line::BIGINT AS line FROM aln WHERE fragment IN (SELECT id FROM ids)")
def ids_semi(spark, d):
    return rd.keep_ids(ad.aln(spark, d), _ids(spark, d), "fragment", "id").select("fragment", "line")


@query(f"WITH {ALN}, {_IDS} SELECT fragment, line::BIGINT AS line FROM aln WHERE fragment NOT IN (SELECT id FROM ids)")
def ids_anti(spark, d):
    return rd.keep_ids(ad.aln(spark, d), _ids(spark, d), "fragment", "id", invert=True).select("fragment", "line")


@query(f"WITH {FLAGS} SELECT qname FROM flags WHERE split_part(rname, '|', 1) IN ('g1', 'g5', 'g77')")
def gene_prefix_semi(spark, d):
    genes = spark.createDataFrame([("g1",), ("g5",), ("g77",)], "gene string")
    rows = ad.flags(spark, d).withColumn("gene", sq.gene_of(F.col("rname")))
    return rows.join(F.broadcast(genes), "gene", "left_semi").select("qname")


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line FROM aln WHERE ref_name IN (SELECT concat('c', n_nationkey::VARCHAR) FROM nation WHERE n_regionkey = 1)")
def reference_semi(spark, d):
    refs = tab(spark, d, "nation").where("n_regionkey = 1").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("ref"))
    return rd.keep_ids(ad.aln(spark, d), refs, "ref_name", "ref").select("fragment", "line")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey FROM orders WHERE o_totalprice > 200000")
def union_ids(spark, d):
    o = tab(spark, d, "orders")
    return _ids(spark, d).unionByName(o.where("o_totalprice > 200000").select(F.col("o_orderkey").alias("id")))


@query("SELECT l_orderkey AS id FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def intersect_bag(spark, d):
    return rd.keep_ids(tab(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")), _ids(spark, d), "id", "id")


@query("WITH a AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'O') SELECT coalesce(a.id, b.id) AS id FROM a FULL JOIN b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL")
def symmetric_difference(spark, d):
    o = tab(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderstatus").where(F.col("o_orderstatus").isin("F", "O"))
    return o.groupBy("id").agg(F.min("o_orderstatus").alias("lo"), F.max("o_orderstatus").alias("hi")).where("lo = hi").select("id")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL")
def except_ids(spark, d):
    return rd.keep_ids(tab(spark, d, "orders").select(F.col("o_orderkey").alias("id")), _ids(spark, d), "id", "id", invert=True)


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'")
def union_skip_empty(spark, d):
    return _ids(spark, d).unionByName(tab(spark, d, "orders").where("o_orderkey < 0").select(F.col("o_orderkey").alias("id")))


# --- interval joins ------------------------------------------------------------------------


def _hits(spark, d, **options):
    return ij.overlap_join(ad.aln(spark, d), ad.gene(spark, d), [("ref_name", "chromosome")], ("s", "e"), ("gs", "ge"), 500, **options)


_OVER = "a.ref_name = g.chromosome AND a.s <= g.ge AND g.gs <= a.e"


@query(f"WITH {ALN}, {GENE} SELECT a.fragment, a.line::BIGINT AS line, a.s, g.gene_id FROM aln a JOIN gene g ON {_OVER}")
def overlap_join(spark, d):
    return _hits(spark, d).select("fragment", "line", "s", "gene_id")


@query(f"WITH {ALN}, {GENE} SELECT a.fragment, a.line::BIGINT AS line, a.s, g.gene_id FROM aln a JOIN gene g ON a.ref_name = g.chromosome AND a.s >= g.gs - 30 AND a.e <= g.ge + 30")
def contains_join(spark, d):
    return _hits(spark, d, how="within", slack=30).select("fragment", "line", "s", "gene_id")


@query(f"WITH {ALN}, {GENE} SELECT a.fragment, a.line::BIGINT AS line, a.s, g.gene_id FROM aln a JOIN gene g ON a.ref_name = g.chromosome AND a.s BETWEEN g.gs AND g.ge")
def point_in_interval(spark, d):
    return ij.point_join(ad.aln(spark, d), ad.gene(spark, d), [("ref_name", "chromosome")], "s", ("gs", "ge"), 500).select("fragment", "line", "s", "gene_id")


@query(f"WITH {ALN}, {GENE} SELECT a.fragment, a.line::BIGINT AS line, a.s, g.gene_id FROM aln a JOIN gene g ON {_OVER} AND a.strand = g.gstrand")
def strand_overlap_join(spark, d):
    return ij.overlap_join(ad.aln(spark, d), ad.gene(spark, d), [("ref_name", "chromosome"), ("strand", "gstrand")], ("s", "e"), ("gs", "ge"), 500).select("fragment", "line", "s", "gene_id")


@query(f"""WITH {ALN}, {GENE}, p AS (SELECT DISTINCT ref_name AS chromosome, s FROM aln),
x AS (SELECT p.chromosome, p.s, g.gene_id, greatest(0, g.gs - p.s, p.s - g.ge) AS distance FROM p JOIN gene g ON p.chromosome = g.chromosome),
r AS (SELECT *, row_number() OVER (PARTITION BY chromosome, s ORDER BY distance, gene_id) AS k FROM x)
SELECT chromosome, s, distance::BIGINT AS distance, gene_id FROM r WHERE k = 1""")
def nearest_gene(spark, d):
    points = ad.aln(spark, d).select(F.col("ref_name").alias("chromosome"), "s")
    return ij.nearest(points, ad.gene(spark, d), "chromosome", "s", "gene_id", ("gs", "ge"), 500)


@query(f"""WITH {ALN}, b AS (SELECT DISTINCT fragment, read_end, unnest(range(s // 2048, e // 2048 + 1)) AS bin, ref_name, strand FROM aln),
p AS (SELECT a.fragment, CASE WHEN (a.ref_name, a.strand, a.bin) <= (c.ref_name, c.strand, c.bin) THEN concat(a.ref_name, a.strand, a.bin) ELSE concat(c.ref_name, c.strand, c.bin) END AS lo,
      CASE WHEN (a.ref_name, a.strand, a.bin) <= (c.ref_name, c.strand, c.bin) THEN concat(c.ref_name, c.strand, c.bin) ELSE concat(a.ref_name, a.strand, a.bin) END AS hi FROM b a JOIN b c ON a.fragment = c.fragment AND a.read_end = 0 AND c.read_end = 1)
SELECT lo, hi, count(DISTINCT fragment)::BIGINT AS n_fragments FROM p GROUP BY 1, 2 HAVING count(DISTINCT fragment) >= 3""")
def bin_pairs(spark, d):
    name = lambda x: F.concat(x["ref_name"], x["strand"], x["bin"])
    return rd.bin_pairs(ad.aln(spark, d), 2048, 0, 3).select(name(F.col("lo")).alias("lo"), name(F.col("hi")).alias("hi"), "n_fragments")


@query(f"WITH {ALN} SELECT DISTINCT a.fragment, least(a.ref_name, b.ref_name) AS chr1, greatest(a.ref_name, b.ref_name) AS chr2 FROM aln a JOIN aln b ON a.fragment = b.fragment AND a.read_end = 0 AND b.read_end = 1")
def chr_pairs(spark, d):
    ends = dealt(ad.aln(spark, d).select("fragment", "read_end", "ref_name"), "fragment").distinct()
    a, b = (ends.where(F.col("read_end") == k).select("fragment", F.col("ref_name").alias(f"r{k}")) for k in (0, 1))
    return a.join(b, "fragment").select("fragment", F.least("r0", "r1").alias("chr1"), F.greatest("r0", "r1").alias("chr2")).distinct()


@query(f"WITH {ALN} SELECT a.fragment, a.s AS s0, b.s AS s1 FROM aln a JOIN aln b ON a.fragment = b.fragment AND a.read_end = 0 AND b.read_end = 1 AND a.strand = b.strand")
def fragment_pairs(spark, d):
    rows = ad.aln(spark, d)
    a, b = (rows.where(F.col("read_end") == k).select("fragment", "strand", F.col("s").alias(f"s{k}")) for k in (0, 1))
    return a.join(b, ["fragment", "strand"]).select("fragment", "s0", "s1")


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line FROM aln WHERE fragment IN (SELECT fragment FROM aln GROUP BY 1 HAVING count(DISTINCT read_end) = 2)")
def group_complete(spark, d):
    return rd.both_ends(ad.aln(spark, d)).select("fragment", "line")


@query(f"WITH {ALN}, {GENE}, h AS (SELECT a.fragment, a.read_end, g.gene_id FROM aln a JOIN gene g ON {_OVER}) SELECT DISTINCT x.fragment FROM h x JOIN h y ON x.fragment = y.fragment AND x.gene_id = y.gene_id AND x.read_end = 0 AND y.read_end = 1")
def gene_concordant(spark, d):
    return rd.same_gene(ad.aln(spark, d), ad.gene(spark, d), 500)


_SHARED = "b AS (SELECT DISTINCT fragment, read_end, ref_name, unnest(range(greatest(s - {r}, 0) // {r}, (e + {r}) // {r} + 1)) AS bin FROM aln) SELECT DISTINCT x.fragment FROM b x JOIN b y ON x.fragment = y.fragment AND x.ref_name = y.ref_name AND x.bin = y.bin AND x.read_end = 0 AND y.read_end = 1"


@query(f"WITH {ALN}, {_SHARED.format(r=1000)}")
def region_concordant(spark, d):
    return rd.same_region(ad.aln(spark, d), 1000)


@query(f"WITH {ALN}, x AS ({_SHARED.format(r=4000).replace('b AS (', 'WITH b AS (', 1)}) SELECT fragment, count(*)::BIGINT AS n FROM aln WHERE fragment NOT IN (SELECT fragment FROM x) GROUP BY 1")
def concordance_check(spark, d):
    rows = ad.aln(spark, d)
    return rd.keep_ids(rows, rd.same_region(rows, 4000), "fragment", "fragment", invert=True).groupBy("fragment").agg(F.count("*").alias("n"))


_ISLANDS = "m AS (SELECT *, max(e) OVER (PARTITION BY {k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {t}), n AS (SELECT *, sum(CASE WHEN prev IS NULL OR s > prev + {g} THEN 1 ELSE 0 END) OVER (PARTITION BY {k} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)"
_COUNTS = _ISLANDS.format(k="fragment, read_end, ref_name", t="aln", g=0) + ", c AS (SELECT fragment, read_end, count(DISTINCT (ref_name, island))::BIGINT AS n_alignments FROM n GROUP BY 1, 2)"


@query(f"WITH {ALN}, {_COUNTS} SELECT fragment, read_end::BIGINT AS read_end, n_alignments FROM c")
def alignment_count(spark, d):
    return rd.alignment_counts(ad.aln(spark, d), ["fragment", "read_end"])


@query(f"WITH {ALN}, {_COUNTS} SELECT fragment FROM (SELECT fragment, coalesce(max(CASE WHEN read_end = 0 THEN n_alignments END), 1) * coalesce(max(CASE WHEN read_end = 1 THEN n_alignments END), 1) AS p FROM c GROUP BY 1) WHERE p > 6")
def unmappable(spark, d):
    return rd.unmappable(rd.alignment_counts(ad.aln(spark, d), ["fragment", "read_end"]), 6)


# --- statistics ----------------------------------------------------------------------------


@query(f"WITH {FLAGS} SELECT split_part(rname, '|', 1) AS gene, round(sum(0.5::DOUBLE), 6) AS expression FROM flags GROUP BY 1")
def expression(spark, d):
    return rd.expression(ad.flags(spark, d), "rname")


@query(f"WITH {ALN} SELECT gene, round(sum(x), 6) AS expression FROM (SELECT ref_name AS gene, sum(0.5::DOUBLE) AS x FROM aln GROUP BY 1 UNION ALL SELECT strand, sum(0.5::DOUBLE) FROM aln GROUP BY 1) GROUP BY 1")
def merged_expression(spark, d):
    rows = ad.aln(spark, d)
    parts = rd.expression(rows).unionByName(rd.expression(rows, "strand"))
    return parts.groupBy("gene").agg(F.sum("expression").alias("expression"))


_STATS = "count(*)::BIGINT AS frag_count, round(avg(abs(z)), 6) AS fraglength_mean, round(stddev_pop(abs(z)), 6) AS fraglength_stddev, min(len)::BIGINT AS readlength_min, max(len)::BIGINT AS readlength_max"


@query(f"WITH {ALN} SELECT {_STATS} FROM (SELECT (s - 20000)::DOUBLE AS z, e - s + 1 AS len FROM aln)")
def read_stats(spark, d):
    return rd.read_stats(ad.aln(spark, d).withColumns({"z": F.col("s") - 20000, "len": F.col("e") - F.col("s") + 1}), "z", "len")


@query(f"WITH {ALN} SELECT {_STATS} FROM (SELECT (s - 20000)::DOUBLE AS z, e - s + 1 AS len FROM aln)")
def merged_read_stats(spark, d):
    rows = ad.aln(spark, d).withColumns({"z": F.col("s") - 20000, "len": F.col("e") - F.col("s") + 1})
    n = F.abs("z")
    parts = rows.groupBy("ref_name").agg(F.count("*").alias("frag_count"), F.avg(n).alias("fraglength_mean"), F.stddev_pop(n).alias("fraglength_stddev"), F.min("len").alias("readlength_min"), F.max("len").alias("readlength_max"))
    return rd.merge_read_stats(parts)


_DRAW = "concat_ws('-', l_orderkey, l_linenumber, l_suppkey, l_partkey)"
_PICK = "min(struct_pack(h := md5(concat(draw, '-{k}')), v := value)).v"


@query(f"WITH x AS (SELECT l_partkey % 150 AS k, l_quantity * (1 + l_partkey % 150) AS value, {_DRAW} AS draw FROM lineitem), p AS (SELECT k, {_PICK.format(k=1)} AS a, {_PICK.format(k=2)} AS b FROM x GROUP BY 1 HAVING count(*) >= 2) SELECT round(avg((a + b) / 2), 6) AS mean, round(covar_pop(a, b), 6) AS covariance FROM p")
def cov_samples(spark, d):
    rows = tab(spark, d, "lineitem").selectExpr("l_partkey % 150 AS sample_id", "l_quantity * (1 + l_partkey % 150) AS value", f"{_DRAW} AS draw")
    return rd.sampled_covariance(rows, "draw")


def _clusters(spark, d):
    return ad.aln(spark, d).withColumn("cluster_end", F.col("read_end"))


@query(f"WITH {ALN} SELECT cluster_id, read_end::BIGINT AS cluster_end, ref_name, strand, min(s) AS s, max(e) AS e FROM aln WHERE cluster_id IN (SELECT cluster_id FROM aln GROUP BY 1 HAVING count(DISTINCT read_end) = 2) GROUP BY ALL")
def cluster_regions(spark, d):
    from weftline.operators.clusters import regions

    return regions(_clusters(spark, d))


_BREAKS = "brk AS (SELECT cluster_id, read_end AS cluster_end, max(e) + 10 AS break_pos FROM aln GROUP BY ALL)"
_SPAN = f"{ALN}, {_BREAKS}, sp AS (SELECT a.cluster_id, a.fragment, sum(CASE WHEN a.strand = '+' THEN b.break_pos - a.s + 1 ELSE a.e - b.break_pos + 1 END) + 3 AS length FROM aln a JOIN brk b ON a.cluster_id = b.cluster_id AND a.read_end = b.cluster_end GROUP BY ALL), ss AS (SELECT cluster_id, avg(length) AS mean_length, count(*)::BIGINT AS n_fragments FROM sp GROUP BY 1)"


def _span(spark, d):
    from weftline.operators.clusters import span_stats as stats

    rows = _clusters(spark, d)
    breaks = rows.groupBy("cluster_id", "cluster_end").agg((F.max("e") + 10).alias("break_pos"))
    return stats(rows, breaks, F.lit(3))


@query(f"WITH {_SPAN} SELECT cluster_id, round(mean_length, 6) AS mean_length, n_fragments FROM ss")
def span_stats(spark, d):
    return _span(spark, d)


@query(f"WITH {ALN}, {_ISLANDS.format(k='cluster_id, ref_name', t='aln', g=1)}, i AS (SELECT cluster_id, ref_name, island, max(e) - min(s) + 1 AS len FROM n GROUP BY ALL) SELECT cluster_id, round(sum(len)::DOUBLE / 350, 6) AS span_coverage FROM i GROUP BY 1")
def span_coverage(spark, d):
    merged = ij.islands(ad.aln(spark, d), ["cluster_id", "ref_name"])
    return merged.groupBy("cluster_id").agg((F.sum(F.col("e") - F.col("s") + 1) / F.lit(350)).alias("span_coverage"))


@query(f"WITH {ALN} SELECT cluster_id, count(DISTINCT fragment)::BIGINT AS span_count FROM aln GROUP BY 1")
def span_count(spark, d):
    return ad.aln(spark, d).groupBy("cluster_id").agg(F.countDistinct("fragment").alias("span_count"))


@query(f"WITH {HITS} SELECT cluster_id, round(max(matches::DOUBLE / q_size), 6) AS pid FROM hits WHERE t_gap_bases <= 900 GROUP BY 1")
def max_pid(spark, d):
    return rs.max_identity(ad.hits(spark, d), 900)


@query(f"WITH {HITS} SELECT cluster_id, max(CASE WHEN q_start = 1 THEN q_end END)::BIGINT AS max_left_end, min(CASE WHEN q_end = q_size THEN q_start END)::BIGINT AS min_right_start FROM hits WHERE matches::DOUBLE / (q_end - q_start + 1) >= 0.9 GROUP BY 1")
def overlap_extents(spark, d):
    return rs.overlap_extents(ad.hits(spark, d))


_FUSIONS = "f AS (SELECT DISTINCT cluster_id, fragment, concat('g', (s % 7)::VARCHAR) AS gene1, strand AS strand1, s % 11 AS pos1, concat('g', (e % 7)::VARCHAR) AS gene2, CASE WHEN line % 2 = 0 THEN '+' ELSE '-' END AS strand2, e % 13 AS pos2 FROM aln)"


def _fusions(spark, d):
    return ad.aln(spark, d).selectExpr("cluster_id", "fragment", "concat('g', cast(s % 7 as string)) AS gene1", "strand AS strand1", "s % 11 AS pos1", "concat('g', cast(e % 7 as string)) AS gene2", "CASE WHEN line % 2 = 0 THEN '+' ELSE '-' END AS strand2", "e % 13 AS pos2").distinct()


@query(f"""WITH {ALN}, {_FUSIONS}, o AS (SELECT *, (gene1, strand1, pos1) <= (gene2, strand2, pos2) AS up FROM f),
p AS (SELECT *, CASE WHEN up THEN concat_ws(':', gene1, strand1, gene2, strand2) ELSE concat_ws(':', gene2, strand2, gene1, strand1) END AS pair, CASE WHEN up THEN concat_ws(':', pos1, pos2) ELSE concat_ws(':', pos2, pos1) END AS pt FROM o)
SELECT cluster_id, fragment, pos1, pos2, (SELECT count(DISTINCT q.pt) FROM p q WHERE q.pair = p.pair)::BIGINT AS num_splice_variants FROM p""")
def splice_variants(spark, d):
    return rs.splice_variants(_fusions(spark, d)).select("cluster_id", "fragment", "pos1", "pos2", "num_splice_variants")


@query(f"WITH {ALN}, {MEMBER}, {_COUNTS}, p AS (SELECT fragment, coalesce(max(CASE WHEN read_end = 0 THEN n_alignments END), 1) * coalesce(max(CASE WHEN read_end = 1 THEN n_alignments END), 1) AS n FROM c GROUP BY 1) SELECT cluster_id, min(n)::BIGINT AS min_map_count, max(n)::BIGINT AS max_map_count, round(avg(n), 6) AS mean_map_count, count(*) FILTER (n > 1)::BIGINT AS num_multi_map FROM member JOIN p USING (fragment) GROUP BY 1")
def mapping_stats(spark, d):
    return rs.mapping_stats(ad.member(spark, d), rd.alignment_counts(ad.aln(spark, d), ["fragment", "read_end"]))


# --- islands and windows -------------------------------------------------------------------


@query(f"WITH {ALN}, {_ISLANDS.format(k='ref_name', t='aln', g=1)} SELECT ref_name, min(s) AS s, max(e) AS e, count(*)::BIGINT AS n FROM n GROUP BY ref_name, island")
def merge_islands(spark, d):
    return ij.islands(ad.aln(spark, d), ["ref_name"]).drop("island")


@query(f"WITH {ALN}, ev AS (SELECT ref_name, s AS pt, 1 AS x FROM aln UNION ALL SELECT ref_name, e + 1, -1 FROM aln), g AS (SELECT ref_name, pt, sum(x) AS x FROM ev GROUP BY ALL), w AS (SELECT ref_name, pt AS s, lead(pt) OVER (PARTITION BY ref_name ORDER BY pt) - 1 AS e, sum(x) OVER (PARTITION BY ref_name ORDER BY pt) AS depth FROM g) SELECT ref_name, s, e, depth::BIGINT AS depth FROM w WHERE depth > 0")
def exonic_coverage(spark, d):
    return ij.depth(ad.aln(spark, d), ["ref_name"])


@query(f"WITH {ALN}, {GENE} SELECT a.fragment, a.line::BIGINT AS line, a.s, round(max(least(a.e, g.ge) - greatest(a.s, g.gs) + 1)::DOUBLE / (a.e - a.s + 1), 6) AS repeat_proportion FROM aln a JOIN gene g ON {_OVER} GROUP BY a.fragment, a.line, a.s, a.e")
def repeat_proportion(spark, d):
    size = iv.overlap_size(F.col("s"), F.col("e"), F.col("gs"), F.col("ge"))
    return _hits(spark, d).groupBy("fragment", "line", "s", "e").agg(F.max(size).alias("size")).select("fragment", "line", "s", (F.col("size") / iv.length(F.col("s"), F.col("e"))).alias("repeat_proportion"))


@query(f"WITH {MEMBER} SELECT fragment, cluster_id, (dense_rank() OVER (ORDER BY cluster_id % 4, cluster_id) - 1)::BIGINT AS new_id FROM member")
def renumber(spark, d):
    from weftline.operators.clusters import renumbered

    rows = ad.member(spark, d).withColumn("part", F.col("cluster_id") % 4)
    return renumbered(rows, ["part", "cluster_id"]).select("fragment", "cluster_id", "new_id")


@query(f"WITH {ALN}, w AS (SELECT cluster_id, fragment, min(CASE WHEN read_end = 0 THEN CASE WHEN strand = '+' THEN s ELSE e END END) AS p0, min(CASE WHEN read_end = 1 THEN CASE WHEN strand = '+' THEN s ELSE e END END) AS p1 FROM aln GROUP BY ALL) SELECT cluster_id, p0, p1, min(fragment) AS fragment FROM w GROUP BY ALL")
def dedupe_positions(spark, d):
    from weftline.operators.clusters import dedupe_positions as run

    return run(_clusters(spark, d))


@query(f"WITH {ALN}, r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id, fragment ORDER BY s, e, ref_name, strand) AS k FROM aln) SELECT cluster_id, fragment, s, e FROM r WHERE k = 1")
def first_per_cluster(spark, d):
    return rd.first_per_position(ad.aln(spark, d), ["cluster_id", "fragment"], ["s", "e", "ref_name", "strand"]).select("cluster_id", "fragment", "s", "e")


@query(f"WITH {GENE}, g2 AS (SELECT *, gs AS s, gs + (ge - gs) // 25 AS e FROM gene), {_ISLANDS.format(k='chromosome', t='g2', g=0)} SELECT DISTINCT a.chromosome, least(a.gene_id, b.gene_id) AS gene1, greatest(a.gene_id, b.gene_id) AS gene2 FROM n a JOIN n b ON a.chromosome = b.chromosome AND a.gene_id <> b.gene_id AND b.island - a.island IN (0, 1)")
def gene_adjacency(spark, d):
    genes = ad.gene(spark, d).withColumn("e", F.col("gs") + F.floor((F.col("ge") - F.col("gs")) / 25))
    return ij.adjacency(genes, "chromosome", "gene_id", ("gs", "e"))


@query(f"WITH {MEMBER} SELECT cluster_id, count(*)::BIGINT AS n, min(fragment) AS first_fragment FROM member GROUP BY 1")
def group_iterator(spark, d):
    return ad.member(spark, d).groupBy("cluster_id").agg(F.count("*").alias("n"), F.min("fragment").alias("first_fragment"))


@query(f"WITH {ALN} SELECT cluster_id, fragment, s, line::BIGINT AS line, sum(e - s + 1) OVER (PARTITION BY cluster_id ORDER BY s DESC, fragment, line, e, strand ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM aln")
def prefix_sum(spark, d):
    order = Window.partitionBy("cluster_id").orderBy(F.desc("s"), "fragment", "line", "e", "strand").rowsBetween(Window.unboundedPreceding, 0)
    return ad.aln(spark, d).select("cluster_id", "fragment", "s", "line", F.sum(iv.length(F.col("s"), F.col("e"))).over(order).alias("running"))


@query(f"""WITH RECURSIVE {ALN}, k AS (SELECT *, row_number() OVER (PARTITION BY fragment, read_end ORDER BY line, ref_name, s, e, strand, cluster_id) AS n, list_transform(range(s // 2000, e // 2000 + 1), lambda b: concat(ref_name, ':', b)) AS own FROM aln),
  r AS (SELECT fragment, read_end, ref_name, s, e, n, own AS taken, TRUE AS kept FROM k WHERE n = 1
    UNION ALL SELECT k.fragment, k.read_end, k.ref_name, k.s, k.e, k.n, CASE WHEN list_has_any(r.taken, k.own) THEN r.taken ELSE list_concat(r.taken, k.own) END, NOT list_has_any(r.taken, k.own) FROM r JOIN k ON k.fragment = r.fragment AND k.read_end = r.read_end AND k.n = r.n + 1)
  SELECT fragment, read_end::BIGINT AS read_end, ref_name, s, e FROM r WHERE kept""")
def first_non_overlapping(spark, d):
    return rd.non_overlapping(ad.aln(spark, d), ["fragment", "read_end"], 2000, ["line", "ref_name", "s", "e", "strand"]).select("fragment", "read_end", "ref_name", "s", "e")


# --- sequences -----------------------------------------------------------------------------


_PAIR = "regexp_replace(sequence, '{p}', '', 'g')"
_P = "((length(sequence) - length(" + _PAIR + "))::DOUBLE / 2 / (length(sequence) - 1))"
_ENTROPY = " + ".join(f"CASE WHEN {_P.format(p=p)} > 0 THEN -{_P.format(p=p)} * log2({_P.format(p=p)}) ELSE 0 END" for p in sq.PAIRS)


@query(f"WITH {SEQ} SELECT seq_id, round({_ENTROPY}, 6) AS entropy FROM seq WHERE length(sequence) > 1")
def entropy(spark, d):
    return ad.seq(spark, d).where(F.length("sequence") > 1).select("seq_id", sq.pair_entropy(F.col("sequence")).alias("entropy"))


_REV = "reverse(translate({x}, 'ACGTacgt', 'TGCAtgca'))"


@query(f"WITH {SEQ} SELECT seq_id, {_REV.format(x='sequence')} AS rc FROM seq")
def revcomp(spark, d):
    return ad.seq(spark, d).select("seq_id", sq.reverse_complement(F.col("sequence")).alias("rc"))


_FOUR = "concat(substring(sequence, 1, 2), substring(sequence, 5, 2))"


@query(f"WITH {SEQ}, f AS (SELECT seq_id, {_FOUR} AS x FROM seq WHERE length(sequence) >= 6) SELECT seq_id, (4 - least(hamming(x, 'GTAG'), hamming(x, 'ATAC'), hamming({_REV.format(x='x')}, 'GTAG'), hamming({_REV.format(x='x')}, 'ATAC')))::BIGINT AS splice_score FROM f")
def hamming_splice(spark, d):
    rows = ad.seq(spark, d).where(F.length("sequence") >= 6)
    return rows.select("seq_id", sq.splice_score(F.substring("sequence", 1, 2), F.substring("sequence", 5, 2)).alias("splice_score"))


@query(f"WITH {HITS} SELECT query, block::BIGINT AS block, greatest(q_end - q_start - matches + 1, 0)::BIGINT AS homology FROM hits")
def homology(spark, d):
    return ad.hits(spark, d).select("query", "block", fu.homology(F.col("q_end") - F.col("q_start"), F.col("matches")).alias("homology"))


@query(f"WITH {HITS} SELECT x.query, x.block::BIGINT AS b1, y.block::BIGINT AS b2, ((x.q_start - y.q_start) % 3 + 3) % 3 = ((x.t_start - y.t_start) % 3 + 3) % 3 AS in_frame FROM hits x JOIN hits y ON x.query = y.query AND x.cluster_id = y.cluster_id AND x.block < y.block")
def frame_match(spark, d):
    rows = ad.hits(spark, d)
    x = rows.select("query", "cluster_id", F.col("block").alias("b1"), F.col("q_start").alias("q1"), F.col("t_start").alias("t1"))
    y = rows.select("query", "cluster_id", F.col("block").alias("b2"), F.col("q_start").alias("q2"), F.col("t_start").alias("t2"))
    return x.join(y, ["query", "cluster_id"]).where("b1 < b2").select("query", "b1", "b2", fu.in_frame(F.col("q1"), F.col("q2"), F.col("t1"), F.col("t2")).alias("in_frame"))


@query(f"WITH {HITS} SELECT query, block::BIGINT AS block, round(greatest(0, 1 - (1 - matches::DOUBLE / q_size) * q_size / least(q_end, 45)), 6) AS adjusted FROM hits")
def adjusted_pid(spark, d):
    return ad.hits(spark, d).select("query", "block", fu.adjusted_identity(F.col("matches") / F.col("q_size"), F.col("q_size"), F.col("q_end"), F.lit(45)).alias("adjusted"))


@query(f"WITH {SEQ}, j AS (SELECT seq_id, concat(substring(sequence, 1, 15), '|', substring(sequence, 16)) AS j FROM seq) SELECT seq_id, substring(j, greatest(instr(j, '|') - 10, 1), instr(j, '|') - greatest(instr(j, '|') - 10, 1)) AS left_side, substring(j, instr(j, '|') + 1, 10) AS right_side FROM j")
def junction_context(spark, d):
    joined = F.concat(F.substring("sequence", 1, 15), F.lit("|"), F.expr("substring(sequence, 16)"))
    left, right = sq.junction_context(F.col("j"), 10)
    return ad.seq(spark, d).select("seq_id", joined.alias("j")).select("seq_id", left.alias("left_side"), right.alias("right_side"))


@query(f"WITH {SEQ} SELECT sequence[i:i + 7] AS kmer, count(*)::BIGINT AS n FROM (SELECT sequence, unnest(range(1, length(sequence) - 6)) AS i FROM seq) GROUP BY 1")
def kmer_counts(spark, d):
    from weftline.operators.alignment import kmer_counts as run

    return run(ad.seq(spark, d), "sequence", 8)


_SOLEXA = "list_aggregate([chr(33 + floor(10 * log10(1 + 10 ** ((ascii(c) - 64) / 10.0::DOUBLE)) + 0.499::DOUBLE)::INT) FOR c IN string_split(q, '')], 'string_agg', '')"


@query(f"SELECT p_partkey, {_SOLEXA} AS quality FROM (SELECT p_partkey, translate(concat(p_partkey::VARCHAR, p_size::VARCHAR), '0123456789', '<?DJPVZ_dh') AS q FROM part)")
def solexa_quality(spark, d):
    q = F.translate(F.concat(F.col("p_partkey").cast("string"), F.col("p_size").cast("string")), "0123456789", "<?DJPVZ_dh")
    return tab(spark, d, "part").select("p_partkey", sq.sanger_quality(q).alias("quality"))


@query("SELECT concat(concat_ws(':', 'm', p_size, p_partkey % 8, 1, 2, 3), '/', 1 + p_partkey % 2) AS name, translate(concat('AC.G', p_size), '.', 'N') AS sequence FROM part WHERE p_partkey % 3 <> 0")
def qseq_filter(spark, d):
    rows = tab(spark, d, "part").selectExpr("'m' AS machine", "p_size AS run", "p_partkey % 8 AS lane", "1 AS tile", "2 AS x", "3 AS y", "0 AS index", "1 + p_partkey % 2 AS read_no", "concat('AC.G', p_size) AS seq", "'hhhh' AS qual", "p_partkey % 3 AS passed")
    return readers.qseq_rows(rows).select("name", "sequence")


@query(f"WITH {SEQ} SELECT seq_id AS id, concat(substring(sequence, 1, 5), substring(sequence, 1, 9), '|', substring(sequence, 14), 'TT') AS junction FROM seq")
def junction_sequence(spark, d):
    from weftline.operators.alignment import junction_sequence as run

    s = F.col("sequence")
    return ad.seq(spark, d).select(F.col("seq_id").alias("id"), run(F.substring(s, 1, 5), s, F.lit(9), s, F.lit(12), F.lit("TT")).alias("junction"))


@query(f"WITH {SEQ} SELECT seq_id, CASE WHEN 4 - seq_id % 9 < 1 THEN substring(sequence, 1, greatest(12 + (4 - seq_id % 9) - 1, 0)::INT) ELSE substring(sequence, (4 - seq_id % 9)::INT, 12) END AS piece FROM seq")
def local_windows(spark, d):
    return ad.seq(spark, d).select("seq_id", sq.window(F.col("sequence"), (4 - F.col("seq_id") % 9).cast("int"), F.lit(12)).alias("piece"))


@query(f"WITH {SEQ} SELECT seq_id, rpad(concat(repeat('N', greatest(least(1 - (4 - seq_id % 9), 12), 0)::INT), CASE WHEN 4 - seq_id % 9 < 1 THEN substring(sequence, 1, greatest(12 + (4 - seq_id % 9) - 1, 0)::INT) ELSE substring(sequence, (4 - seq_id % 9)::INT, 12) END), 12, 'N') AS piece FROM seq")
def padded_windows(spark, d):
    return ad.seq(spark, d).select("seq_id", sq.window(F.col("sequence"), (4 - F.col("seq_id") % 9).cast("int"), F.lit(12), pad=True).alias("piece"))


# --- coordinates ---------------------------------------------------------------------------

_TPOS = "p AS (SELECT p_partkey AS transcript_id, (p_size * 3 - 10)::BIGINT AS t_pos FROM part)"
_GPOS = "p AS (SELECT p_partkey AS transcript_id, (p_partkey * 200 + p_size * 7 - 20)::BIGINT AS g_pos FROM part)"


@query(f"WITH {OFF}, {_TPOS} SELECT transcript_id, t_pos, chromosome, CASE WHEN strand = '+' THEN s + t_pos - ts ELSE e - (t_pos - ts) END AS g_pos FROM p JOIN off USING (transcript_id) WHERE t_pos BETWEEN ts AND te OR (ts = 1 AND t_pos < 1) OR (te = t_length AND t_pos > t_length)")
def remap_to_genome(spark, d):
    at = tab(spark, d, "part").selectExpr("p_partkey AS transcript_id", "cast(p_size * 3 - 10 as bigint) AS t_pos")
    return gm.to_genome(at, ad.exon(spark, d))


@query(f"WITH {OFF}, {_GPOS} SELECT transcript_id, g_pos, coalesce(min(CASE WHEN g_pos BETWEEN s AND e THEN CASE WHEN strand = '+' THEN g_pos - s + ts ELSE e - g_pos + ts END WHEN (strand = '+' AND s > g_pos) OR (strand <> '+' AND e < g_pos) THEN ts END), max(t_length))::BIGINT AS t_pos FROM p JOIN off USING (transcript_id) GROUP BY ALL")
def remap_to_transcript(spark, d):
    at = tab(spark, d, "part").selectExpr("p_partkey AS transcript_id", "cast(p_partkey * 200 + p_size * 7 - 20 as bigint) AS g_pos")
    return gm.to_transcript(at, ad.exon(spark, d))


@query(f"WITH {OFF}, {_GPOS} SELECT transcript_id, g_pos, CASE WHEN strand = '+' THEN g_pos - s + ts ELSE e - g_pos + ts END::BIGINT AS t_pos FROM p JOIN off USING (transcript_id) WHERE g_pos BETWEEN s AND e")
def remap_strict(spark, d):
    at = tab(spark, d, "part").selectExpr("p_partkey AS transcript_id", "cast(p_partkey * 200 + p_size * 7 - 20 as bigint) AS g_pos")
    return gm.to_transcript(at, ad.exon(spark, d), strict=True)


@query(f"WITH {OFF}, p AS (SELECT p_partkey AS transcript_id, (p_size - 5)::BIGINT AS rs, (p_size + 40)::BIGINT AS re FROM part), x AS (SELECT *, greatest(rs, ts) AS lo, least(re, te) AS hi FROM p JOIN off USING (transcript_id)) SELECT transcript_id, rs, re, chromosome, CASE WHEN strand = '+' THEN s + lo - ts ELSE e - (hi - ts) END AS gs, CASE WHEN strand = '+' THEN s + hi - ts ELSE e - (lo - ts) END AS ge FROM x WHERE lo <= hi")
def region_remap(spark, d):
    at = tab(spark, d, "part").selectExpr("p_partkey AS transcript_id", "cast(p_size - 5 as bigint) AS rs", "cast(p_size + 40 as bigint) AS re")
    return gm.region_to_genome(at, ad.exon(spark, d))


@query(f"WITH {EXON}, p AS (SELECT p_partkey AS transcript_id, (p_size % 5)::BIGINT AS exon_no, 4::BIGINT AS x_pos FROM part) SELECT transcript_id, exon_no, x_pos, CASE WHEN strand = '+' THEN s + 3 ELSE e - 3 END AS g_pos FROM p JOIN exon USING (transcript_id) WHERE k = exon_no")
def exon_remap(spark, d):
    at = tab(spark, d, "part").selectExpr("p_partkey AS transcript_id", "p_size % 5 AS exon_no", "cast(4 as bigint) AS x_pos")
    return gm.exon_position(at, ad.exon(spark, d))


@query(f"WITH {EXON} SELECT gene_id, chromosome, strand, min(s) AS gs, max(e) AS ge, count(*)::BIGINT AS n_exons FROM exon GROUP BY ALL")
def gene_regions(spark, d):
    return gm.gene_regions(ad.exon(spark, d))


_UTR = f"{EXON}, cds AS (SELECT transcript_id, min(s) + 5 AS cs, max(e) - 5 AS ce FROM exon GROUP BY 1), utr AS (SELECT transcript_id, gene_id, chromosome, s, least(e, cs - 1) AS e, CASE WHEN strand = '+' THEN 'utr5p' ELSE 'utr3p' END AS side FROM exon JOIN cds USING (transcript_id) WHERE s < cs UNION ALL SELECT transcript_id, gene_id, chromosome, greatest(s, ce + 1), e, CASE WHEN strand = '+' THEN 'utr3p' ELSE 'utr5p' END FROM exon JOIN cds USING (transcript_id) WHERE e > ce)"


def _cds(exons):
    return exons.groupBy("transcript_id").agg((F.min("s") + 5).alias("s"), (F.max("e") - 5).alias("e"))


@query(f"WITH {_UTR} SELECT transcript_id, chromosome, s, e, side FROM utr")
def utr_parts(spark, d):
    exons = ad.exon(spark, d)
    return gm.utrs(exons, _cds(exons))


@query(f"""WITH {_UTR}, g AS (SELECT gene_id, any_value(strand) AS strand, min(s) AS gs, max(e) AS ge FROM exon GROUP BY 1),
part2 AS (SELECT gene_id, 'coding' AS side, greatest(s, cs) AS ps, least(e, ce) AS pe FROM exon JOIN cds USING (transcript_id) WHERE greatest(s, cs) <= least(e, ce) UNION ALL SELECT gene_id, side, s, e FROM utr),
p AS (SELECT DISTINCT p_partkey // 3 AS gene_id, (p_partkey * 200 + p_size * 8 - 60)::BIGINT AS pos FROM part)
SELECT p.gene_id, pos, CASE WHEN pos < gs THEN CASE WHEN strand = '+' THEN 'upstream' ELSE 'downstream' END WHEN pos > ge THEN CASE WHEN strand = '+' THEN 'downstream' ELSE 'upstream' END
  ELSE coalesce((SELECT ['coding', 'utr5p', 'utr3p'][1 + min(CASE side WHEN 'coding' THEN 0 WHEN 'utr5p' THEN 1 ELSE 2 END)] FROM part2 x WHERE x.gene_id = p.gene_id AND p.pos BETWEEN x.ps AND x.pe), 'intron') END AS location
FROM p JOIN g USING (gene_id)""")
def gene_location(spark, d):
    exons = ad.exon(spark, d)
    cds = _cds(exons).withColumnsRenamed({"s": "cs", "e": "ce"})
    coding = exons.join(cds, "transcript_id").select("gene_id", F.lit("coding").alias("side"), F.greatest("s", "cs").alias("ps"), F.least("e", "ce").alias("pe")).where("ps <= pe")
    utrs = gm.utrs(exons, _cds(exons)).join(exons.select("transcript_id", "gene_id").distinct(), "transcript_id").select("gene_id", "side", F.col("s").alias("ps"), F.col("e").alias("pe"))
    genes = exons.groupBy("gene_id").agg(F.min("strand").alias("strand"), F.min("s").alias("gs"), F.max("e").alias("ge"))
    at = tab(spark, d, "part").selectExpr("p_partkey div 3 AS gene_id", "cast(p_partkey * 200 + p_size * 8 - 60 as bigint) AS pos")
    return gm.gene_locations(at, genes, coding.unionByName(utrs), 500)


@query(f"WITH {EXON} SELECT transcript_id, string_agg(concat(s, '-', e), ',' ORDER BY s) AS exons, sum(e - s + 1)::BIGINT AS total FROM exon GROUP BY 1")
def sorted_exons(spark, d):
    rows = gm.exon_arrays(ad.exon(spark, d))
    return rows.select("transcript_id", F.array_join(F.transform("exons", lambda x: F.concat_ws("-", x["start"], x["end"])), ",").alias("exons"), iv.regions_length(F.col("exons")).alias("total"))


@query(f"WITH {EXON} SELECT transcript_id, sum(e - s + 1)::BIGINT AS total FROM exon GROUP BY 1")
def regions_length(spark, d):
    return gm.exon_arrays(ad.exon(spark, d)).select("transcript_id", iv.regions_length(F.col("exons")).alias("total"))


# --- functions -----------------------------------------------------------------------------


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line, round({st.normal_cdf_sql('((s - 20000) / 9000.0::DOUBLE)')}, 6) AS p FROM aln")
def normal_cdf(spark, d):
    rows = ad.aln(spark, d).withColumn("z", (F.col("s") - 20000) / F.lit(9000.0))
    return rows.select("fragment", "line", st.normal_cdf("z").alias("p"))


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line, round(exp(-((s - 20000.0::DOUBLE) * (s - 20000.0::DOUBLE)) / (2 * 90.0::DOUBLE * 90)) / (90 * sqrt(2 * pi())), 6) AS p FROM aln")
def normal_pdf(spark, d):
    return ad.aln(spark, d).select("fragment", "line", st.normal_pdf(F.col("s"), 20000.0, 90.0).alias("p"))


@query(f"WITH {_SPAN} SELECT cluster_id, round({st.span_pvalue_sql('mean_length', 'n_fragments', 300.0, 4000.0, 9000.0, 120)}, 6) AS pvalue FROM ss")
def span_pvalue(spark, d):
    return _span(spark, d).select("cluster_id", F.expr(st.span_pvalue_sql("mean_length", "n_fragments", 300.0, 4000.0, 9000.0, 120)).alias("pvalue"))


_SPLITS = "sa AS (SELECT l_suppkey AS fusion_id, l_orderkey AS fragment, (l_linenumber % 2)::INT AS read_end, (l_partkey % 6)::INT AS ref_split1, (l_orderkey % 4)::INT AS ref_split2, (10 + l_linenumber)::INT AS read_split1, (40 - l_linenumber)::INT AS read_split2, l_quantity::INT AS score FROM lineitem)"


def _splits(spark, d):
    return tab(spark, d, "lineitem").selectExpr("l_suppkey AS fusion_id", "l_orderkey AS fragment", "cast(l_linenumber % 2 as int) AS read_end", "cast(l_partkey % 6 as int) AS ref_split1", "cast(l_orderkey % 4 as int) AS ref_split2", "cast(10 + l_linenumber as int) AS read_split1", "cast(40 - l_linenumber as int) AS read_split2", "cast(l_quantity as int) AS score")


@query(f"WITH {_SPLITS}, g AS (SELECT fusion_id, ref_split1, ref_split2, sum(score) AS total, count(*) AS split_count, avg(read_split1) AS mean_left, avg(read_split2) AS mean_right FROM sa GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY fusion_id ORDER BY total DESC, ref_split1, ref_split2) AS k FROM g) SELECT fusion_id, ref_split1::BIGINT AS ref_split1, ref_split2::BIGINT AS ref_split2, total::BIGINT AS total, split_count::BIGINT AS split_count, round(mean_left, 6) AS mean_left, round(mean_right, 6) AS mean_right FROM r WHERE k = 1")
def best_split(spark, d):
    from weftline.operators.alignment import best_splits

    return best_splits(_splits(spark, d))


_SPOS = "greatest(read_split1 - 4, 0)::DOUBLE / (read_split1 + read_split2 - 8)"
_SMIN = "greatest(least(read_split1, read_split2) - 4, 0)::DOUBLE / floor((read_split1 + read_split2 - 8)::DOUBLE / 2)"


@query(f"WITH {_SPLITS} SELECT fusion_id, fragment, score::BIGINT AS score, round({_SPOS}, 6) AS split_pos, round({_SMIN}, 6) AS split_min FROM sa")
def split_pos_min(spark, d):
    pos, least = fu.split_position(F.col("read_split1"), F.col("read_split2"))
    return _splits(spark, d).select("fusion_id", "fragment", "score", pos.alias("split_pos"), least.alias("split_min"))


@query(f"WITH {_SPLITS} SELECT fusion_id, count(*)::BIGINT AS split_count, round(avg({_SPOS}), 6) AS split_pos_avg, round(avg({_SMIN}), 6) AS split_min_avg FROM sa GROUP BY 1")
def split_averages(spark, d):
    pos, least = fu.split_position(F.col("read_split1"), F.col("read_split2"))
    return _splits(spark, d).groupBy("fusion_id").agg(F.count("*").alias("split_count"), F.avg(pos).alias("split_pos_avg"), F.avg(least).alias("split_min_avg"))


@query(f"WITH {_SPLITS}, a AS (SELECT fusion_id, count(*) AS n, avg({_SPOS}) AS x, avg({_SMIN}) AS y FROM sa GROUP BY 1) SELECT fusion_id, round({st.split_pvalue_sql('x', 'n', 0.5, 0.02, True)}, 6) AS pos_pvalue, round({st.split_pvalue_sql('y', 'n', 0.5, 0.02, False)}, 6) AS min_pvalue FROM a")
def split_pvalues(spark, d):
    pos, least = fu.split_position(F.col("read_split1"), F.col("read_split2"))
    rows = _splits(spark, d).groupBy("fusion_id").agg(F.count("*").alias("n"), F.avg(pos).alias("x"), F.avg(least).alias("y"))
    return rows.select("fusion_id", F.expr(st.split_pvalue_sql("x", "n", 0.5, 0.02, True)).alias("pos_pvalue"), F.expr(st.split_pvalue_sql("y", "n", 0.5, 0.02, False)).alias("min_pvalue"))


@query(f"WITH {_SPLITS}, r AS (SELECT *, max(score) OVER (PARTITION BY fusion_id) AS top FROM sa) SELECT fusion_id, fragment, score::BIGINT AS score FROM r WHERE score = top")
def all_ties(spark, d):
    best = _splits(spark, d).groupBy("fusion_id").agg(F.max("score").alias("score"))
    return _splits(spark, d).join(best, ["fusion_id", "score"]).select("fusion_id", "fragment", "score")


@query(f"WITH {_SPLITS} SELECT DISTINCT fusion_id, fragment, read_end::BIGINT AS read_end FROM sa")
def candidate_dedupe(spark, d):
    return _splits(spark, d).select("fusion_id", "fragment", "read_end").distinct()


@query(f"WITH {ALN}, {GENE} SELECT a.fragment, a.line::BIGINT AS line, a.s, g.gene_id, a.s >= g.gs AND a.e <= g.ge AS inside, greatest(least(a.e, g.ge) - greatest(a.s, g.gs) + 1, 0)::BIGINT AS size FROM aln a JOIN gene g ON g.gene_id = a.cluster_id")
def interval_predicates(spark, d):
    rows = ad.aln(spark, d).join(ad.gene(spark, d), F.col("cluster_id") == F.col("gene_id"))
    at = [F.col(c) for c in ("gs", "ge", "s", "e")]
    return rows.select("fragment", "line", "s", "gene_id", iv.contains(*at).alias("inside"), iv.overlap_size(*at).alias("size"))


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line, s, unnest(range(s // 16, e // 16 + 1))::BIGINT AS bin FROM aln")
def bins(spark, d):
    return ad.aln(spark, d).select("fragment", "line", "s", F.explode(iv.bins(F.col("s"), F.col("e"), 16)).alias("bin"))


@query(f"WITH {HITS} SELECT query, block::BIGINT AS block, round((matches::DOUBLE / (q_end + 1) + 1) / (t_gap_bases::DOUBLE / (q_size + 1) + 1), 6) AS interrupted_index, round(matches::DOUBLE / q_end, 6) AS splicing_index FROM hits")
def index_ratio(spark, d):
    c = F.col
    return ad.hits(spark, d).select("query", "block", fu.index_ratio(c("matches"), c("q_end"), c("t_gap_bases"), c("q_size")).alias("interrupted_index"), fu.splicing_index(c("matches"), c("q_end")).alias("splicing_index"))


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line, CASE WHEN strand = '+' THEN s ELSE least(s, s + 20 - line * 9) END AS fs, CASE WHEN strand = '+' THEN greatest(e, s + 20 - line * 9) ELSE e END AS fe FROM aln")
def fusion_region(spark, d):
    s, e = fu.fusion_region(F.col("strand"), F.col("s"), F.col("e"), F.col("s") + 20 - F.col("line") * 9)
    return ad.aln(spark, d).select("fragment", "line", s.alias("fs"), e.alias("fe"))


@query(f"WITH {ALN}, t AS (SELECT *, CASE WHEN strand = '+' THEN e ELSE -s END AS top, CASE WHEN strand = '+' THEN s ELSE -e END AS low FROM aln) SELECT fragment, line::BIGINT AS line, (top + 1)::BIGINT AS bs, (2 * (top + 1) - (top - low + 1) - 1 - 2 + 260)::BIGINT AS be FROM t")
def break_region(spark, d):
    s, e = fu.break_region(F.col("strand"), F.col("s"), F.col("e"), 200.0, 20.0)
    return ad.aln(spark, d).select("fragment", "line", s.alias("bs"), e.alias("be"))


@query(f"WITH {FLAGS} SELECT fragment, split_part(rname, '|', 1) AS gene, split_part(rname, '|', 2) AS transcript FROM flags")
def id_split(spark, d):
    return ad.flags(spark, d).select("fragment", sq.gene_of(F.col("rname")).alias("gene"), sq.transcript_of(F.col("rname")).alias("transcript"))


@query(f"WITH {MEMBER} SELECT fragment, string_agg(cluster_id::VARCHAR, ',' ORDER BY cluster_id) AS clusters FROM member GROUP BY 1")
def transpose(spark, d):
    return ad.member(spark, d).groupBy("fragment").agg(F.array_join(F.array_sort(F.collect_list("cluster_id")).cast("array<string>"), ",").alias("clusters"))


@query(f"""WITH {ALN}, {_FUSIONS}, x AS (SELECT *, gene1 = gene2 AS same, pos1 < pos2 AS up FROM f),
y AS (SELECT *, same AND strand1 = strand2 AS inv, same AND strand1 <> strand2 AND CASE WHEN up THEN strand1 ELSE strand2 END = '-' AND CASE WHEN up THEN strand2 ELSE strand1 END = '+' AS ev FROM x)
SELECT cluster_id, fragment, pos1, pos2, NOT same AS interchromosomal, inv AS inversion, ev AS eversion, same AND NOT inv AND NOT ev AS deletion, same AND NOT inv AND NOT ev AND pos1 % 2 = 0 AS read_through FROM y""")
def event_flags(spark, d):
    c = F.col
    found = fu.event_flags(c("gene1"), c("gene2"), c("strand1"), c("strand2"), c("pos1"), c("pos2"), c("pos1") % 2 == 0)
    return _fusions(spark, d).select("cluster_id", "fragment", "pos1", "pos2", *[v.alias(k) for k, v in found.items()])


# --- cluster level -------------------------------------------------------------------------


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line, cluster_id FROM aln WHERE cluster_id IN (SELECT cluster_id FROM aln GROUP BY 1 HAVING max(CASE WHEN ref_name = 'c3' THEN 1 ELSE 0 END) = 0 OR min(ref_name) = max(ref_name))")
def mito_segregate(spark, d):
    from weftline.operators.clusters import without_mixed_mt

    return without_mixed_mt(ad.aln(spark, d), "c3").select("fragment", "line", "cluster_id")


def _candidates(spark, d):
    """Distinct gene pairs that the two ends of a fragment overlap, with their support."""
    rows = ad.aln(spark, d).select("fragment", "read_end", "ref_name", "s", "e")
    hits = ij.overlap_join(rows, ad.gene(spark, d), [("ref_name", "chromosome")], ("s", "e"), ("gs", "ge"), 500).select("fragment", "read_end", "gene_id")
    hits = dealt(hits, "fragment").distinct()
    a, b = (hits.where(F.col("read_end") == k).select("fragment", F.col("gene_id").alias(f"g{k}")) for k in (0, 1))
    pairs = a.join(b, "fragment").where("g0 <> g1").select("fragment", F.least("g0", "g1").alias("gene1"), F.greatest("g0", "g1").alias("gene2"))
    return dealt(pairs.distinct(), "gene1", "gene2").groupBy("gene1", "gene2").agg(F.count("*").alias("support"))


_PAIRS = f"{ALN}, {GENE}, h AS (SELECT DISTINCT a.fragment, a.read_end, g.gene_id FROM aln a JOIN gene g ON {_OVER}), c AS (SELECT least(x.gene_id, y.gene_id) AS gene1, greatest(x.gene_id, y.gene_id) AS gene2, count(DISTINCT x.fragment)::BIGINT AS support FROM h x JOIN h y ON x.fragment = y.fragment AND x.read_end = 0 AND y.read_end = 1 AND x.gene_id <> y.gene_id GROUP BY 1, 2)"


@query(f"WITH {_PAIRS} SELECT gene1, gene2, support FROM c WHERE support >= 2")
def fusion_candidates(spark, d):
    return _candidates(spark, d).where("support >= 2")


@query(f"WITH {_PAIRS} SELECT c.gene1, c.gene2, c.support FROM c JOIN gene a ON a.gene_id = c.gene1 JOIN gene b ON b.gene_id = c.gene2 WHERE a.chromosome <> b.chromosome AND NOT (a.gstrand = '-' AND b.gstrand = '-')")
def fusion_predicate(spark, d):
    genes = ad.gene(spark, d)
    side = lambda k: genes.select(F.col("gene_id").alias(f"gene{k}"), F.col("chromosome").alias(f"chr{k}"), F.col("gstrand").alias(f"st{k}"))
    rows = _candidates(spark, d).join(side(1), "gene1").join(side(2), "gene2")
    return rows.where("chr1 <> chr2 AND NOT (st1 = '-' AND st2 = '-')").select("gene1", "gene2", "support")


@query(f"WITH {MEMBER} SELECT cluster_id, count(*)::BIGINT AS n FROM member GROUP BY 1 ORDER BY n DESC, cluster_id LIMIT 1")
def largest_cluster(spark, d):
    return ad.member(spark, d).groupBy("cluster_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "cluster_id").limit(1)


@query(f"WITH {MEMBER}, n AS (SELECT cluster_id, count(*) AS n FROM member GROUP BY 1), f AS (SELECT m.fragment, m.cluster_id, row_number() OVER (PARTITION BY m.fragment ORDER BY n DESC, m.cluster_id) AS k FROM member m JOIN n USING (cluster_id)) SELECT fragment, cluster_id FROM f WHERE k = 1")
def top_cluster(spark, d):
    rows = ad.member(spark, d)
    sizes = rows.groupBy("cluster_id").agg(F.count("*").alias("n"))
    best = F.max_by("cluster_id", F.struct("n", -F.col("cluster_id"))).alias("cluster_id")
    return rows.join(sizes, "cluster_id").groupBy("fragment").agg(best)


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def top_k(spark, d):
    return tab(spark, d, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(20)


@query(f"WITH {MEMBER} SELECT cluster_id, count(*)::BIGINT AS n, min(fragment) AS lo, max(fragment) AS hi FROM member GROUP BY 1 ORDER BY 1")
def order_by_cluster(spark, d):
    return ad.member(spark, d).groupBy("cluster_id").agg(F.count("*").alias("n"), F.min("fragment").alias("lo"), F.max("fragment").alias("hi")).orderBy("cluster_id")


@query(f"WITH {ALN} SELECT ref_name, s, e, fragment FROM aln")
def range_sorted(spark, d):
    rows = ad.aln(spark, d).select("ref_name", "s", "e", "fragment")
    return rows.repartitionByRange("ref_name", "s").sortWithinPartitions("ref_name", "s", "e", "fragment")


@query(None)
def set_cover(spark, d):
    from weftline.operators.clusters import set_cover as run

    return run(ad.member(spark, d), 5)


@query("WITH RECURSIVE e AS (SELECT DISTINCT o_custkey % 400 AS a, 1000 + o_custkey % 7 * 50 + o_custkey % 400 % 50 AS b FROM orders), b2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(v, w) AS (SELECT a, a FROM b2 UNION SELECT b2.b, r.w FROM r JOIN b2 ON b2.a = r.v) SELECT v::BIGINT AS vertex, min(w)::BIGINT AS component FROM r GROUP BY 1")
def components(spark, d):
    from weftline.operators.graphs import components as run

    edges = tab(spark, d, "orders").selectExpr("o_custkey % 400 AS u", "1000 + o_custkey % 7 * 50 + o_custkey % 400 % 50 AS v").distinct()
    return run(edges)


@query(None)
def em_clusters(spark, d):
    """The mixture model on every pair of bins that fragments join."""
    from weftline.operators.clusters import discordant_clusters
    from weftline.plans.pipeline import BIN_PAIR, binned_pairs

    pairs = binned_pairs(ad.aln(spark, d), 600, 32768)
    return discordant_clusters(pairs, BIN_PAIR, 3000.0, 1000.0, least=5)


@query(None)
def kmeans_seed(spark, d):
    from weftline.operators.clusters import kmeans

    def solve(group):
        import numpy as np
        import pandas as pd

        group = group.sort_values("vec_id")
        x = np.stack(group["embedding"].to_numpy())
        labels = kmeans(x.astype(float), min(3, len(x)))[1]
        return pd.DataFrame({"label": group["label"], "vec_id": group["vec_id"], "centre": labels.astype("int64")})

    return tab(spark, d, "embeddings").groupBy("label").applyInPandas(solve, "label int, vec_id long, centre long")


@query(None)
def hier_cluster(spark, d):
    from weftline.operators.clusters import hierarchical

    return hierarchical(tab(spark, d, "embeddings").select("label", "vec_id", "embedding"), "label", "vec_id", "embedding", 1.2)


def _seq_pairs(spark, d):
    rows = ad.seq(spark, d).where(F.length("sequence") >= 20)
    return rows.select(F.col("seq_id").alias("id"), F.col("sequence").alias("reference"), F.concat(F.substring("sequence", 4, 10), F.substring("sequence", 15, 12)).alias("sequence"))


@query(None)
def local_align(spark, d):
    from weftline.operators.alignment import local_scores

    return local_scores(_seq_pairs(spark, d))


@query(None)
def split_align(spark, d):
    from weftline.operators.alignment import split_reads

    # the halves of every text, and a read of 12 letters of each, 3 and 6 letters off the middle
    half = F.floor(F.length("sequence") / 2).cast("int")
    rows = ad.seq(spark, d).where(F.length("sequence") >= 40).select("seq_id", "sequence", half.alias("half"))
    text, at = F.col("sequence"), F.col("half")
    read = F.concat(F.substring(text, at - 14, F.lit(12)), F.substring(text, at + 7, F.lit(12)))
    return split_reads(rows.select(F.col("seq_id").alias("fusion_id"), F.col("seq_id").alias("fragment"), F.lit(0).alias("read_end"), read.alias("read"), F.substring(text, F.lit(1), at).alias("ref1"), F.substring(text, at + 1, F.length(text)).alias("ref2")))


# --- joins on clusters and reads -----------------------------------------------------------


@query(f"WITH {ALN} SELECT a.fragment, a.line::BIGINT AS l0, b.line::BIGINT AS l1, b.ref_name AS mate_ref FROM aln a JOIN aln b ON a.fragment = b.fragment AND b.read_end = 1 - a.read_end")
def mate_lookup(spark, d):
    rows = ad.aln(spark, d)
    other = rows.select("fragment", (1 - F.col("read_end")).alias("read_end"), F.col("line").alias("l1"), F.col("ref_name").alias("mate_ref"))
    return rows.select("fragment", "read_end", F.col("line").alias("l0")).join(other, ["fragment", "read_end"]).select("fragment", "l0", "l1", "mate_ref")


@query(f"WITH {ALN}, x AS (SELECT ref_name AS gene, sum(0.5::DOUBLE) AS expression FROM aln WHERE strand = '+' GROUP BY 1) SELECT n_nationkey::BIGINT AS n_nationkey, round(coalesce(expression, 0), 6) AS expression FROM nation LEFT JOIN x ON gene = concat('c', n_nationkey::VARCHAR)")
def left_enrich(spark, d):
    counts = rd.expression(ad.aln(spark, d).where("strand = '+'"))
    nation = tab(spark, d, "nation").select("n_nationkey", F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("gene"))
    return nation.join(counts, "gene", "left").select("n_nationkey", F.coalesce("expression", F.lit(0.0)).alias("expression"))


@query(f"WITH {MEMBER}, b AS (SELECT s_suppkey AS cluster_id, floor(s_acctbal * 10)::BIGINT AS break_pos FROM supplier WHERE s_acctbal > 3000) SELECT cluster_id, fragment, break_pos FROM member JOIN b USING (cluster_id)")
def inner_break(spark, d):
    breaks = tab(spark, d, "supplier").where("s_acctbal > 3000").select(F.col("s_suppkey").alias("cluster_id"), F.floor(F.col("s_acctbal") * 10).cast("long").alias("break_pos"))
    return ad.member(spark, d).join(breaks, "cluster_id").select("cluster_id", "fragment", "break_pos")


@query(f"WITH {HITS} SELECT x.cluster_id, x.query, x.block::BIGINT AS b1, y.block::BIGINT AS b2, y.t_start - x.t_end AS gap FROM hits x JOIN hits y ON x.query = y.query AND x.cluster_id = y.cluster_id AND x.t_end < y.t_start")
def block_pairs(spark, d):
    rows = ad.hits(spark, d)
    x = rows.select("cluster_id", "query", F.col("block").alias("b1"), F.col("t_end").alias("x_end"))
    y = rows.select("cluster_id", "query", F.col("block").alias("b2"), F.col("t_start").alias("y_start"))
    return x.join(y, ["cluster_id", "query"]).where("x_end < y_start").select("cluster_id", "query", "b1", "b2", (F.col("y_start") - F.col("x_end")).alias("gap"))


@query(f"WITH {ALN}, r AS (SELECT cluster_id, strand, min(s) AS rs, max(e) AS re FROM aln GROUP BY ALL) SELECT a.fragment, a.line::BIGINT AS line, r.cluster_id FROM aln a JOIN r ON a.strand = r.strand AND a.s <= r.re AND r.rs <= a.e WHERE a.fragment IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey = r.cluster_id)")
def supporting_reads(spark, d):
    from weftline.plans.pipeline import supporting_reads as run

    rows = ad.aln(spark, d)
    regions = rows.groupBy("cluster_id", "strand").agg(F.min("s").alias("rs"), F.max("e").alias("re"))
    return run(rows, ad.member(spark, d), regions).select("fragment", "line", "cluster_id")


@query(f"WITH {MEMBER}, o AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY fragment) AS k FROM member) SELECT cluster_id, fragment, k::BIGINT AS k FROM o WHERE k IN (SELECT n_nationkey FROM nation)")
def ordinal_lookup(spark, d):
    rows = ad.member(spark, d).withColumn("k", F.row_number().over(Window.partitionBy("cluster_id").orderBy("fragment")))
    wanted = tab(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    return rows.join(wanted, "k", "left_semi").select("cluster_id", "fragment", "k")


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN coalesce(a.p, -1) >= coalesce(b.p, -1) THEN 'first' ELSE 'second' END AS chosen FROM (SELECT s_suppkey AS k, s_acctbal AS p FROM supplier WHERE s_suppkey % 3 <> 0) a FULL JOIN (SELECT s_suppkey AS k, s_acctbal * (s_suppkey % 5) / 2 AS p FROM supplier WHERE s_suppkey % 4 <> 0) b ON a.k = b.k")
def predictor_choice(spark, d):
    s = tab(spark, d, "supplier")
    a = s.where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("p1"))
    b = s.where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("k"), (F.col("s_acctbal") * (F.col("s_suppkey") % 5) / 2).alias("p2"))
    return a.join(b, "k", "full_outer").select("k", F.when(F.coalesce("p1", F.lit(-1.0)) >= F.coalesce("p2", F.lit(-1.0)), "first").otherwise("second").alias("chosen"))


@query(f"WITH {ALN} SELECT a.fragment, a.s AS s0, b.s AS s1 FROM aln a JOIN aln b ON a.fragment = b.fragment AND a.read_end = 0 AND b.read_end = 1 AND b.s BETWEEN a.s - 3000 AND a.s + 3000")
def mate_window(spark, d):
    rows = ad.aln(spark, d)
    a, b = (rows.where(F.col("read_end") == k).select("fragment", F.col("s").alias(f"s{k}")) for k in (0, 1))
    return a.join(b, "fragment").where("s1 BETWEEN s0 - 3000 AND s0 + 3000")


@query(f"WITH {ALN}, {EXON}, g AS (SELECT cluster_id, ref_name AS chromosome, min(s) + 9000 AS brk FROM aln GROUP BY ALL) SELECT g.cluster_id, g.chromosome, sum(CASE WHEN x.e < brk THEN x.e - x.s + 1 ELSE 0 END)::BIGINT AS size_before, sum(CASE WHEN x.s > brk THEN x.e - x.s + 1 ELSE 0 END)::BIGINT AS size_after FROM g JOIN exon x ON x.chromosome = g.chromosome GROUP BY ALL")
def interrupted_counts(spark, d):
    at = ad.aln(spark, d).groupBy("cluster_id", F.col("ref_name").alias("chromosome")).agg((F.min("s") + 9000).alias("brk"))
    exons = ad.exon(spark, d).withColumn("size", iv.length(F.col("s"), F.col("e")))
    total = exons.groupBy("chromosome").agg(F.sum("size").alias("total"))  # a row per chromosome
    rows = ij.sums_below(at.join(total, "chromosome"), exons, "chromosome", "brk", "e", "size", "size_before")
    rows = ij.sums_below(rows, exons, "chromosome", "brk", "s", "size", "size_reached", reached=True)
    return rows.select("cluster_id", "chromosome", "size_before", (F.col("total") - F.col("size_reached")).alias("size_after"))


_MARK = "m AS (SELECT gene_id, chromosome, gs + k * 100 AS pos FROM (SELECT *, unnest(range(0, (ge - gs) // 100 + 1)) AS k FROM gene))"


@query(f"WITH {ALN}, {GENE}, {_MARK} SELECT m.gene_id, m.pos, count(*)::BIGINT AS n, round(avg(m.pos - a.s), 6) AS offset_mean FROM m JOIN aln a ON a.ref_name = m.chromosome AND m.pos BETWEEN a.s AND a.e GROUP BY ALL")
def marker_samples(spark, d):
    marks = ad.gene(spark, d).select("gene_id", "chromosome", F.explode(F.expr("transform(sequence(0, (ge - gs) div 100), k -> gs + k * 100)")).alias("pos"))
    found = ij.point_join(marks, ad.aln(spark, d), [("chromosome", "ref_name")], "pos", ("s", "e"), 500)
    return found.groupBy("gene_id", "pos").agg(F.count("*").alias("n"), F.avg(F.col("pos") - F.col("s")).alias("offset_mean"))


_TASK = "t AS (SELECT *, least(40, (e - s + 1) // 2) AS push FROM aln), u AS (SELECT *, 260 - (e - s + 1) - 30 + 2 * push AS blen, CASE WHEN strand = '+' THEN e - push + 1 ELSE s + push - 1 END AS bstart FROM t)"


@query(f"WITH {ALN}, {_TASK} SELECT fragment, line::BIGINT AS line, s, bstart::BIGINT AS break_start, blen::BIGINT AS break_length, (CASE WHEN strand = '+' THEN bstart - 40 ELSE bstart - blen + 1 END)::BIGINT AS window_start, (blen + 40)::BIGINT AS window_length FROM u")
def task_regions(spark, d):
    from weftline.plans.pipeline import split_tasks

    return split_tasks(ad.aln(spark, d), 200.0, 20.0, 30, 40).select("fragment", "line", "s", "break_start", "break_length", "window_start", "window_length")


# --- layouts and outputs -------------------------------------------------------------------


@query("SELECT o_custkey % 50 AS cluster_id, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent, max(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS low FROM orders GROUP BY 1")
def pivot_results(spark, d):
    rows = tab(spark, d, "orders").where(F.col("o_orderpriority").isNotNull()).select((F.col("o_custkey") % 50).alias("cluster_id"), F.col("o_orderpriority").alias("anno_type"), F.col("o_totalprice").alias("value"))
    wide = rs.collated(rows, ["1-URGENT", "5-LOW"])
    return wide.select("cluster_id", F.col("1-URGENT").alias("urgent"), F.col("5-LOW").alias("low"))


@query("SELECT s_suppkey AS cluster_id, 's_name' AS anno_type, s_name AS value FROM supplier UNION ALL SELECT s_suppkey, 's_nationkey', s_nationkey::VARCHAR FROM supplier")
def unpivot_eav(spark, d):
    rows = tab(spark, d, "supplier").select(F.col("s_suppkey").alias("cluster_id"), "s_name", "s_nationkey")
    return rs.as_annotations(rows, ["s_name", "s_nationkey"])


_READS = "r AS (SELECT p_partkey // 2 AS name, (1 + p_partkey % 2)::INT AS read_end, concat('AC', translate(p_partkey::VARCHAR, '0123456789', 'ACGTACGTAC')) AS seq, p_size % 4 = 0 AS minus, p_size % 9 = 0 AS failed FROM part WHERE p_partkey % 7 <> 3)"


@query(f"WITH {_READS}, t AS (SELECT name, read_end, CASE WHEN minus THEN {_REV.format(x='seq')} ELSE seq END AS seq, failed FROM r) SELECT a.name, a.seq AS seq1, b.seq AS seq2 FROM t a JOIN t b ON a.name = b.name AND a.read_end = 1 AND b.read_end = 2 WHERE NOT a.failed AND NOT b.failed")
def mate_pairing(spark, d):
    rows = tab(spark, d, "part").where("p_partkey % 7 <> 3").selectExpr("p_partkey div 2 AS name", "cast(1 + p_partkey % 2 as int) AS read_end", "concat('AC', translate(cast(p_partkey as string), '0123456789', 'ACGTACGTAC')) AS seq", "'II' AS qual", "p_size % 4 = 0 AS minus", "p_size % 9 = 0 AS failed")
    return readers.paired_mates(rows)[0].select("name", "seq1", "seq2")


@query(f"WITH {ALN}, r AS (SELECT cluster_id, read_end, min(s) AS s, max(e) AS e FROM aln GROUP BY ALL) SELECT a.cluster_id, a.s AS s0, a.e AS e0, b.s AS s1, b.e AS e1 FROM r a JOIN r b ON a.cluster_id = b.cluster_id AND a.read_end = 0 AND b.read_end = 1")
def pair_regions(spark, d):
    rows = ad.aln(spark, d).groupBy("cluster_id", F.col("read_end").alias("cluster_end")).agg(F.min("s").alias("s"), F.max("e").alias("e"))
    rows = rows.withColumns({"ref_name": F.lit("r"), "strand": F.lit("+")})
    return readers.region_pairs(rows).select("cluster_id", "s0", "e0", "s1", "e1")


@query(f"WITH {ALN} SELECT fragment, line::BIGINT AS line, ref_name, strand, s, e FROM aln")
def location_parse(spark, d):
    rows = ad.aln(spark, d).select("fragment", "line", F.concat(F.col("ref_name"), F.col("strand"), F.lit(":"), F.col("s").cast("string"), F.lit("-"), F.col("e").cast("string")).alias("text"))
    return rows.select("fragment", "line", *readers.location(F.col("text")))


@query("SELECT replace(concat('', CASE WHEN p_size % 25 = 0 THEN 'M' ELSE (p_size % 25)::VARCHAR END), 'M', 'MT') AS chromosome, p_partkey + 1 AS s, p_partkey + p_size AS e, p_type AS type FROM part")
def repeat_convert(spark, d):
    rows = tab(spark, d, "part").selectExpr("concat('chr', CASE WHEN p_size % 25 = 0 THEN 'M' ELSE cast(p_size % 25 as string) END) AS chrom", "p_partkey AS chrom_start", "p_partkey + p_size AS chrom_end", "p_type AS rep_class")
    return readers.repeat_rows(rows)


@query(f"WITH {SEQ} SELECT seq_id::VARCHAR AS qname, CASE WHEN seq_id % 2 = 0 THEN 16 ELSE 0 END::BIGINT AS flag, (seq_id + 1)::BIGINT AS pos, concat(length(sequence), 'M') AS cigar, CASE WHEN seq_id % 2 = 0 THEN concat(length(sequence) - 1 - 3, 'A', 3) ELSE concat(3, 'A', length(sequence) - 4) END AS md FROM seq WHERE length(sequence) > 5")
def sam_project(spark, d):
    rows = ad.seq(spark, d).where(F.length("sequence") > 5).selectExpr("cast(seq_id as string) AS name", "CASE WHEN seq_id % 2 = 0 THEN '-' ELSE '+' END AS strand", "'c1' AS ref", "seq_id AS offset", "sequence AS seq", "'I' AS qual", "0 AS others", "'3:A>C' AS mismatches")
    return readers.native_to_sam(rows).select("qname", "flag", "pos", "cigar", "md")


@query(f"WITH {SEQ} SELECT concat(seq_id::VARCHAR, CASE WHEN seq_id % 2 = 0 THEN '/1' ELSE '/2' END) AS name, CASE WHEN seq_id % 3 = 0 THEN {_REV.format(x='sequence')} ELSE sequence END AS sequence FROM seq")
def fastq_project(spark, d):
    rows = ad.seq(spark, d).selectExpr("cast(seq_id as string) AS qname", "cast(CASE WHEN seq_id % 3 = 0 THEN 16 ELSE 0 END + CASE WHEN seq_id % 2 = 0 THEN 64 ELSE 128 END as int) AS flag", "sequence AS seq", "sequence AS qual")
    return readers.fastq_of_sam(rows).select("name", "sequence")


@query("SELECT o_orderkey, (o_orderkey // 1000)::BIGINT AS chunk FROM orders")
def chunk_assign(spark, d):
    return tab(spark, d, "orders").select("o_orderkey", F.expr("o_orderkey div 1000").alias("chunk"))


@query("SELECT o_orderkey, (o_orderkey % 7)::BIGINT AS file_no FROM orders")
def round_robin(spark, d):
    return tab(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).alias("file_no"))


@query(f"WITH {ALN}, p AS (SELECT DISTINCT a.fragment, least(a.ref_name, b.ref_name) AS chr1, greatest(a.ref_name, b.ref_name) AS chr2 FROM aln a JOIN aln b ON a.fragment = b.fragment AND a.read_end = 0 AND b.read_end = 1) SELECT chr1, chr2, count(*)::BIGINT AS n FROM p GROUP BY ALL")
def partition_key(spark, d):
    return Q["chr_pairs"][0](spark, d).groupBy("chr1", "chr2").agg(F.count("*").alias("n"))


@query("SELECT l.l_orderkey, l.l_linenumber::BIGINT AS l_linenumber, r.lo FROM lineitem l JOIN (SELECT k * 700 AS lo, k * 700 + 699 AS hi FROM (SELECT unnest(range(0, 1000)) AS k)) r ON l.l_orderkey BETWEEN r.lo AND r.hi")
def range_route(spark, d):
    ranges = spark.range(1000).selectExpr("id * 700 AS lo", "id * 700 + 699 AS hi")
    return ij.point_join(tab(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ranges, [], "l_orderkey", ("lo", "hi"), 700).select("l_orderkey", "l_linenumber", "lo")


@query(f"WITH {SEQ} SELECT concat_ws('_', seq_id % 10, seq_id) AS name, sequence FROM seq")
def fasta_rows(spark, d):
    rows = ad.seq(spark, d).select((F.col("seq_id") % 10).cast("string").alias("group"), F.col("seq_id").cast("string").alias("seq_id"), "sequence")
    return sinks.table_to_fasta(rows, ["group", "seq_id", "sequence"])


@query(f"WITH {SEQ}, x AS (SELECT seq_id AS transcript_id, sequence, 1 + seq_id % 25 * 3 + k * 120 AS s FROM (SELECT *, unnest(range(0, 3)) AS k FROM seq)), j AS (SELECT transcript_id, string_agg(substring(sequence, s, 30), '' ORDER BY s) AS q FROM x WHERE s <= length(sequence) GROUP BY 1) SELECT transcript_id, concat(CASE WHEN transcript_id % 2 = 0 THEN q ELSE {_REV.format(x='q')} END, 'AAAAA') AS sequence FROM j")
def spliced_sequence(spark, d):
    """A transcript of up to three exons on every text, each text a chromosome in chunks of 64."""
    texts = ad.seq(spark, d).select("seq_id", "sequence")
    chunks = F.explode(F.sequence(F.lit(0), F.floor(F.length("sequence") / 64)))
    bases = texts.select(F.col("seq_id").alias("chromosome"), chunks.alias("chunk"), F.lit(64).alias("chunk_size"), "sequence").select("chromosome", "chunk", "chunk_size", F.substring("sequence", (F.col("chunk") * 64 + 1).cast("int"), F.lit(64)).alias("seq"))
    places = texts.select(F.col("seq_id").alias("transcript_id"), F.length("sequence").alias("n"), F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("k"))
    exons = places.selectExpr("transcript_id", "transcript_id AS chromosome", "CASE WHEN transcript_id % 2 = 0 THEN '+' ELSE '-' END AS strand", "1 + transcript_id % 25 * 3 + k * 120 AS s", "30 + transcript_id % 25 * 3 + k * 120 AS e", "n").where("s <= n").drop("n")
    return gm.spliced(exons, bases, 5)


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN concat('>', split_part(p_name, ' ', 1)) ELSE p_name END AS header FROM part")
def header_strip(spark, d):
    line = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(">"), F.col("p_name"))).otherwise(F.col("p_name"))
    return tab(spark, d, "part").select("p_partkey", sinks.stripped_header(line).alias("header"))


@query(f"WITH {MEMBER}, {ALN} SELECT a.fragment, a.line::BIGINT AS line FROM aln a WHERE a.fragment IN (SELECT fragment FROM member WHERE cluster_id IN (3, 7))")
def cluster_reads(spark, d):
    wanted = ad.member(spark, d).where(F.col("cluster_id").isin(3, 7)).select("fragment").distinct()
    return rd.keep_ids(ad.aln(spark, d), wanted, "fragment", "fragment").select("fragment", "line").orderBy("fragment")


@query(f"WITH {SEQ}, h AS (SELECT seq_id, substring(sequence, 1, 8) AS a, substring(sequence, 9, 8) AS b, seq_id % 2 = 0 AS x, seq_id % 3 = 0 AS y FROM seq) SELECT seq_id, concat(CASE WHEN x THEN a ELSE {_REV.format(x='a')} END, 'NNN', CASE WHEN y THEN {_REV.format(x='b')} ELSE b END) AS sequence FROM h")
def pseudo_fusion(spark, d):
    a, b = F.substring("sequence", 1, 8), F.substring("sequence", 9, 8)
    one = F.when(F.col("seq_id") % 2 == 0, a).otherwise(sq.reverse_complement(a))
    two = F.when(F.col("seq_id") % 3 == 0, sq.reverse_complement(b)).otherwise(b)
    return ad.seq(spark, d).select("seq_id", F.concat(one, F.lit("NNN"), two).alias("sequence"))


@query("SELECT c_custkey AS link, concat('hs', c_nationkey) AS chromosome, c_custkey * 10 AS start, c_custkey * 10 AS end, c_acctbal > 0 AS orf FROM customer UNION ALL SELECT c_custkey, concat('hs', c_nationkey % 5), c_custkey * 20, c_custkey * 20, c_acctbal > 0 FROM customer")
def circos_rows(spark, d):
    rows = tab(spark, d, "customer").selectExpr("c_custkey AS cluster_id", "cast(c_nationkey as string) AS chr1", "c_custkey * 10 AS pos1", "cast(c_nationkey % 5 as string) AS chr2", "c_custkey * 20 AS pos2", "c_acctbal > 0 AS orf")
    return rs.circos_rows(rows)


@query("SELECT o_orderkey, concat('@', o_orderkey, chr(10), 'ACGT', chr(10), '+', chr(10), 'IIII') AS record FROM orders")
def fastq_rows(spark, d):
    rows = formats.fasta_to_fastq(tab(spark, d, "orders").select(F.col("o_orderkey").alias("name"), F.lit("ACGT").alias("sequence")))
    return rows.select(F.col("name").alias("o_orderkey"), sinks.fastq_text(F.col("name").cast("string"), F.col("sequence"), F.col("quality")).alias("record"))


# --- classification ------------------------------------------------------------------------


def _controls(spark, d):
    docs = tab(spark, d, "documents").selectExpr("doc_id", "cast(n_chars as double) AS size", "cast(length(regexp_replace(text, '[^!*%#|]', '')) as double) / greatest(n_chars, 1) AS junk", "cast(length(regexp_replace(text, '[^A-Z]', '')) as double) / greatest(n_chars, 1) AS upper")
    return docs, docs.join(tab(spark, d, "labels"), "doc_id")


@query(None)
def classify(spark, d):
    from weftline.operators.classify import classify as run

    docs, controls = _controls(spark, d)
    return run(docs, controls, ["size", "junk", "upper"], F.col("quality")).select("doc_id", "probability")


@query("SELECT o_orderkey, round(o_totalprice::DECIMAL(18, 2) * 0.000002::DECIMAL(18, 6), 6)::DOUBLE AS probability FROM orders WHERE o_totalprice / 500000 > 0.5")
def threshold(spark, d):
    # prices are cents, so the quotient is an exact decimal, which both engines round alike
    quotient = F.col("o_totalprice").cast("decimal(18,2)") * F.lit(Decimal("0.000002")).cast("decimal(18,6)")
    return tab(spark, d, "orders").where(F.col("o_totalprice") / 500000 > 0.5).select("o_orderkey", F.round(quotient, 6).cast("double").alias("probability"))


# --- junctions at exons, mates on transcripts ----------------------------------------------

_BLOCKS = "blocks AS (SELECT l_suppkey AS cluster_id, (1 + l_orderkey % 2)::BIGINT AS side, (l_orderkey * 8 + l_linenumber) AS block, concat('x', l_partkey % 500) AS target, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, 1 + l_partkey % 40 AS q_start, l_partkey % 40 + 1 + l_quantity::INT % 30 AS q_end, 1 + l_partkey % 3 AS t_start, 20 + l_quantity::INT % 30 AS t_end, 20 + l_quantity::INT % 30 + l_orderkey % 3 AS t_size FROM lineitem)"


@query(f"""WITH {_BLOCKS}, p AS (SELECT a.cluster_id, a.block AS k1, b.block AS k2, a.target AS target1, b.target AS target2,
  CASE WHEN a.q_end + 1 = b.q_start THEN CASE WHEN a.strand = '+' THEN a.t_size ELSE 1 END ELSE CASE WHEN a.strand = '+' THEN 1 ELSE a.t_size END END AS pos1,
  CASE WHEN a.q_end + 1 = b.q_start THEN CASE WHEN b.strand = '+' THEN 1 ELSE b.t_size END ELSE CASE WHEN b.strand = '+' THEN b.t_size ELSE 1 END END AS pos2
  FROM blocks a JOIN blocks b ON a.cluster_id = b.cluster_id AND a.side = 1 AND b.side = 2
  AND ((a.q_end + 1 = b.q_start AND (CASE WHEN a.strand = '+' THEN a.t_end = a.t_size ELSE a.t_start = 1 END) AND (CASE WHEN b.strand = '+' THEN b.t_start = 1 ELSE b.t_end = b.t_size END))
    OR (b.q_end + 1 = a.q_start AND (CASE WHEN b.strand = '+' THEN b.t_end = b.t_size ELSE b.t_start = 1 END) AND (CASE WHEN a.strand = '+' THEN a.t_start = 1 ELSE a.t_end = a.t_size END))))
  SELECT cluster_id, target1, pos1::BIGINT AS pos1, target2, pos2::BIGINT AS pos2 FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY k1, k2, target1, pos1, target2, pos2) AS n FROM p) WHERE n = 1""")
def exon_boundaries(spark, d):
    blocks = tab(spark, d, "lineitem").selectExpr("l_suppkey AS cluster_id", "1 + l_orderkey % 2 AS side", "l_orderkey * 8 + l_linenumber AS block", "concat('x', l_partkey % 500) AS target", "CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand", "1 + l_partkey % 40 AS q_start", "l_partkey % 40 + 1 + cast(l_quantity as int) % 30 AS q_end", "1 + l_partkey % 3 AS t_start", "20 + cast(l_quantity as int) % 30 AS t_end", "20 + cast(l_quantity as int) % 30 + l_orderkey % 3 AS t_size")
    return fu.exon_boundaries(blocks)


_REMAP = """z AS (SELECT *, CASE WHEN st = '+' THEN s ELSE -e END AS f, CASE WHEN st = '+' THEN e ELSE -s END AS l, CASE WHEN st = '+' THEN pos ELSE -pos END AS p,
    coalesce(sum(e - s + 1) OVER (PARTITION BY {k} ORDER BY CASE WHEN st = '+' THEN s ELSE -e END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off, sum(e - s + 1) OVER (PARTITION BY {k}) AS len FROM y),
  h AS (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY f) AS n FROM z WHERE p <= l),
  g AS (SELECT *, greatest(p - f + 1 + lo, 1) + off AS a, greatest(p - f + 1 + hi, 1) + off AS b FROM h WHERE n = 1 AND p - f + 1 + hi >= 1)"""


@query(f"WITH {EXON}, q AS (SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS transcript_id, l_partkey * 200 + l_suppkey % 480 AS pos, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS st, -(l_quantity::INT) AS lo, (l_suppkey % 60) AS hi FROM lineitem), r AS (SELECT DISTINCT * FROM q), y AS (SELECT r.*, x.strand, x.s, x.e FROM r JOIN exon x USING (transcript_id)), {_REMAP.format(k='id, line, transcript_id, pos, st, lo, hi')} SELECT id, line::BIGINT AS line, transcript_id, CASE WHEN st = strand THEN '+' ELSE '-' END AS remap_strand, (CASE WHEN st = strand THEN a ELSE len - b + 1 END)::BIGINT AS ts, (CASE WHEN st = strand THEN b ELSE len - a + 1 END)::BIGINT AS te FROM g WHERE a <= len")
def remap_extended(spark, d):
    points = tab(spark, d, "lineitem").selectExpr("l_orderkey AS id", "l_linenumber AS line", "l_partkey AS transcript_id", "l_partkey * 200 + l_suppkey % 480 AS pos", "CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand", "-cast(l_quantity as int) AS ext_min", "l_suppkey % 60 AS ext_max")
    points = dealt(points, "transcript_id").distinct()
    return gm.remap_extended(points, ad.exon(spark, d), ["id", "line"])


@query(f"""WITH {EXON}, m AS (SELECT gene_id, transcript_id, chromosome, min(s) AS gs, max(e) AS ge FROM exon GROUP BY ALL),
  t AS (SELECT s_suppkey AS cluster_id, k AS cluster_end, concat('c', s_nationkey % 10) AS ref_name, CASE WHEN (s_suppkey + k) % 2 = 0 THEN '+' ELSE '-' END AS strand, s_suppkey * 600 + k * 90 AS pos, 20 + s_suppkey % 7 AS size FROM (SELECT *, unnest([0, 1]) AS k FROM supplier)),
  b AS (SELECT *, 110 - size - 30 + 1 AS lo, 290 - 20 AS hi FROM t),
  w AS (SELECT *, CASE WHEN strand = '+' THEN pos - hi ELSE pos + lo END AS ws, CASE WHEN strand = '+' THEN pos - lo ELSE pos + hi END AS we FROM b),
  y AS (SELECT w.cluster_id, w.cluster_end, m.gene_id, m.transcript_id, w.pos, CASE WHEN w.strand = '+' THEN '-' ELSE '+' END AS st, w.lo, w.hi, x.strand, x.s, x.e FROM w JOIN m ON m.chromosome = w.ref_name AND w.ws <= m.ge AND m.gs <= w.we JOIN exon x USING (transcript_id)),
  {_REMAP.format(k='cluster_id, cluster_end, transcript_id')}
  SELECT cluster_id, cluster_end::BIGINT AS cluster_end, ref_name, strand, ws::BIGINT AS s, we::BIGINT AS e FROM w
  UNION ALL SELECT cluster_id, cluster_end::BIGINT, concat(gene_id, '|', transcript_id), CASE WHEN st = strand THEN '-' ELSE '+' END, (CASE WHEN st = strand THEN a ELSE len - b + 1 END)::BIGINT, (CASE WHEN st = strand THEN b ELSE len - a + 1 END)::BIGINT FROM g WHERE a <= len""")
def mate_regions(spark, d):
    from weftline.plans.pipeline import mate_regions as run

    tasks = tab(spark, d, "supplier").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).selectExpr("s_suppkey AS cluster_id", "k AS cluster_end", "concat('c', s_nationkey % 10) AS ref_name", "CASE WHEN (s_suppkey + k) % 2 = 0 THEN '+' ELSE '-' END AS strand", "s_suppkey * 600 + k * 90 AS break_start", "20 + s_suppkey % 7 AS break_length")
    return run(tasks, ad.exon(spark, d), 200.0, 30.0, 20, 30)


@query("SELECT o_orderkey AS fragment, concat(o_orderkey, '/', 1 + side) AS qname, side::BIGINT AS side FROM (SELECT o_orderkey, 0 AS side FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 4 <> 0) ORDER BY 1, 3")
def merge_ordered(spark, d):
    rows = tab(spark, d, "orders")
    side = lambda k, m: rows.where(F.col("o_orderkey") % m != 0).select(F.concat_ws("/", F.col("o_orderkey").cast("string"), F.lit(str(k))).alias("qname"), F.col("o_orderkey").alias("line"))
    return rd.merge_ordered(side(1, 3), side(2, 4), "line").select("fragment", "qname", "side")
