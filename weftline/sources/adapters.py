"""Views of the bundled test tables as sequencing relations, for both engines.

Each view is a Spark function and the text of a DuckDB common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.tasks import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def aln(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr("l_orderkey AS fragment", "cast(l_linenumber % 2 as int) AS read_end", "concat('c', cast(l_suppkey % 10 as string)) AS ref_name", "CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand", "l_partkey * 20 + l_linenumber AS s", "l_partkey * 20 + l_linenumber + cast(l_quantity as int) - 1 AS e", "l_suppkey AS cluster_id", "l_linenumber AS line")


def gene(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr("p_partkey AS gene_id", "concat('c', cast(p_partkey % 10 as string)) AS chromosome", "p_partkey * 20 AS gs", "p_partkey * 20 + p_size * 10 AS ge", "CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS gstrand")


def member(spark: SparkSession, d: str) -> DataFrame:
    return dealt(table(spark, d, "lineitem").selectExpr("l_suppkey AS cluster_id", "l_orderkey AS fragment"), "fragment").distinct()


def seq(spark: SparkSession, d: str) -> DataFrame:
    """All ACGT letters of every document."""
    return table(spark, d, "documents").selectExpr("doc_id AS seq_id", "regexp_replace(upper(text), '[^ACGT]+', '') AS sequence")


def exon(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("p_partkey AS transcript_id", "p_partkey div 3 AS gene_id", "concat('c', cast((p_partkey div 3) % 10 as string)) AS chromosome", "CASE WHEN (p_partkey div 3) % 2 = 0 THEN '+' ELSE '-' END AS strand", "p_size", "explode(sequence(0, p_size % 5)) AS k")
    return rows.selectExpr("transcript_id", "gene_id", "chromosome", "strand", "transcript_id * 200 + k * 90 + 1 AS s", "transcript_id * 200 + k * 90 + 20 + p_size AS e", "cast(k as bigint) AS k")


def flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr("concat(cast(o_orderkey as string), '/', cast(1 + o_orderkey % 2 as string)) AS qname", "o_orderkey AS fragment", "cast((o_orderkey * 7) % 64 + CASE WHEN o_orderkey % 2 = 0 THEN 64 ELSE 128 END as int) AS flag", "concat('g', cast(o_custkey % 97 as string), '|t', cast(o_custkey % 7 as string)) AS rname", "concat('NM:i:1\tXM:i:', cast(o_custkey % 5 as string)) AS tags", "o_custkey AS custkey", "o_totalprice AS price", "o_orderstatus AS status")


def hits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr("l_suppkey AS cluster_id", "cast(l_quantity as int) AS matches", "50 AS q_size", "cast(l_partkey % 5000 as int) AS t_gap_bases", "cast(1 + l_partkey % 3 as int) AS q_start", "cast(50 - l_orderkey % 3 as int) AS q_end", "cast(l_linenumber as int) AS block", "l_partkey AS t_start", "l_partkey + cast(l_quantity as int) * 40 AS t_end", "l_orderkey AS query")


ALN = "aln AS (SELECT l_orderkey AS fragment, (l_linenumber % 2)::INT AS read_end, concat('c', (l_suppkey % 10)::VARCHAR) AS ref_name, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, l_partkey * 20 + l_linenumber AS s, l_partkey * 20 + l_linenumber + l_quantity::INT - 1 AS e, l_suppkey AS cluster_id, l_linenumber AS line FROM lineitem)"
GENE = "gene AS (SELECT p_partkey AS gene_id, concat('c', (p_partkey % 10)::VARCHAR) AS chromosome, p_partkey * 20 AS gs, p_partkey * 20 + p_size * 10 AS ge, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS gstrand FROM part)"
MEMBER = "member AS (SELECT DISTINCT l_suppkey AS cluster_id, l_orderkey AS fragment FROM lineitem)"
SEQ = "seq AS (SELECT doc_id AS seq_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS sequence FROM documents)"
EXON = "exon AS (SELECT p_partkey AS transcript_id, p_partkey // 3 AS gene_id, concat('c', ((p_partkey // 3) % 10)::VARCHAR) AS chromosome, CASE WHEN (p_partkey // 3) % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 200 + k * 90 + 1 AS s, p_partkey * 200 + k * 90 + 20 + p_size AS e, k::BIGINT AS k FROM (SELECT *, unnest(range(0, p_size % 5 + 1)) AS k FROM part))"
FLAGS = "flags AS (SELECT concat(o_orderkey::VARCHAR, '/', (1 + o_orderkey % 2)::VARCHAR) AS qname, o_orderkey AS fragment, ((o_orderkey * 7) % 64 + CASE WHEN o_orderkey % 2 = 0 THEN 64 ELSE 128 END)::INT AS flag, concat('g', (o_custkey % 97)::VARCHAR, '|t', (o_custkey % 7)::VARCHAR) AS rname, concat('NM:i:1', chr(9), 'XM:i:', (o_custkey % 5)::VARCHAR) AS tags, o_custkey AS custkey, o_totalprice AS price, o_orderstatus AS status FROM orders)"
HITS = "hits AS (SELECT l_suppkey AS cluster_id, l_quantity::INT AS matches, 50 AS q_size, (l_partkey % 5000)::INT AS t_gap_bases, (1 + l_partkey % 3)::INT AS q_start, (50 - l_orderkey % 3)::INT AS q_end, l_linenumber::INT AS block, l_partkey AS t_start, l_partkey + l_quantity::INT * 40 AS t_end, l_orderkey AS query FROM lineitem)"
#: Exons with the transcript range that each covers.
OFF = EXON + ", off AS (SELECT *, te - (e - s + 1) + 1 AS ts FROM (SELECT *, sum(e - s + 1) OVER (PARTITION BY transcript_id ORDER BY CASE WHEN strand = '+' THEN s ELSE -s END)::BIGINT AS te, sum(e - s + 1) OVER (PARTITION BY transcript_id)::BIGINT AS t_length FROM exon))"


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded to six digits, counts as long, as both engines print them."""
    return df.select(*[F.round(c, 6).alias(c) if k in ("double", "float") else F.col(c).cast("long").alias(c) if k in ("int", "smallint", "tinyint", "bigint") or k.startswith("decimal") else F.col(c) for c, k in df.dtypes])
