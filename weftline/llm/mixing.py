"""Mixing sources to target weights: whole copies plus one seeded chance copy.

Sizes are aggregated per source, targets follow from weights and a cap, and a
document is emitted ``floor(rate)`` times plus once more with the probability
of the fraction. The chance is a hash of the document's id, so reruns agree.
Only DataFrame functions run here.

Defined results: a null or empty text has size 0 and takes 0 words, but is
emitted at its source's rate like the others; a null source is a source of its
own, ordered last; rows with the same id and text share their decision; a null
id draws from the text; a table without words has targets of 0, an empty table
gives no rows; texts of any length are counted whole. Columns other than the
three read here never matter, but :func:`emit` replaces one named like its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.scratch import fresh, materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to which their targets are broadcast; beyond, the join shuffles.
BROADCAST_SOURCES = 20_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chance(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id, or on the text where the id is null."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Per source its words and its target.

    Sources in code point order, null last, take the weights in turn. All
    targets together are ``share`` of all words; none passes ``cap`` times its
    source: the level at which the capped ones stop and the rest share by weight
    is the first one, in the order of words per weight, that the next cap holds.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    by = by.withColumn("weight", weight)
    rise = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy(F.lit(0))
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    after = rise.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    by = by.withColumn("total", F.sum("source_size").over(everything))
    level = (F.lit(share) * F.col("total") - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after)
    by = by.withColumn("level", level)
    holds = F.col("level") * F.col("weight") <= F.lit(cap) * F.col("source_size")
    by = by.withColumn("level", F.max(F.when(holds, F.col("level"))).over(everything))
    target = F.least(F.lit(cap) * F.col("source_size"), F.coalesce("level", F.lit(float("inf"))) * F.col("weight"))
    return by.select("source", "source_size", target.cast("double").alias("target"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the chance of every document, written down once."""
    return materialise(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), chance(F.col("doc_id"), F.col("text"), "mix-1").alias("chance")), "mix-sizes")


def with_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Join targets to rows by source, null matching null; few sources are broadcast."""
    key = fresh("__mix_source", *rows.columns, *targets.columns)
    targets = targets.withColumnRenamed("source", key)
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    return rows.join(targets, F.col("source").eqNullSafe(F.col(key)), "left").drop(key)


def copies(target: str = "target", words: str = "source_size", draw: Column | None = None) -> Column:
    """How often a document is emitted, by its source's target and words and its chance."""
    draw = F.col("chance") if draw is None else draw
    rate = F.when(F.col(words) > 0, F.col(target) / F.col(words)).otherwise(F.lit(0.0))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per document its size, its source's words and target, and its copies."""
    sizes = document_sizes(docs)
    targets = materialise(source_targets(sizes, **options), "mix-targets")
    return with_targets(sizes, targets).withColumn("copies", copies())


def emit(docs: DataFrame, copy: str = "mix_copy", **options) -> DataFrame:
    """The mixed corpus: the rows of docs, each as often as the mix takes it.

    ``copy`` numbers the copies of a row from 1; a column of docs with that name is replaced.
    """
    docs = docs.drop(copy)
    sizes = docs.select("source", n_words(F.col("text")).alias("size"))
    targets = materialise(source_targets(sizes, **options), "mix-targets")
    words, target = fresh("__mix_words", *docs.columns), fresh("__mix_target", *docs.columns)
    rows = with_targets(docs, targets.select("source", F.col("source_size").alias(words), F.col("target").alias(target)))
    n = copies(target, words, chance(F.col("doc_id"), F.col("text"), "mix-1")).cast("int")
    every = F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")))
    return rows.withColumn(copy, every).drop(words, target)


def op1_source_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS chance
  FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, ([3, 1, 2])[1 + ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3)::INT] AS weight FROM by_source),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
              ORDER BY source_size / weight::DOUBLE, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY source_size / weight::DOUBLE, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
chosen AS (SELECT max(CASE WHEN level * weight <= 2.0::DOUBLE * source_size THEN level END) AS level FROM levels),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(c.level, 'inf'::DOUBLE) * weight)::DOUBLE AS target
  FROM levels, chosen c)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM (
  SELECT doc_id, size, source_size, target,
         (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM (SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source))
"""
