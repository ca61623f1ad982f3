"""Filters, joins and statistics on reads and alignments."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.intervals import bin_of, bins
from weftline.functions.sequences import gene_of
from weftline.operators.intervals import islands, overlap_join
from weftline.operators.tasks import dealt

PROPER, UNMAPPED, REVERSE, FIRST, SECOND = 0x2, 0x4, 0x10, 0x40, 0x80
_TEST = re.compile(r"\s*(==|=|!=|<>|<=|>=|<|>)\s*('[^']*'|-?\d+(?:\.\d+)?(?:[eE]-?\d+)?)\s*\Z")


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(bit) != 0


def concordant(sam: DataFrame) -> DataFrame:
    return sam.where(has_flag(F.col("flag"), PROPER))


def mapped(sam: DataFrame) -> DataFrame:
    return sam.where(~has_flag(F.col("flag"), UNMAPPED))


def mate(sam: DataFrame, end: int) -> DataFrame:
    """Rows of one mate; a row that is neither mate is an error."""
    first, second = has_flag(F.col("flag"), FIRST), has_flag(F.col("flag"), SECOND)
    known = F.when(first, 1).when(second, 2).otherwise(F.raise_error(F.lit("a row is neither first nor second mate")).cast("int"))
    return sam.where(known == end)


def fragment_of(qname: Column) -> Column:
    """The read name without its first /1 or /2."""
    at = F.regexp_instr(qname, F.lit("/[12]"))
    return F.when(at > 0, F.concat(F.substring(qname, F.lit(1), at - 1), F.substring(qname, at + 2, F.length(qname)))).otherwise(qname)


def keep_ids(rows: DataFrame, ids: DataFrame, column: str, ids_column: str, invert: bool = False) -> DataFrame:
    """Semi join on an id, or anti join."""
    wanted = ids.select(F.col(ids_column).alias("__id"))
    return rows.join(wanted, rows[column] == F.col("__id"), "left_anti" if invert else "left_semi")


def expression_filter(rows: DataFrame, column: str, test: str) -> DataFrame:
    """Rows whose column passes an operator and a literal; nothing else is accepted."""
    found = _TEST.match(test)
    if not found or column not in rows.columns:
        raise ValueError(f"not a test: {column} {test}")
    return rows.where(F.expr(f"`{column}` {found[1].replace('==', '=')} {found[2]}"))


def equal_filter(rows: DataFrame, column: str, value) -> DataFrame:
    return rows.where(F.col(column) == F.lit(value))


def far_genes(rows: DataFrame, chr1: str, chr2: str, s1: str, e1: str, s2: str, e2: str, least: int = 50_000) -> DataFrame:
    near = (F.abs(F.col(e1) - F.col(s2)) < least) | (F.abs(F.col(s1) - F.col(e2)) < least)
    return rows.where(~((F.col(chr1) == F.col(chr2)) & near))


def suppressed(tags: Column) -> Column:
    """The tag XM:i:n states that more than 0 alignments were suppressed."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(tags, r"XM:i:(\d+)", 1), F.lit("")), F.lit("9999999999")), F.lit(0)) > 0


def both_ends(rows: DataFrame, fragment: str = "fragment", end: str = "read_end") -> DataFrame:
    """Rows of fragments that have both read ends."""
    complete = rows.groupBy(fragment).agg(F.min(end).alias("lo"), F.max(end).alias("hi")).where("lo <> hi").select(fragment)
    return rows.join(complete, fragment, "left_semi")


def expression(rows: DataFrame, ref: str = "ref_name") -> DataFrame:
    """Half a count per alignment and gene."""
    return rows.groupBy(gene_of(F.col(ref)).alias("gene")).agg(F.sum(F.lit(0.5)).alias("expression"))


def read_stats(pairs: DataFrame, size: str, length: str) -> DataFrame:
    n = F.abs(F.col(size))
    return pairs.agg(F.count("*").alias("frag_count"), F.avg(n).alias("fraglength_mean"), F.stddev_pop(n).alias("fraglength_stddev"), F.min(length).alias("readlength_min"), F.max(length).alias("readlength_max"))


def merge_read_stats(parts: DataFrame) -> DataFrame:
    """Pooled statistics of shards given by count, mean and deviation; empty shards count nothing."""
    n, mean, sd = F.col("frag_count"), F.col("fraglength_mean"), F.col("fraglength_stddev")
    sums = parts.where(n > 0).agg(F.sum(n).alias("n"), F.sum(n * mean).alias("x"), F.sum(n * (sd * sd + mean * mean)).alias("xx"), F.min("readlength_min").alias("readlength_min"), F.max("readlength_max").alias("readlength_max"))
    average = F.col("x") / F.col("n")
    return sums.select(F.col("n").alias("frag_count"), average.alias("fraglength_mean"), F.sqrt(F.greatest(F.col("xx") / F.col("n") - average * average, F.lit(0.0))).alias("fraglength_stddev"), "readlength_min", "readlength_max")


def sampled_covariance(samples: DataFrame, draw: str, least: int = 100) -> DataFrame:
    """Mean and covariance of two draws, with replacement, per sample id that has two values.

    A draw takes the value whose key in the column ``draw`` has the smallest
    hash, so that reruns agree and partial results combine before the shuffle.
    Too few ids are an error.
    """
    pick = lambda k: F.min(F.struct(F.md5(F.concat(F.col(draw).cast("string"), F.lit(f"-{k}"))).alias("h"), F.col("value").alias("v")))["v"]
    pairs = samples.groupBy("sample_id").agg(F.count("*").alias("n"), pick(1).alias("a"), pick(2).alias("b")).where("n >= 2")
    out = pairs.agg(F.count("*").alias("ids"), F.avg((F.col("a") + F.col("b")) / 2).alias("mean"), F.covar_pop("a", "b").alias("covariance"))
    checked = F.when(F.col("ids") > least, F.col("covariance")).otherwise(F.raise_error(F.lit("too few samples for a covariance")).cast("double"))
    return out.select("mean", checked.alias("covariance"))


def alignment_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Islands of alignments per read: copies that overlap count once."""
    return islands(rows, [*keys, "ref_name"], gap=0, by=keys).groupBy(*keys).agg(F.count("*").alias("n_alignments"))


def unmappable(counts: DataFrame, most: int = 10) -> DataFrame:
    """Fragments whose product of end counts passes the bound; a missing end counts 1."""
    ends = dealt(counts, "fragment").groupBy("fragment").agg(F.max(F.when(F.col("read_end") == 0, F.col("n_alignments"))).alias("n0"), F.max(F.when(F.col("read_end") == 1, F.col("n_alignments"))).alias("n1"))
    return ends.where(F.coalesce("n0", F.lit(1)) * F.coalesce("n1", F.lit(1)) > most).select("fragment")


def same_gene(rows: DataFrame, genes: DataFrame, size: int = 10_000) -> DataFrame:
    """Fragments of which some gene overlaps both ends. genes: gene_id, chromosome, gs, ge."""
    hits = overlap_join(rows, genes, [("ref_name", "chromosome")], ("s", "e"), ("gs", "ge"), size)
    return hits.groupBy("fragment", "gene_id").agg(F.min("read_end").alias("lo"), F.max("read_end").alias("hi")).where("lo <> hi").select("fragment").distinct()


def same_region(rows: DataFrame, reach: int, strand: bool = False) -> DataFrame:
    """Fragments whose ends share a bin, bins being as long as the reach on either side."""
    cut = rows.select("fragment", "read_end", "ref_name", F.explode(bins(F.greatest(F.col("s") - reach, F.lit(0)), F.col("e") + reach, reach)).alias("bin"))
    return cut.groupBy("fragment", "ref_name", "bin").agg(F.min("read_end").alias("lo"), F.max("read_end").alias("hi")).where("lo <> hi").select("fragment").distinct()


def first_per_position(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by the given order."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def non_overlapping(rows: DataFrame, keys: list[str], size: int, order: list[str]) -> DataFrame:
    """Per key, in the given order, alignments none of whose bins was taken before.

    The alignments of a key are folded one after the other in one expression;
    the guards on multi-mapping reads bound how many there are.
    """
    rest = [f for f in rows.schema.fields if f.name not in keys]
    item = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.struct(*[f.name for f in rest]).alias("row"))
    start = F.struct(F.array().cast("array<struct<ref:string,bin:bigint>>").alias("taken"), F.array().cast(T.ArrayType(T.StructType(rest))).alias("kept"))

    def step(a: Column, x: Column) -> Column:
        row = x["row"]
        own = F.transform(F.sequence(F.floor(row["s"] / size), F.floor(row["e"] / size)), lambda b: F.struct(row["ref_name"].alias("ref"), b.alias("bin")))
        free = ~F.arrays_overlap(a["taken"], own)
        more = lambda name, new: F.when(free, F.concat(a[name], new)).otherwise(a[name]).alias(name)
        return F.struct(more("taken", own), more("kept", F.array(row)))

    groups = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("items"))
    kept = groups.select(*keys, F.explode(F.aggregate("items", start, step, lambda a: a["kept"])).alias("row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in rows.columns])


def merge_ordered(left: DataFrame, right: DataFrame, order: str, qname: str = "qname") -> DataFrame:
    """Two tables of reads, each in the order of its fragments, as one; ties put the left one first.

    The fragment is the number before /1 or /2 of the read name; ``order`` is a
    column with the place of a row in its own table.
    """
    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    fragment = F.regexp_extract(qname, r"^(.*)/[12]", 1).cast("long")
    return both.withColumn("fragment", fragment).orderBy("fragment", "side", order)


def bin_pairs(rows: DataFrame, size: int, reach: int, least: int) -> DataFrame:
    """Per pair of bins the fragments with one end in each, if there are ``least``.

    The smaller bin by reference, strand and number comes first. A fragment's
    ends meet by its own key, so no group is crossed with itself.
    """
    cut = rows.select("fragment", "read_end", F.explode(bins(F.greatest(F.col("s") - reach, F.lit(0)), F.col("e") + reach, size)).alias("bin"), "ref_name", "strand")
    cut = dealt(cut, "fragment").distinct()
    side = lambda end, x: cut.where(F.col("read_end") == end).select("fragment", F.struct("ref_name", "strand", "bin").alias(x))
    pairs = side(0, "a").join(side(1, "b"), "fragment").select("fragment", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    # both orders of a pair are one, so a fragment may come twice
    counted = dealt(pairs.distinct(), "lo", "hi").groupBy("lo", "hi").agg(F.count("*").alias("n_fragments"))
    return counted.where(F.col("n_fragments") >= least)


def position_bin(position: Column, size: int) -> Column:
    return bin_of(position, size)
