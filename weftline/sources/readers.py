"""Readers of read, alignment, annotation and sequence files into typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.sequences import reverse_complement, sanger_quality

SAM_FIELDS = "qname flag rname pos mapq cigar mrnm mpos isize seq qual".split()
PSL_FIELDS = "matches mismatches rep_matches n_count q_gaps q_gap_bases t_gaps t_gap_bases strand q_name q_size q_start q_end t_name t_size t_start t_end block_count block_sizes q_starts t_starts".split()
_PSL_TEXT = {"strand", "q_name", "t_name", "block_sizes", "q_starts", "t_starts"}
PSL_SCHEMA = ", ".join(f"{n} {'string' if n in _PSL_TEXT else 'int'}" for n in PSL_FIELDS)
COMPACT_SCHEMA = "fragment long, read_end int, ref_name string, strand string, s int, e int"
CLUSTER_SCHEMA = "cluster_id long, cluster_end int, fragment long, read_end int, ref_name string, strand string, s int, e int"
REGION_SCHEMA = "cluster_id long, cluster_end int, ref_name string, strand string, s int, e int"
ANNOTATION_SCHEMA = "cluster_id long, anno_type string, value string"
REPEAT_SCHEMA = "chromosome string, s int, e int, type string"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 0), value: dense numbers although files are split.

    Lines of a split keep their order; counts per split, a small table, give
    each split its offset.
    """
    at = F.col("_metadata")
    rows = spark.read.text(path).select("value", at["file_path"].alias("file"), at["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("id"))
    parts = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return rows.join(parts, ["file", "block"]).select("file", (F.col("offset") + F.col("id") - F.col("first")).alias("line"), "value")


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """record (from 0), name, read_end, sequence, comment, quality; four lines each."""
    if not path.rstrip("/").endswith((".fastq", ".fq", ".fastq.gz", ".fq.gz")):
        raise ValueError(f"not a read file by its extension: {path}")
    lines = numbered_lines(spark, path)
    part = lambda k: F.max(F.when(F.col("line") % 4 == k, F.col("value")))
    records = lines.groupBy("file", F.floor(F.col("line") / 4).alias("record")).agg(part(0).alias("head"), part(1).alias("sequence"), part(2).alias("comment"), part(3).alias("quality"))
    name = F.substring(F.substring_index("head", " ", 1), F.lit(2), F.length("head"))
    return records.where("head IS NOT NULL AND quality IS NOT NULL").select("record", F.substring_index(name, "/", 1).alias("name"), F.when(F.contains(name, F.lit("/")), F.substring_index(name, "/", -1).cast("int")).alias("read_end"), "sequence", "comment", "quality")


def import_pairs(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reads (fragment, read_end, sequence, quality) numbered alike in both files, and the names.

    Records pair up by position; what only one file has is left out.
    """
    one = first.select("record", F.col("name").alias("name1"), F.col("sequence").alias("s1"), F.col("quality").alias("q1"))
    two = second.select("record", F.col("name").alias("name2"), F.col("sequence").alias("s2"), F.col("quality").alias("q2"))
    both = one.join(two, "record")
    ends = F.array(*[F.struct(F.lit(k).alias("read_end"), F.col(f"s{k}").alias("sequence"), F.col(f"q{k}").alias("quality")) for k in (1, 2)])
    reads = both.select(F.col("record").alias("fragment"), F.explode(ends).alias("x")).select("fragment", "x.*")
    return reads, both.select(F.col("record").alias("fragment"), "name1", "name2")


def sam_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """Typed SAM columns and the optional fields as one string of tabs."""
    cell = F.split(F.col(value), "\t")
    numbers = {"flag", "pos", "mapq", "mpos", "isize"}
    rows = lines.where(~F.startswith(F.col(value), F.lit("@")))
    return rows.select(*[(F.element_at(cell, i + 1).cast("int") if n in numbers else F.element_at(cell, i + 1)).alias(n) for i, n in enumerate(SAM_FIELDS)], F.array_join(F.slice(cell, 12, F.greatest(F.size(cell) - 11, F.lit(0))), "\t").alias("tags"))


def sam(spark: SparkSession, path: str) -> DataFrame:
    return sam_rows(spark.read.text(path))


def alignments(rows: DataFrame, last: str | None = None) -> DataFrame:
    """fragment, read_end (0 or 1), ref_name, strand, s, e of mapped SAM rows.

    The end comes from the name, or from the mate flags; e ignores the cigar,
    unless a column ``last`` holds it.
    """
    suffix = F.regexp_extract("qname", "/([12])$", 1)
    flag = F.col("flag")
    end = F.when(suffix != "", suffix.cast("int") - 1).when(flag.bitwiseAND(0x40) != 0, 0).when(flag.bitwiseAND(0x80) != 0, 1)
    return rows.where("rname <> '*'").select(F.regexp_replace("qname", "/[12]$", "").alias("fragment"), end.alias("read_end"), F.col("rname").alias("ref_name"), F.when(flag.bitwiseAND(0x10) != 0, "-").otherwise("+").alias("strand"), F.col("pos").alias("s"), (F.col(last) if last else F.col("pos") + F.length("seq") - 1).alias("e"))


def tsv(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema, header=header, quote="")


def gtf(spark: SparkSession, path: str, features: tuple[str, ...] = ("CDS", "exon", "start_codon", "stop_codon"), biotypes: tuple[str, ...] = (), chromosomes: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the wanted features with gene_id, transcript_id, gene_name, biotype, exon_number."""
    rows = spark.read.csv(path, sep="\t", schema="chromosome string, source string, feature string, s int, e int, score string, strand string, frame string, attributes string", comment="#", quote="")
    named = lambda key: F.nullif(F.regexp_extract("attributes", f'{key} "([^"]*)"', 1), F.lit(""))
    rows = rows.where(F.col("feature").isin(*features))
    if chromosomes:
        rows = rows.where(F.col("chromosome").isin(*chromosomes))
    must = lambda c, key: F.when(c.isNull(), F.raise_error(F.lit(f"a line without {key}")).cast("string")).otherwise(c)
    rows = rows.select("chromosome", "source", "feature", "s", "e", "strand", must(named("gene_id"), "gene_id").alias("gene_id"), must(named("transcript_id"), "transcript_id").alias("transcript_id"), named("gene_name").alias("gene_name"), F.coalesce(named("gene_biotype"), F.col("source")).alias("biotype"), named("exon_number").cast("int").alias("exon_number"))
    return rows.where(F.col("biotype").isin(*biotypes)) if biotypes else rows


def exon_regions(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, transcript_id, chromosome, strand, s, e from lines of variable length."""
    cell = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(cell) >= 6)
    pairs = F.transform(F.sequence(F.lit(5), F.size(cell) - 1, F.lit(2)), lambda i: F.struct(F.element_at(cell, i).cast("int").alias("s"), F.element_at(cell, i + 1).cast("int").alias("e")))
    return rows.select(*[F.element_at(cell, k + 1).alias(n) for k, n in enumerate(("gene_id", "transcript_id", "chromosome", "strand"))], F.explode(pairs).alias("x")).select("gene_id", "transcript_id", "chromosome", "strand", "x.s", "x.e")


def fasta(spark: SparkSession, path: str, chunk: int = 1 << 16) -> DataFrame:
    """chromosome, chunk, chunk_size, seq: sequences in pieces of a fixed size.

    Each line is placed by the summed length of the lines before it, so no
    sequence is ever one string.
    """
    lines = numbered_lines(spark, path)
    order = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    named = lines.withColumn("chromosome", F.last(F.when(F.startswith("value", F.lit(">")), F.regexp_extract("value", r"^>(\S*)", 1)), ignorenulls=True).over(order)).where(~F.startswith("value", F.lit(">")))
    before = Window.partitionBy("file", "chromosome").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    placed = named.withColumn("at", F.coalesce(F.sum(F.length("value")).over(before), F.lit(0)))
    n, size = F.length("value"), F.lit(chunk)
    pieces = placed.where(n > 0).withColumn("chunk", F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + n - 1) / size))))
    lo = F.greatest(F.col("chunk") * chunk - F.col("at"), F.lit(0))
    piece = F.substring("value", (lo + 1).cast("int"), F.least(n, (F.col("chunk") + 1) * chunk - F.col("at")).cast("int") - lo.cast("int"))
    return pieces.groupBy("chromosome", "chunk").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", piece.alias("p")))), lambda x: x["p"]), "").alias("seq")).select("chromosome", "chunk", F.lit(chunk).alias("chunk_size"), "seq")


def psl(spark: SparkSession, path: str) -> DataFrame:
    """Alignments with 1-based starts and block arrays; lines that start with no digit are skipped."""
    rows = spark.read.text(path).where(F.rlike(F.col("value"), F.lit("^[0-9]")))
    cell = F.split("value", "\t")
    cast = lambda i, n: F.element_at(cell, i + 1) if n in _PSL_TEXT else F.element_at(cell, i + 1).cast("int")
    rows = rows.select(*[cast(i, n).alias(n) for i, n in enumerate(PSL_FIELDS)])
    numbers = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("int"))
    rows = rows.withColumns({c: numbers(c) for c in ("block_sizes", "q_starts", "t_starts")})
    return rows.withColumns({"q_start": F.col("q_start") + 1, "t_start": F.col("t_start") + 1, "t_name": plain_chromosome(F.col("t_name"))})


def plain_chromosome(name):
    """Without the prefix chr; the mitochondrion is MT."""
    short = F.regexp_replace(name, "^chr", "")
    return F.when(short == "M", "MT").otherwise(short)


def repeat_rows(rows: DataFrame) -> DataFrame:
    """chromosome, s, e, type from a masking table with 0-based starts."""
    return rows.select(plain_chromosome(F.col("chrom")).alias("chromosome"), (F.col("chrom_start") + 1).alias("s"), F.col("chrom_end").alias("e"), F.col("rep_class").alias("type"))


def single_stats(spark: SparkSession, path: str) -> dict[str, str]:
    """The one row of a statistics file with a header."""
    rows = spark.read.csv(path, sep="\t", header=True).take(2)
    if len(rows) != 1:
        raise ValueError("a statistics file has a header and one row")
    return rows[0].asDict()


def region_pairs(rows: DataFrame) -> DataFrame:
    """One row per cluster with both of its regions."""
    side = lambda end: rows.where(F.col("cluster_end") == end).select("cluster_id", *[F.col(c).alias(f"{c}{end}") for c in ("ref_name", "strand", "s", "e")])
    return side(0).join(side(1), "cluster_id")


def location(text) -> list:
    """ref_name, strand, s, e of ``ref+:s-e``."""
    pattern = r"^(.*)([+-]):(-?\d+)-(-?\d+)$"
    part = lambda k: F.regexp_extract(text, pattern, k)
    return [part(1).alias("ref_name"), part(2).alias("strand"), part(3).cast("int").alias("s"), part(4).cast("int").alias("e")]


def qseq_rows(rows: DataFrame, everything: bool = False) -> DataFrame:
    """FASTQ fields of rows with machine, run, lane, tile, x, y, index, read_no, seq, qual, passed."""
    kept = rows if everything else rows.where(F.col("passed") != 0)
    return kept.select(F.concat(F.concat_ws(":", "machine", "run", "lane", "tile", "x", "y"), F.lit("/"), F.col("read_no")).alias("name"), F.translate("seq", ".", "N").alias("sequence"), sanger_quality(F.col("qual")).alias("quality"))


def fastq_of_sam(rows: DataFrame) -> DataFrame:
    """Reads as sequenced: minus strand rows are turned back."""
    minus = F.col("flag").bitwiseAND(0x10) != 0
    end = F.when(F.col("flag").bitwiseAND(0x40) != 0, "/1").when(F.col("flag").bitwiseAND(0x80) != 0, "/2").otherwise("")
    return rows.select(F.concat("qname", end).alias("name"), F.when(minus, reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("sequence"), F.when(minus, F.reverse("qual")).otherwise(F.col("qual")).alias("quality"))


def native_to_sam(rows: DataFrame) -> DataFrame:
    """SAM columns and an MD tag from rows name, strand, ref, offset, seq, qual, others, mismatches."""
    parts = F.filter(F.split(F.coalesce("mismatches", F.lit("")), ","), lambda x: x != "")
    place = lambda m: F.substring_index(m, ":", 1).cast("int")
    base = lambda m: F.substring(F.substring_index(m, ":", -1), 1, 1)
    n = F.length("seq")
    forward = F.transform(parts, lambda m: F.struct(F.when(F.col("strand") == "-", n - 1 - place(m)).otherwise(place(m)).alias("at"), base(m).alias("b")))
    ordered = F.sort_array(forward)
    md = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("t")), lambda a, m: F.struct((m["at"] + 1).alias("at"), F.concat(a["t"], (m["at"] - a["at"]).cast("string"), m["b"]).alias("t")), lambda a: F.concat(a["t"], (n - a["at"]).cast("string")))
    return rows.select(F.col("name").alias("qname"), F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"), F.col("ref").alias("rname"), (F.col("offset") + 1).alias("pos"), F.when(F.col("others") == 0, 25).otherwise(0).alias("mapq"), F.concat(n.cast("string"), F.lit("M")).alias("cigar"), "seq", "qual", F.size(parts).alias("nm"), md.alias("md"))


def paired_mates(rows: DataFrame, first_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read pairs joined by name in any order, and the names without a mate.

    rows: name, read_end (1 or 2), seq, qual, minus, failed. Pairs in which a
    read failed are dropped; with ``first_only`` one pair per name stays.
    """
    turned = rows.select("name", "read_end", F.when(F.col("minus"), reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(F.col("minus"), F.reverse("qual")).otherwise(F.col("qual")).alias("qual"), "failed")
    side = lambda k: turned.where(F.col("read_end") == k).select("name", F.col("seq").alias(f"seq{k}"), F.col("qual").alias(f"qual{k}"), F.col("failed").alias(f"failed{k}"))
    one, two = side(1), side(2)
    if first_only:
        one, two = (x.withColumn("__n", F.row_number().over(Window.partitionBy("name").orderBy(*x.columns[1:3]))).where("__n = 1").drop("__n") for x in (one, two))
    both = one.join(two, "name").where("NOT failed1 AND NOT failed2").drop("failed1", "failed2")
    alone = one.join(two, "name", "left_anti").select("name").unionByName(two.join(one, "name", "left_anti").select("name"))
    return both, alone


def edge_list(spark: SparkSession, path: str) -> DataFrame:
    """Edges of a bipartite graph, tab-separated: left, right."""
    return spark.read.option("sep", "\t").schema("left string, right string").csv(path)


def first_ends(clusters: DataFrame) -> DataFrame:
    """Rows of the first end of every cluster: the variant that resolves clusters by one end."""
    return clusters.where("cluster_end = 0")
