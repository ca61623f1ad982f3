"""Writers: tables, sequences, and partitions by chromosome pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rendered(rows: DataFrame, flags: list[str] = (), missing: str = "") -> DataFrame:
    """Booleans as Y and N, arrays joined by commas, nulls as the sentinel."""
    out = {}
    for name, kind in rows.dtypes:
        c = F.col(name)
        c = F.when(c, "Y").otherwise("N") if name in flags or kind == "boolean" else F.array_join(c.cast("array<string>"), ",") if kind.startswith("array") else c.cast("string")
        out[name] = F.coalesce(c, F.lit(missing))
    return rows.select(*[c.alias(n) for n, c in out.items()])


def write_tsv(rows: DataFrame, path: str, header: bool = True, missing: str = "") -> None:
    rendered(rows, missing=missing).write.csv(path, sep="\t", header=header, quote="", emptyValue="")


def write_chromosome_pairs(rows: DataFrame, path: str) -> None:
    """One folder per ordered pair; rows meet by pair and fragment, so that a hot pair is many files."""
    rows.repartition("chr1", "chr2", F.pmod(F.hash("fragment"), F.lit(64))).write.partitionBy("chr1", "chr2").parquet(path)


def fasta_text(name: Column, sequence: Column) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), sequence)


def fastq_text(name: Column, sequence: Column, quality: Column) -> Column:
    return F.concat(F.lit("@"), name, F.lit("\n"), sequence, F.lit("\n+\n"), quality)


def write_lines(rows: DataFrame, line: Column, path: str, max_records: int = 0) -> None:
    """One text record per row; files hold at most ``max_records`` rows if given."""
    writer = rows.select(line.alias("value")).write
    (writer.option("maxRecordsPerFile", max_records) if max_records else writer).text(path)


def write_chunks(rows: DataFrame, path: str, record: Column, order: str, size: int) -> DataFrame:
    """Write records in chunks of ``size`` rows each and give the catalogue: chunk, first_fragment, last_fragment, n.

    ``order`` numbers the rows densely from 0; chunk k is the folder chunk=k.
    """
    cut = rows.select(F.floor(F.col(order) / size).alias("chunk"), F.col(order).alias("place"), record.alias("value"))
    cut.repartition("chunk").sortWithinPartitions("chunk", "place").select("chunk", "value").write.partitionBy("chunk").text(path)
    return cut.groupBy("chunk").agg(F.min("place").alias("first_fragment"), F.max("place").alias("last_fragment"), F.count("*").alias("n"))


def write_round_robin(rows: DataFrame, path: str, record: Column, order: str, parts: int) -> None:
    """Write row i, numbered by ``order``, to the folder part=i mod parts."""
    rows.select(F.pmod(F.col(order), F.lit(parts)).alias("part"), record.alias("value")).write.partitionBy("part").text(path)


def stripped_header(line: Column) -> Column:
    """A sequence header without its description."""
    return F.when(F.startswith(line, F.lit(">")), F.regexp_replace(line, r"\s.*", "")).otherwise(line)


def table_to_fasta(rows: DataFrame, columns: list[str]) -> DataFrame:
    """name and sequence: the last column is the sequence, the others name it."""
    *names, seq = columns
    return rows.select(F.concat_ws("_", *names).alias("name"), F.col(seq).alias("sequence"))


def exon_region_text(exons: DataFrame) -> DataFrame:
    """Lines of gene, transcript, chromosome, strand and all exon starts and ends."""
    pairs = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s", "e"))), lambda x: F.concat_ws("\t", x["s"], x["e"])), "\t")
    return exons.groupBy("gene_id", "transcript_id", "chromosome", "strand").agg(pairs.alias("pairs")).select(F.concat_ws("\t", "gene_id", "transcript_id", "chromosome", "strand", "pairs").alias("value"))
