"""Conversions between read formats, on text lines or fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.sequences import sanger_quality

_OLD_LETTERS = "".join(chr(64 + q) for q in range(0, 63))
_NEW_LETTERS = "".join(chr(33 + q) for q in range(0, 63))


def numbers_to_letters(numbers: Column, old_scale: bool) -> Column:
    """Space-separated quality numbers as Phred+33 letters."""
    letters = F.array_join(F.transform(F.filter(F.split(numbers, " +"), lambda x: x != ""), lambda x: F.char(x.cast("int") + (64 if old_scale else 33))), "")
    return sanger_quality(letters) if old_scale else letters


def to_old_scale(quality: Column) -> Column:
    """Phred+33 letters with the offset of the older scale."""
    return F.translate(quality, _NEW_LETTERS, _OLD_LETTERS)


def scarf(lines: DataFrame, value: str = "value") -> DataFrame:
    """name, sequence, quality of colon-separated lines, letters or numbers."""
    cell = F.split(F.col(value), ":")
    n = F.size(cell)
    quality = F.element_at(cell, n)
    return lines.select(F.array_join(F.slice(cell, F.lit(1), n - 2), ":").alias("name"), F.element_at(cell, n - 1).alias("sequence"), F.when(F.rlike(quality, F.lit("^ *-?[0-9]+( -?[0-9]+)* *$")), numbers_to_letters(quality, True)).otherwise(sanger_quality(quality)).alias("quality"))


def export(lines: DataFrame, value: str = "value", old_scale: bool = False) -> DataFrame:
    """FASTQ fields of export lines that passed the filter."""
    cell = F.split(F.col(value), "\t")
    get = lambda k: F.element_at(cell, k)
    name = F.concat(F.concat_ws(":", *[get(k) for k in (1, 3, 4, 5, 6)]), F.lit("/"), get(8))
    return lines.where(get(22) == "Y").select(name.alias("name"), get(9).alias("sequence"), (get(10) if old_scale else sanger_quality(get(10))).alias("quality"))


def fasta_to_fastq(rows: DataFrame, quality: str = "I") -> DataFrame:
    """name, sequence with one constant quality."""
    return rows.select("name", "sequence", F.repeat(F.lit(quality), F.length("sequence")).alias("quality"))


def fastq_to_fasta(rows: DataFrame) -> DataFrame:
    return rows.select("name", "sequence")


def probabilities_to_letters(rows: DataFrame) -> DataFrame:
    """name, sequence, and the best of the four numbers of each base as quality letters."""
    best = F.array_join(F.transform(F.split("numbers", "\t"), lambda four: F.char(F.array_max(F.transform(F.filter(F.split(F.trim(four), " +"), lambda x: x != ""), lambda x: x.cast("int"))) + 64)), "")
    return rows.select("name", "sequence", sanger_quality(best).alias("quality"))


def colour_space(sequence: Column) -> Column:
    """Colours as letters: the first base and its colour are left out."""
    return F.translate(F.substring(sequence, F.lit(3), F.length(sequence)), "0123.", "ACGTN")
