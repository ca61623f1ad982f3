"""Expressions on nucleotide sequences and read qualities."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRS = [a + b for a in "ACGT" for b in "ACGT"]
SPLICE_MOTIFS = ("GTAG", "ATAC")
#: Quality characters of the older scale, from -5 to 62 above '@', and Phred+33.
_OLD = "".join(chr(64 + q) for q in range(-5, 63))
_NEW = "".join(chr(33 + int(10 * math.log10(1 + 10 ** (q / 10)) + 0.499)) for q in range(-5, 63))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def hamming(a: Column, b: Column) -> Column:
    """Differing places over the length of the shorter sequence."""
    n = F.least(F.length(a), F.length(b))
    return F.size(F.filter(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))


def pair_entropy(seq: Column) -> Column:
    """Entropy in bits of the 16 dinucleotides.

    Each pair is counted without overlaps of itself and divided by length - 1.
    """
    n = F.length(seq)
    counts = F.array(*[(n - F.length(F.replace(seq, F.lit(pair), F.lit("")))) / 2 for pair in PAIRS])
    shares = F.transform(counts, lambda c: c / (n - 1))
    total = F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 1, total)


def trimmed(seq: Column, n: int) -> Column:
    return F.substring(seq, 1, n)


def is_garbage(seq: Column, share: float = 0.9, run: float = 0.5) -> Column:
    """One symbol fills more than a share of the read, or runs over half of it."""

    def filled(s: Column) -> Column:
        n, bad = F.length(s), F.lit(False)
        for symbol in "ACTGN":
            count = n - F.length(F.replace(s, F.lit(symbol), F.lit("")))
            bad = bad | (count > n * share) | F.contains(s, F.repeat(F.lit(symbol), F.ceil(n * run).cast("int")))
        return (n > 0) & bad

    # an element is computed once, however often the test names it
    return F.exists(F.array(seq), filled)


def junction_context(seq: Column, width: int = 40) -> tuple[Column, Column]:
    """Up to ``width`` letters on each side of the ``|`` of a junction sequence."""
    at = F.instr(seq, "|")
    left = F.substring(seq, F.greatest(at - width, F.lit(1)), at - F.greatest(at - width, F.lit(1)))
    return left, F.substring(seq, at + 1, F.lit(width))


def splice_score(donor: Column, acceptor: Column) -> Column:
    """4 minus the least distance of the four letters to a splice motif, in either order."""
    four = F.concat(donor, acceptor)
    back = reverse_complement(four)
    return F.lit(4) - F.least(*[hamming(x, F.lit(m)) for x in (four, back) for m in SPLICE_MOTIFS])


def sanger_quality(quality: Column) -> Column:
    """Qualities of the older logistic scale in Phred+33."""
    return F.translate(quality, _OLD, _NEW)


def masked(seq: Column) -> Column:
    """Unknown calls, written as dots, become N."""
    return F.translate(seq, ".", "N")


def gene_of(ref_name: Column) -> Column:
    """The gene of ``gene|transcript``; a name without a bar is its own."""
    return F.substring_index(ref_name, "|", 1)


def transcript_of(ref_name: Column) -> Column:
    return F.when(F.contains(ref_name, F.lit("|")), F.substring_index(F.substring_index(ref_name, "|", 2), "|", -1))


def window(seq: Column, start: Column, size: Column, pad: bool = False) -> Column:
    """A 1-based window; starts before 1 are clipped, or padded with N."""
    clipped = F.substring(seq, F.greatest(start, F.lit(1)), F.greatest(size + F.least(start - 1, F.lit(0)), F.lit(0)))
    if not pad:
        return clipped
    left = F.repeat(F.lit("N"), F.greatest(F.least(1 - start, size), F.lit(0)).cast("int"))
    return F.rpad(F.concat(left, clipped), size.cast("int"), F.lit("N"))
