"""Predicates and measures on closed, 1-based intervals, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 <= e2) & (s2 <= e1)


def contains(outer_s: Column, outer_e: Column, s: Column, e: Column, slack: int = 0) -> Column:
    """The second interval lies in the first, widened by ``slack`` on both sides."""
    return (s >= outer_s - slack) & (e <= outer_e + slack)


def contains_any(regions: Column, s: Column, e: Column) -> Column:
    """Some region of an array of struct(start, end) contains the interval."""
    return F.exists(regions, lambda r: (r["start"] <= s) & (r["end"] >= e))


def overlap_size(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.least(e1, e2) - F.greatest(s1, s2) + 1, F.lit(0))


def expanded(s: Column, e: Column, by: int) -> tuple[Column, Column]:
    return s - by, e + by


def length(s: Column, e: Column) -> Column:
    return e - s + 1


def regions_length(regions: Column) -> Column:
    """Summed length of an array of struct(start, end)."""
    return F.aggregate(regions, F.lit(0).cast("long"), lambda a, r: a + (r["end"] - r["start"] + 1).cast("long"))


def bin_of(x: Column, size: int) -> Column:
    """Bin number of a position, truncated toward zero."""
    return (x / F.lit(size)).cast("long")


def bins(s: Column, e: Column, size: int) -> Column:
    """All bins an interval touches; empty for an interval that ends before it starts."""
    return F.when(e >= s, F.sequence(bin_of(s, size), bin_of(e, size))).otherwise(F.array().cast("array<bigint>"))
