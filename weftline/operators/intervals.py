"""Interval joins, nearest neighbours, islands and depth.

All joins are equi-joins on bins with a recheck; a pair is kept only in the
first bin that both intervals share, so no distinct is needed. Hot bins are
split by adaptive execution, as the join sits right above its exchanges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.intervals import bin_of, bins, contains, overlaps
from weftline.operators.tasks import dealt

BIN = 10_000


def binned(df: DataFrame, s: str, e: str, size: int, name: str = "__bin") -> DataFrame:
    return df.withColumn(name, F.explode(bins(F.col(s), F.col(e), size)))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], left_at: tuple[str, str], right_at: tuple[str, str], size: int = BIN, condition: Column | None = None, how: str = "overlap", slack: int = 0) -> DataFrame:
    """Rows of left and right with equal keys whose intervals meet.

    ``how``: overlap, or within (left inside right widened by ``slack``).
    Column names of the two sides must differ.
    """
    (ls, le), (rs, re) = left_at, right_at
    lo, hi = F.col(rs) - slack, F.col(re) + slack
    a = left.where(F.col(le) >= F.col(ls)).withColumn("__bin", F.explode(bins(F.col(ls), F.col(le), size)))
    b = right.where(F.col(re) >= F.col(rs)).withColumn("__bin_r", F.explode(bins(lo, hi, size)))
    on = F.col("__bin") == F.col("__bin_r")
    for lk, rk in keys:
        on = on & (F.col(lk) == F.col(rk))
    exact = overlaps(F.col(ls), F.col(le), lo, hi) if how == "overlap" else contains(F.col(rs), F.col(re), F.col(ls), F.col(le), slack)
    first = F.col("__bin") == F.greatest(bin_of(F.col(ls), size), bin_of(lo, size))
    found = a.join(b, on & exact & first & (F.lit(True) if condition is None else condition))
    return found.drop("__bin", "__bin_r")


def point_join(points: DataFrame, intervals: DataFrame, keys: list[tuple[str, str]], at: str, interval: tuple[str, str], size: int = BIN) -> DataFrame:
    """Points with the intervals that hold them."""
    a = points.withColumn("__bin", bin_of(F.col(at), size))
    b = binned(intervals.where(F.col(interval[1]) >= F.col(interval[0])), *interval, size, "__bin_r")
    on = F.col("__bin") == F.col("__bin_r")
    for lk, rk in keys:
        on = on & (F.col(lk) == F.col(rk))
    return a.join(b, on & F.col(at).between(F.col(interval[0]), F.col(interval[1]))).drop("__bin", "__bin_r")


def islands(df: DataFrame, keys: list[str], s: str = "s", e: str = "e", gap: int = 1, by: list[str] | None = None) -> DataFrame:
    """Intervals merged where the next starts at most ``gap`` after the running end.

    ``by``: the keys by which rows are dealt to tasks, if not all of them.
    """
    df = dealt(df.select(*keys, s, e), *(keys if by is None else by))
    order = Window.partitionBy(*keys).orderBy(s, e)
    before = F.max(e).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(s) > before + gap), 1).otherwise(0)
    marked = df.select(*keys, s, e, new.alias("__new"))
    marked = marked.withColumn("island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "island").agg(F.min(s).alias(s), F.max(e).alias(e), F.count("*").alias("n"))


def island_numbers(df: DataFrame, keys: list[str], s: str, e: str, gap: int = 0) -> DataFrame:
    """Every row with the number of its island."""
    order = Window.partitionBy(*keys).orderBy(s, e)
    before = F.max(e).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("__new", F.when(before.isNull() | (F.col(s) > before + gap), 1).otherwise(0))
    return marked.withColumn("island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def depth(df: DataFrame, keys: list[str], s: str = "s", e: str = "e") -> DataFrame:
    """Depth per maximal range of equal depth, by a sweep over starts and ends."""
    events = df.select(*keys, F.explode(F.array(F.struct(F.col(s).alias("at"), F.lit(1).alias("d")), F.struct((F.col(e) + 1).alias("at"), F.lit(-1).alias("d")))).alias("x"))
    events = events.groupBy(*keys, F.col("x.at").alias("at")).agg(F.sum("x.d").alias("d"))
    order = Window.partitionBy(*keys).orderBy("at")
    swept = events.select(*keys, F.col("at").alias("s"), (F.lead("at").over(order) - 1).alias("e"), F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"))
    return swept.where("depth > 0")


def nearest(points: DataFrame, intervals: DataFrame, key: str, at: str, ident: str, interval: tuple[str, str], size: int = BIN, width: int = 1 << 20) -> DataFrame:
    """Each distinct point with its nearest interval: smallest distance, then smallest id.

    Candidates are intervals that hold the point, the last one that ends before
    and the first one that starts after; ordered windows carry the latter two.
    """
    s, e = interval
    points = dealt(points.select(key, at), key, at).distinct()
    inside = point_join(points, intervals.select(F.col(key).alias("__key"), ident, s, e), [(key, "__key")], at, interval, size)
    inside = inside.select(key, at, F.lit(0).cast("long").alias("distance"), F.col(ident))

    def carried(position: Column, down: bool) -> DataFrame:
        # ranges of one key are swept apart; each starts from the edge that the ranges before it end with
        edge = intervals.groupBy(key, position.alias(at)).agg(F.min(ident).alias(ident)).withColumn("edge", F.col(at))
        mixed = edge.unionByName(points.select(key, at).withColumn(ident, F.lit(None).cast(edge.schema[ident].dataType)).withColumn("edge", F.lit(None).cast(edge.schema["edge"].dataType)))
        mixed = mixed.withColumn("__range", F.floor(F.col(at) / width))
        held = F.when(F.col("edge").isNotNull(), F.struct("edge", ident))
        ends = mixed.groupBy(key, "__range").agg((F.max if down else F.min)(held).alias("__end"))
        ranges = Window.partitionBy(key).orderBy(F.col("__range") if down else F.col("__range").desc()).rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(F.col(key).alias("__key"), F.col("__range").alias("__r"), F.last("__end", ignorenulls=True).over(ranges).alias("__before"))
        order = Window.partitionBy(key, "__range").orderBy(F.col(at) if down else F.col(at).desc(), F.col("edge").isNull()).rowsBetween(Window.unboundedPreceding, 0)
        swept = dealt(mixed, key, "__range").withColumn("__own", F.last(held, ignorenulls=True).over(order)).where(F.col("edge").isNull())
        swept = swept.join(ends, (F.col(key) == F.col("__key")) & (F.col("__range") == F.col("__r")))
        found = swept.withColumn("__last", F.coalesce("__own", "__before")).where(F.col("__last").isNotNull())
        return found.select(key, at, F.abs(F.col(at) - F.col("__last.edge")).cast("long").alias("distance"), F.col(f"__last.{ident}").alias(ident))

    every = inside.unionByName(carried(F.col(e), True)).unionByName(carried(F.col(s), False))
    return dealt(every, key, at).groupBy(key, at).agg(F.min(F.struct("distance", ident)).alias("m")).select(key, at, F.col("m.distance").alias("distance"), F.col(f"m.{ident}").alias(ident))


def adjacency(genes: DataFrame, key: str, ident: str, interval: tuple[str, str]) -> DataFrame:
    """Pairs of genes in the same island or in consecutive ones, smaller id first."""
    numbered = island_numbers(genes.select(key, ident, *interval), [key], *interval)
    a = numbered.select(key, F.col(ident).alias("gene1"), F.explode(F.array("island", F.col("island") + 1)).alias("island"), F.col("island").alias("own"))
    b = numbered.select(key, F.col(ident).alias("gene2"), "island")
    pairs = a.join(b, [key, "island"]).where(F.col("gene1") != F.col("gene2"))
    return pairs.select(key, F.least("gene1", "gene2").alias("gene1"), F.greatest("gene1", "gene2").alias("gene2")).distinct()


def sums_below(points: DataFrame, rows: DataFrame, key: str, at: str, place: str, size: str, name: str, reached: bool = False, width: int = 1 << 20) -> DataFrame:
    """points with the sum of ``size`` over the rows of their key whose ``place`` is below ``at``, or at it if ``reached``.

    Ranges of places of one key are summed apart; each starts from the sums of
    the ranges before it, so no key is one task.
    """
    names = points.columns
    # a point stands before or after the rows at its place
    held = points.select(key, F.col(at).alias("__at"), F.lit(1 if reached else 0).alias("__turn"), F.lit(None).cast("long").alias("__size"), F.struct(*names).alias("__point"))
    given = rows.select(key, F.col(place).alias("__at"), F.lit(0 if reached else 1).alias("__turn"), F.col(size).cast("long").alias("__size"), F.lit(None).cast(held.schema["__point"].dataType).alias("__point"))
    both = held.unionByName(given).withColumn("__range", F.floor(F.col("__at") / width))
    totals = both.groupBy(key, "__range").agg(F.coalesce(F.sum("__size"), F.lit(0)).alias("__n"))
    ranges = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col(key).alias("__key"), F.col("__range").alias("__r"), F.coalesce(F.sum("__n").over(ranges), F.lit(0)).alias("__before"))
    running = F.sum("__size").over(Window.partitionBy(key, "__range").orderBy("__at", "__turn").rowsBetween(Window.unboundedPreceding, 0))
    mine = both.withColumn("__sum", F.coalesce(running, F.lit(0))).where("__point IS NOT NULL")
    found = mine.join(totals, (F.col(key) == F.col("__key")) & (F.col("__range") == F.col("__r")))
    return found.select(*[F.col(f"__point.{c}").alias(c) for c in names], (F.col("__sum") + F.col("__before")).alias(name))
