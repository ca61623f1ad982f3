"""Clusters of discordant pairs: mixture model, set cover, bookkeeping.

A cluster table has rows cluster_id, cluster_end, fragment, read_end, ref_name,
strand, s, e.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.stats import normal_quantile
from weftline.operators.tasks import dealt

LAMBDA, TOLERANCE, MAX_COMPONENTS = 0.1, 0.001, 10


class PairModel:
    """Mixture of break points (a, b) behind pairs x, y with free lengths u.

    log density: -((a + b - x - y - u) / sd)^2 / 2 - lambda * (overshoot of x and y).
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, u: np.ndarray, sd: float, penalty: float = LAMBDA):
        self.x, self.y, self.u, self.sd, self.penalty = (np.asarray(v, float) for v in (x, y, u, sd, penalty))

    def log_density(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        gap = a[:, None] + b[:, None] - self.x - self.y - self.u
        over = np.maximum(self.x - a[:, None], 0) + np.maximum(self.y - b[:, None], 0)
        return -0.5 * (gap / self.sd) ** 2 - self.penalty * over

    def best_point(self, r: np.ndarray) -> tuple[float, float]:
        """The (a, b) that maximises the weighted log density of one component.

        For a given sum s = a + b the overshoot is least where both coordinates
        leave equal weight above; along that path the objective is concave and
        piecewise quadratic, so its maximum lies on a segment or at a corner.
        """
        n = r.sum()
        if n <= 0:
            return float(self.x.max()), float(self.y.max())
        mean = float((r * (self.x + self.y + self.u)).sum() / n)
        sides = []
        for v in (self.x, self.y):
            order = np.argsort(-v, kind="stable")
            sides.append((v[order], np.cumsum(r[order])))
        levels = np.unique(np.concatenate([w for _, w in sides]))
        levels = levels[np.append(np.diff(levels) > 1e-12 * n, True)]
        # while the weight above lies between two levels, either coordinate stays at a corner
        corner = np.stack([v[np.minimum(np.searchsorted(w, levels - 1e-12 * n), len(v) - 1)] for v, w in sides], axis=1)
        # the derivative along the path vanishes at this sum for the weight above
        wish = mean + self.sd**2 * self.penalty * np.append(0.0, levels) / n
        if wish[0] >= corner[0].sum():
            spare = (wish[0] - corner[0].sum()) / 2
            return float(corner[0, 0] + spare), float(corner[0, 1] + spare)
        for j in range(len(levels)):
            here = corner[j].sum()
            if wish[j + 1] >= here:
                return float(corner[j, 0]), float(corner[j, 1])
            if j + 1 < len(levels) and wish[j + 1] >= corner[j + 1].sum():
                share = (here - wish[j + 1]) / (here - corner[j + 1].sum())
                a, b = corner[j] - share * (corner[j] - corner[j + 1])
                return float(a), float(b)
        spare = (corner[-1].sum() - wish[-1]) / 2
        return float(corner[-1, 0] - spare), float(corner[-1, 1] - spare)

    def fit(self, k: int, rounds: int = 500) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[float]]:
        """a, b, weights and the log likelihood after every round."""
        n = len(self.x)
        if k == 1 or k >= n:
            r = np.full((k, n), 1.0 / k) if k == 1 else np.eye(k, n) * 0.98 + 0.02 / k
        else:
            labels = kmeans(np.stack([self.x, self.y], axis=1), k)[1]
            r = np.eye(k)[:, labels]
        trace: list[float] = []
        weights = r.sum(1) / n
        while True:
            points = np.array([self.best_point(row) for row in r])
            weights = r.sum(1) / n
            with np.errstate(divide="ignore"):
                joint = self.log_density(points[:, 0], points[:, 1]) + np.log(weights)[:, None]
            top = joint.max(0)
            total = top + np.log(np.exp(joint - top).sum(0))
            trace.append(float(total.sum()))
            r = np.exp(joint - total)
            if len(trace) > 1 and abs(trace[-1] - trace[-2]) < TOLERANCE or len(trace) >= rounds:
                return points[:, 0], points[:, 1], weights, trace


class PairModels:
    """Mixtures of many groups with equally many pairs at once: what :class:`PairModel` gives for each.

    x, y and u have a row per group. Sums run along the pairs as in a single
    group, so the results agree to the last bit.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, u: np.ndarray, sd: float, penalty: float = LAMBDA):
        self.x, self.y, self.u, self.sd, self.penalty = x, y, u, np.float64(sd), np.float64(penalty)
        self.whole = x + y + u
        self.orders = [np.argsort(-v, axis=1, kind="stable") for v in (x, y)]
        self.sorted = [np.take_along_axis(v, o, 1) for v, o in zip((x, y), self.orders, strict=True)]

    def taken(self, rows: np.ndarray) -> PairModels:
        out = object.__new__(PairModels)
        out.sd, out.penalty = self.sd, self.penalty
        out.x, out.y, out.u, out.whole = (v[rows] for v in (self.x, self.y, self.u, self.whole))
        out.orders, out.sorted = [v[rows] for v in self.orders], [v[rows] for v in self.sorted]
        return out

    def log_density(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y, u = (v[:, None] for v in (self.x, self.y, self.u))
        gap = a[:, :, None] + b[:, :, None] - x - y - u
        over = np.maximum(x - a[:, :, None], 0) + np.maximum(y - b[:, :, None], 0)
        return -0.5 * (gap / self.sd) ** 2 - self.penalty * over

    def best_points(self, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`PairModel.best_point` of every component, as a, b."""
        groups, k, size = r.shape
        n = r.sum(2)
        with np.errstate(all="ignore"):
            mean = (r * self.whole[:, None]).sum(2) / n
            least = (1e-12 * n)[:, :, None]
            above = [np.cumsum(np.take_along_axis(r, np.broadcast_to(o[:, None], r.shape), 2), axis=2) for o in self.orders]
            levels = np.sort(np.concatenate(above, axis=2), axis=2)
            # a level that the next one nearly equals stands for that one
            levels[:, :, :-1][~(np.diff(levels, axis=2) > least)] = np.inf
            levels = np.minimum.accumulate(levels[:, :, ::-1], axis=2)[:, :, ::-1]
            edge, corner = levels - least, []
            base = (np.arange(groups) * size)[:, None, None]
            for w, v in zip(above, self.sorted, strict=True):
                place = np.zeros(edge.shape, np.int16)
                for i in range(size - 1):  # the last place holds whatever is not below an earlier one
                    place += w[:, :, i, None] < edge
                corner.append(v.ravel()[base + place])
            here = corner[0] + corner[1]
            slope = self.sd**2 * self.penalty
            wish = mean[:, :, None] + slope * levels / n[:, :, None]
            stop = wish >= here
            inner = stop.copy()
            inner[:, :, :-1] |= wish[:, :, :-1] >= here[:, :, 1:]
            j = inner.argmax(2)[:, :, None]
            none = ~inner.any(2)
            j[none] = 2 * size - 1
            at = lambda m, i=j: np.take_along_axis(m, i, 2)[:, :, 0]
            after = np.minimum(j + 1, 2 * size - 1)
            h, w, corners = at(here), at(wish), [at(c) for c in corner]
            share = (h - w) / (h - at(here, after))
            share[at(stop)] = 0.0
            out = [c - share * (c - at(m, after)) for c, m in zip(corners, corner, strict=True)]
            for found, c, m, v in zip(out, corners, corner, (self.x, self.y), strict=True):
                found[none] = (c - (h - w) / 2)[none]
                first = mean + slope * 0.0 / n
                spare = first >= here[:, :, 0]
                found[spare] = (m[:, :, 0] + (first - here[:, :, 0]) / 2)[spare]
                found[n <= 0] = np.broadcast_to(v.max(1)[:, None], n.shape)[n <= 0]
        return out[0], out[1]

    def fit(self, k: int, rounds: int = 500) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """a and b of every group's components, and its last log likelihood."""
        groups, size = self.x.shape
        if k == 1 or k >= size:
            r = np.full((groups, k, size), 1.0 / k) if k == 1 else np.repeat((np.eye(k, size) * 0.98 + 0.02 / k)[None], groups, 0)
        else:
            r = (self.seeded(k)[:, None] == np.arange(k)[:, None]).astype(float)
        a, b, last = np.zeros((groups, k)), np.zeros((groups, k)), np.zeros(groups)
        rows, model, old = np.arange(groups), self, np.full(groups, np.nan)
        for step in range(1, rounds + 1):
            own_a, own_b = model.best_points(r)
            with np.errstate(divide="ignore"):
                joint = model.log_density(own_a, own_b) + np.log(r.sum(2) / size)[:, :, None]
            top = joint.max(1)
            total = top + np.log(np.exp(joint - top[:, None]).sum(1))
            new = total.sum(1)
            done = np.abs(new - old) < TOLERANCE if step < rounds else np.ones(len(rows), bool)
            if done.any():
                ended = rows[done]
                a[ended], b[ended], last[ended] = own_a[done], own_b[done], new[done]
                if done.all():
                    break
                rows, model, joint, total, new = rows[~done], model.taken(~done), joint[~done], total[~done], new[~done]
            r, old = np.exp(joint - total[:, None]), new
        return a, b, last

    def seeded(self, k: int, rounds: int = 1000) -> np.ndarray:
        """Labels of :func:`kmeans` in every group."""
        x, y = self.x, self.y
        every = np.arange(len(x))
        seeds = [(x * y).argmax(1)]
        gap = np.full(x.shape, np.inf)
        while True:
            own = seeds[-1]
            gap = np.minimum(gap, (x - x[every, own][:, None]) ** 2 + (y - y[every, own][:, None]) ** 2)
            if len(seeds) == k:
                break
            seeds.append(gap.argmax(1))
        at = np.stack(seeds, axis=1)
        cx, cy = np.take_along_axis(x, at, 1), np.take_along_axis(y, at, 1)
        labels, rows = np.full(x.shape, -1), every
        for _ in range(rounds):
            px, py = x[rows][:, None], y[rows][:, None]
            new = ((px - cx[rows][:, :, None]) ** 2 + (py - cy[rows][:, :, None]) ** 2).argmin(1)
            moved = (new != labels[rows]).any(1)
            rows, new = rows[moved], new[moved]
            if not len(rows):
                break
            labels[rows] = new
            held = new[:, None] == np.arange(k)[:, None]
            n = held.sum(2)
            for c, p in ((cx, px[moved]), (cy, py[moved])):
                c[rows] = np.where(n > 0, np.where(held, p, 0.0).sum(2) / np.maximum(n, 1), c[rows])
        return labels


def kmeans(points: np.ndarray, k: int, rounds: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Centres and labels; seeds are the largest product and then the farthest point."""
    seeds = [int((points[:, 0] * points[:, 1]).argmax())]
    while len(seeds) < k:
        gap = ((points[:, None] - points[seeds]) ** 2).sum(2).min(1)
        seeds.append(int(gap.argmax()))
    centres = points[seeds].astype(float)
    labels = np.full(len(points), -1)
    for _ in range(rounds):
        new = ((points[:, None] - centres) ** 2).sum(2).argmin(1)
        if (new == labels).all():
            break
        labels = new
        for j in range(k):
            if (labels == j).any():
                centres[j] = points[labels == j].mean(0)
    return centres, labels


def cluster_pairs(x, y, u, mean: float, sd: float, precision: float, least: int) -> list[np.ndarray]:
    """Member numbers of every component with enough members; the count is chosen by BIC."""
    model, n = PairModel(x, y, u, sd), len(x)
    fits = {k: model.fit(k) for k in range(1, min(MAX_COMPONENTS, n) + 1)}
    best = min(fits, key=lambda k: (-2 * fits[k][3][-1] + 2 * k * math.log(n), k))
    a, b, _, _ = fits[best]
    edge = -0.5 * (normal_quantile((1 - precision) / 2)) ** 2
    inside = model.log_density(a, b) > edge
    return [np.flatnonzero(row) for row in inside if row.sum() >= least]


#: Groups with more pairs are fitted one by one; numbers of all components in a batch.
MANY_PAIRS, BATCH = 64, 60_000


def cluster_groups(groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]], mean: float, sd: float, precision: float, least: int) -> list[list[np.ndarray]]:
    """:func:`cluster_pairs` of every group (x, y, u); groups with equally many pairs are fitted together."""
    edge = -0.5 * (normal_quantile((1 - precision) / 2)) ** 2
    out: list[list[np.ndarray]] = [[] for _ in groups]
    by_size: dict[int, list[int]] = {}
    for g, (x, _, _) in enumerate(groups):
        by_size.setdefault(len(x), []).append(g)
    for n, every in by_size.items():
        if n > MANY_PAIRS or n == 0:
            for g in every:
                out[g] = cluster_pairs(*groups[g], mean, sd, precision, least)
            continue
        width = max(1, BATCH // (2 * n * min(MAX_COMPONENTS, n)))
        for start in range(0, len(every), width):
            part = every[start : start + width]
            model = PairModels(*(np.stack([np.asarray(groups[g][i], float) for g in part]) for i in range(3)), sd)
            score, points, rows = np.full(len(part), np.inf), [(np.zeros(0), np.zeros(0))] * len(part), np.arange(len(part))
            for k in range(1, min(MAX_COMPONENTS, n) + 1):
                # no log density is above 0, so nobody with k components or more scores less than this
                rows = rows[score[rows] > 2 * k * math.log(n) - 1e-6]
                if not len(rows):
                    break
                a, b, last = model.taken(rows).fit(k)
                own = -2 * last + 2 * k * math.log(n)
                for i in np.flatnonzero(own < score[rows]):
                    score[rows[i]], points[rows[i]] = own[i], (a[i], b[i])
            for g, (a, b) in zip(part, points, strict=True):
                inside = PairModel(*groups[g], sd).log_density(a, b) > edge
                out[g] = [np.flatnonzero(row) for row in inside if row.sum() >= least]
    return out


#: Takes x, y, u, mean, sd, precision, least; gives the member numbers of each cluster.
Clusterer = Callable[..., list[np.ndarray]]


def discordant_clusters(pairs: DataFrame, keys: list[str], mean: float, sd: float, precision: float = 0.95, least: int = 5, clusterer: Clusterer = cluster_pairs) -> DataFrame:
    """Rows keys, component, fragment of the clusters in every bin pair.

    pairs: keys, fragment, x, y (strand-space ends), len1, len2. A bin pair's
    fragments are bounded by the guards on multi-mapping and bin size. Another
    ``clusterer`` may take the place of the mixture model.
    """
    schema = ", ".join(f"{k} {t}" for k, t in pairs.select(*keys).dtypes) + ", component int, fragment long"
    parts = ["fragment", "x", "y", "len1", "len2"]

    def solve(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lists = batch.column("members")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            fragment, x, y, len1, len2 = (flat.field(c).to_numpy(zero_copy_only=False) for c in parts)
            u = mean - len1 - len2
            cuts = [slice(lo, hi) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
            groups = [(x[c], y[c], u[c]) for c in cuts]
            found = cluster_groups(groups, mean, sd, precision, least) if clusterer is cluster_pairs else [clusterer(*g, mean, sd, precision, least) for g in groups]
            row, component, own = [], [], []
            for g, (c, clusters) in enumerate(zip(cuts, found, strict=True)):
                for k, members in enumerate(clusters):
                    held = np.unique(fragment[c][members])
                    if len(held) >= least:
                        row.append(np.full(len(held), g))
                        component.append(np.full(len(held), k, np.int32))
                        own.append(held.astype(np.int64))
            if row:
                at = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), pa.array(np.concatenate(component)), pa.array(np.concatenate(own))], names=[*keys, "component", "fragment"])

    # work grows faster than bytes, so partitions are not merged by their bytes
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.select(*keys, *parts).repartition(tasks, *keys)
    sets = dealt.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("members"))
    # groups that can't give a cluster stay out of Python
    wanted = sets.where(F.size(F.array_distinct(F.transform("members", lambda m: m["fragment"]))) >= least)
    return wanted.mapInArrow(solve, schema)


def binned_clusters(pairs: DataFrame, key: str, size: int, mean: float, sd: float, precision: float = 0.95, least: int = 5) -> DataFrame:
    """Rows key, xbin, component, fragment of the clusters along x of every key.

    A pair lies in every bin within mean + 10 sd of its x, so no cluster is cut
    at an edge; bins below 0 hold the minus strand, whose x is negative. Equal
    clusters are given once, in the smallest bin.
    """
    reach = int(mean + 10 * sd)
    place = F.abs("x")
    at = F.explode(F.sequence(F.floor(F.greatest(place - reach, F.lit(0)) / size), F.floor((place + reach) / size)))
    binned = pairs.withColumn("xbin", at).withColumn("xbin", F.when(F.col("x") < 0, -1 - F.col("xbin")).otherwise(F.col("xbin")))
    found = discordant_clusters(binned, [key, "xbin"], mean, sd, precision, least)
    sets = found.groupBy(key, "xbin", "component").agg(F.sort_array(F.collect_list("fragment")).alias("members"))
    once = sets.groupBy(key, F.col("xbin") < 0, "members").agg(F.min(F.struct("xbin", "component")).alias("at"))
    return once.select(key, "at.xbin", "at.component", F.explode("members").alias("fragment"))


def set_cover(members: DataFrame, least: int = 1) -> DataFrame:
    """Greedy cover: cluster_id, fragment, each fragment in the cluster that claimed it.

    The largest remaining cluster claims its free fragments, smaller ids first
    among equals. Components of clusters that share fragments are independent;
    each is solved in one task, which holds about 12 bytes a pair.
    """
    from weftline.operators.graphs import components

    ids = members.select("cluster_id", "fragment").distinct()
    first = ids.groupBy("fragment").agg(F.min("cluster_id").alias("first"))
    edges = ids.join(first, "fragment").where("first <> cluster_id").select(F.col("first").alias("u"), F.col("cluster_id").alias("v")).distinct()
    parts = components(edges)
    placed = ids.join(parts.select(F.col("vertex").alias("cluster_id"), "component"), "cluster_id", "left").withColumn("component", F.coalesce("component", "cluster_id"))

    def solve(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, part, held = ["cluster_id", "fragment"], None, []
        for batch in stream:
            component, cluster, fragment = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = np.append(np.flatnonzero(np.diff(component, prepend=component[:1] - 1)), len(component))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if held and component[lo] != part:
                    yield from (pa.RecordBatch.from_arrays([pa.array(v) for v in x], names=names) for x in greedy_cover(held, least))
                    held = []
                part = component[lo]
                held.append((cluster[lo:hi].copy(), fragment[lo:hi].copy()))
        if held:
            yield from (pa.RecordBatch.from_arrays([pa.array(v) for v in x], names=names) for x in greedy_cover(held, least))

    sorted_pairs = dealt(placed.select(*[F.col(c).cast("long").alias(c) for c in ("component", "cluster_id", "fragment")]), "component").sortWithinPartitions("component", "fragment")
    return sorted_pairs.mapInArrow(solve, "cluster_id long, fragment long")


def greedy_cover(held: list[tuple[np.ndarray, np.ndarray]], least: int = 1, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Claimed (clusters, fragments) of one component, ``most`` or somewhat more at a time.

    held: its distinct pairs in the order of the fragments, in pieces, of which it is emptied.
    """
    clusters = np.array([], np.int64)
    for c, _ in held:
        clusters = np.union1d(clusters, c)
    total, at, number = sum(len(c) for c, _ in held), 0, -1
    of, where, names, starts = np.empty(total, np.int32), np.empty(total, np.int32), [], []
    held.reverse()
    last = None
    while held:  # numbers in place of ids, piece by piece
        c, f = held.pop()
        new = np.flatnonzero(np.diff(f, prepend=f[:1] - 1 if last is None else last) != 0)
        step = np.zeros(len(f), np.int32)
        step[new] = 1
        where[at : at + len(f)] = number + np.cumsum(step, dtype=np.int32)
        of[at : at + len(f)] = np.searchsorted(clusters, c)
        names.append(f[new])
        starts.append(new + at)
        at, number, last = at + len(f), number + len(new), f[-1:]
    names, starts = np.concatenate(names), np.append(np.concatenate(starts), total)
    size = np.bincount(of, minlength=len(clusters))
    ends = np.append(0, np.cumsum(size))
    inside, free_place = np.empty(total, np.int32), ends[:-1].copy()
    for lo in range(0, total, most):  # the fragments of every cluster, by counting
        c = of[lo : lo + most]
        order = np.argsort(c, kind="stable")
        own, first, n = np.unique(c[order], return_index=True, return_counts=True)
        inside[np.repeat(free_place[own] - first, n) + np.arange(len(c))] = where[lo : lo + most][order]
        free_place[own] += n
    del where
    free, heap = np.ones(len(names), bool), [(-int(n), c) for c, n in enumerate(size)]
    heapq.heapify(heap)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    while heap:
        n, c = heapq.heappop(heap)
        if -n != size[c]:
            if size[c]:
                heapq.heappush(heap, (-int(size[c]), c))
            continue
        if not n:
            continue
        claimed = inside[ends[c] : ends[c + 1]]
        claimed = claimed[free[claimed]]
        free[claimed] = False
        if len(claimed) >= least:
            out.append((np.full(len(claimed), clusters[c]), names[claimed]))
            rows += len(claimed)
            if rows >= most:
                yield tuple(np.concatenate(v) for v in zip(*out, strict=True))
                out, rows = [], 0
        lows, n = starts[claimed], starts[claimed + 1] - starts[claimed]
        np.subtract.at(size, of[np.repeat(lows - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())], 1)
    if out:
        yield tuple(np.concatenate(v) for v in zip(*out, strict=True))


def regions(clusters: DataFrame) -> DataFrame:
    """Bounds per cluster and end; a cluster without both ends is left out."""
    both = clusters.groupBy("cluster_id").agg(F.min("cluster_end").alias("lo"), F.max("cluster_end").alias("hi")).where("lo <> hi").select("cluster_id")
    return clusters.join(both, "cluster_id", "left_semi").groupBy("cluster_id", "cluster_end", "ref_name", "strand").agg(F.min("s").alias("s"), F.max("e").alias("e"))


def renumbered(rows: DataFrame, parts: list[str]) -> DataFrame:
    """Dense new ids over distinct old ids of all parts.

    The distinct ids are dealt to ranges; each range counts from where the ranges before it end.
    """
    from weftline.operators.graphs import checkpointed

    ids = checkpointed(rows.select(*parts).distinct().repartitionByRange(*parts).withColumn("__range", F.spark_partition_id()))
    sizes = ids.groupBy("__range").agg(F.count("*").alias("__n"))  # a row per range
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*parts)) - 1
    numbered = ids.withColumn("__place", place).join(F.broadcast(sizes.select("__range", before.alias("__before"))), "__range")
    return rows.join(numbered.select(*parts, (F.col("__before") + F.col("__place")).alias("new_id")), parts)


def without_mixed_mt(clusters: DataFrame, mt: str = "MT") -> DataFrame:
    """Clusters with no end on the mitochondrion, or both on one chromosome."""
    seen = clusters.groupBy("cluster_id").agg(F.min("ref_name").alias("lo"), F.max("ref_name").alias("hi"), F.max((F.col("ref_name") == mt).cast("int")).alias("mt"))
    return clusters.join(seen.where("mt = 0 OR lo = hi").select("cluster_id"), "cluster_id", "left_semi")


def dedupe_positions(clusters: DataFrame) -> DataFrame:
    """One fragment, the smallest, per pair of outer positions in each cluster."""
    outer = F.when(F.col("strand") == "+", F.col("s")).otherwise(F.col("e"))
    ends = dealt(clusters.select("cluster_id", "fragment", "cluster_end", outer.alias("outer")), "cluster_id", "fragment")
    wide = ends.groupBy("cluster_id", "fragment").agg(F.min(F.when(F.col("cluster_end") == 0, F.col("outer"))).alias("p0"), F.min(F.when(F.col("cluster_end") == 1, F.col("outer"))).alias("p1"))
    return dealt(wide, "cluster_id", "p0", "p1").groupBy("cluster_id", "p0", "p1").agg(F.min("fragment").alias("fragment"))


def linkage(distances: np.ndarray, threshold: float) -> list[list[int]]:
    """Average-linkage clusters: nearest pairs merge while their distance is below the threshold."""
    n = len(distances)
    d = distances.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    groups = {i: [i] for i in range(n)}
    while len(groups) > 1:
        i, j = divmod(int(d.argmin()), n)
        if not d[i, j] < threshold:
            break
        i, j = min(i, j), max(i, j)
        a, b = len(groups[i]), len(groups[j])
        merged = (a * d[i] + b * d[j]) / (a + b)
        d[i], d[:, i] = merged, merged
        d[i, i] = np.inf
        d[j], d[:, j] = np.inf, np.inf
        groups[i] += groups.pop(j)
    return [sorted(g) for g in groups.values()]


def vector_linkage(x: np.ndarray, threshold: float, block: int = 1 << 21) -> np.ndarray:
    """The clusters of :func:`linkage` over the Euclidean distances of the rows of x: a row's smallest fellow.

    Average linkage never brings a cluster nearer to others by a merge, so in a
    round all clusters that are each other's nearest merge at once, and one with
    nobody within the threshold is done. Distances are computed where a nearest
    cluster is unknown, ``block`` at a time, and are never kept.
    """
    n = len(x)
    owner, near, gap = np.arange(n), np.full(n, -1), np.full(n, np.inf)
    squares, alive, wanted = (x * x).sum(1), np.ones(n, bool), np.ones(n, bool)
    while True:
        points = np.flatnonzero(alive[owner])
        points = points[np.argsort(owner[points], kind="stable")]
        ids, starts, sizes = np.unique(owner[points], return_index=True, return_counts=True)
        if len(ids) < 2:
            return owner
        held, norms, single = x[points], squares[points], len(ids) == len(points)
        todo = np.flatnonzero(wanted[ids])
        at = 0
        while at < len(todo):
            most = max(1, block // len(points))
            stop = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[todo[at:]]), most, side="right")))
            some, at = todo[at:stop], stop
            rows = np.concatenate([np.arange(starts[c], starts[c] + sizes[c]) for c in some])
            sums = []
            for lo in range(0, len(rows), most):  # only a large cluster takes more than one
                part = rows[lo : lo + most]
                d = norms[part][:, None] + norms - 2 * (held[part] @ held.T)
                d = np.sqrt(np.maximum(d, 0, out=d), out=d)
                sums.append(d if single else np.add.reduceat(d, starts, axis=1))
            if len(sums) > 1:
                total = sum(v.sum(0) for v in sums)[None]
            else:
                total = sums[0] if single else np.add.reduceat(sums[0], np.append(0, np.cumsum(sizes[some])[:-1]), axis=0)
            mean = total / (sizes[some][:, None] * sizes)
            mean[np.arange(len(some)), some] = np.inf
            best = mean.argmin(1)
            near[ids[some]], gap[ids[some]] = ids[best], mean[np.arange(len(some)), best]
        close = ids[gap[ids] < threshold]
        if not len(close):
            return owner
        alive[:] = False
        alive[close], alive[near[close]] = True, True
        first = close[(near[near[close]] == close) & (close < near[close])]
        if not len(first):  # rounding set the two ways of a distance apart
            c = close[gap[close].argmin()]
            first = np.array([min(c, near[c])])
            near[first] = max(c, near[c])
        second = near[first]
        merged = np.zeros(n, bool)
        merged[first], merged[second] = True, True
        into = np.arange(n)
        into[second] = first
        owner = into[owner]
        alive[second] = False
        wanted = merged | (alive & merged[near])


def hierarchical(points: DataFrame, key: str, ident: str, vector: str, threshold: float) -> DataFrame:
    """Average-linkage clusters of the vectors of every key: key, ident, group_id (smallest id)."""
    kind = dict(points.dtypes)

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(ident)
        owner = vector_linkage(np.stack(group[vector].to_numpy()).astype(float), threshold)
        return pd.DataFrame({key: group[key], ident: group[ident], "group_id": group[ident].to_numpy()[owner]})

    # work grows faster than bytes, so keys are not brought together by their bytes
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return points.repartition(tasks, key).groupBy(key).applyInPandas(solve, f"{key} {kind[key]}, {ident} {kind[ident]}, group_id {kind[ident]}")


def span_stats(members: DataFrame, breaks: DataFrame, inter_length: Column) -> DataFrame:
    """Mean implied fragment length and number of fragments per cluster with a break."""
    plus = F.col("strand") == "+"
    size = F.when(plus, F.col("break_pos") - F.col("s") + 1).otherwise(F.col("e") - F.col("break_pos") + 1)
    sides = members.join(breaks, ["cluster_id", "cluster_end"]).withColumn("size", size)
    per = sides.groupBy("cluster_id", "fragment").agg((F.sum("size") + F.max(inter_length)).alias("length"))
    return per.groupBy("cluster_id").agg(F.avg("length").alias("mean_length"), F.count("*").alias("n_fragments"))


