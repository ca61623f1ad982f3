"""Embedding near-dedup over hierarchical navigable small-world graphs.

Vectors are dealt to shards by a hash of their id. Every shard builds a graph
once (Malkov and Yashunin, 2016): layers of fewer and fewer points, greedy
descent through the upper ones, a beam over the lowest; all searches of a block
step together as array operations. The graphs are a table in the shared folder.
Two shards meet in one task, where the vectors of each ask the other's graph.

The graph's links above the bound, verified, join the vectors of a shard into
clusters. Where a search meets a cluster, the cluster is compared whole: cosines
in double precision, block by block. So a group larger than the beam is found
whole, both sides of a pair count it, and what a task gives is a count per
vector and one link per pair of clusters, not all pairs.

Recall is audited in each shard: sampled queries are compared with all vectors
of the shard, and the beam widens until the audit passes; a shard that no beam
passes is searched by brute force. :func:`audits` reports beams and recalls.
Components are found by star contraction.

Defined results: a null or zero vector, or one with null or non-finite
components, links with nothing and is kept; vectors of different lengths link
with nothing of another length; equal vectors are searched for once and counted
as often as they occur; repeated ids are separate rows of one vertex; a row with
a null id links with nothing, has a null component and is kept; an empty table
gives no rows; columns other than the two read here don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.graph import components
from weftline.llm.scratch import materialise

COSINE = 0.9
#: Vectors of a shard on average; and shards at least, for parallel work.
SHARD_ROWS, LEAST_SHARDS = 20_000, 4
DEGREE, BEAM, BUILD_BEAM, MAX_BEAM = 12, 12, 32, 2048
AUDIT_QUERIES, AUDIT_RECALL = 1024, 0.99
#: Distances, as noise of this length on a unit vector, at which the audit asks.
AUDIT_NOISE = (0.1, 0.3, 0.45)
#: What single precision may take from a cosine.
SLACK = 1e-5
#: Queries that step together, and points of each that do.
_STEP, _WIDE = 1024, 4


class Graph:
    """A layered graph over unit vectors; searches run for many queries at once."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 7):
        self.x = vectors.astype(np.float32)
        n = len(vectors)
        self.degree = degree
        self.level = level = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(degree)).astype(int), 6)
        #: points by falling level, so that the top ones are there first
        self.order = np.argsort(-level, kind="stable")
        self.layers: list[np.ndarray] = []
        top = int(level.max()) if n else 0
        for at in range(top, -1, -1):
            members = self.order[level[self.order] >= at]
            width = degree * (2 if at == 0 else 1)
            links = np.full((n, width), -1, np.int32)
            done = 0
            while done < len(members):
                # a batch no larger than what is linked already
                block = members[done : done + max(64, min(done, _STEP))]
                if done:
                    near, _ = self._search(self.x[block], [*self.layers, links], beam, members[0])
                else:
                    near = np.full((len(block), 1), -1, np.int32)
                self._link(links, block, near, width)
                done += len(block)
            self.layers.append(links)
        self.entry = int(self.order[0]) if n else -1

    def _link(self, links: np.ndarray, block: np.ndarray, near: np.ndarray, width: int) -> None:
        """Join a batch to what was found and to each other, nearest and spread out."""
        inside = np.broadcast_to(block.astype(np.int32), (len(block), len(block)))
        sims = self.x[block] @ self.x[block].T
        np.fill_diagonal(sims, -2)
        k = min(width, len(block) - 1)
        own = np.take_along_axis(inside, np.argpartition(-sims, k - 1, axis=1)[:, :k], 1) if k > 0 else np.zeros((len(block), 0), np.int32)
        chosen = self._spread(block, np.concatenate([near, own], axis=1), width // 2 + 1)
        links[block, : chosen.shape[1]] = chosen
        # and back: points that get too many links choose again
        source = np.repeat(block, chosen.shape[1])
        target = chosen.reshape(-1)
        ok = target >= 0
        source, target = source[ok], target[ok]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        points, at, counts = np.unique(target, return_index=True, return_counts=True)
        most = 4 * width
        for lo in range(0, int(counts.max()) if len(counts) else 0, most):
            more = np.clip(counts - lo, 0, most)
            some = more > 0
            extra = np.full((int(some.sum()), most), -1, np.int32)
            row = np.repeat(np.arange(len(extra)), more[some])
            col = np.arange(len(row)) - np.repeat(np.cumsum(more[some]) - more[some], more[some])
            extra[row, col] = source[np.repeat(at[some] + lo, more[some]) + col]
            links[points[some]] = self._spread(points[some], np.concatenate([links[points[some]], extra], axis=1), width)

    def _spread(self, points: np.ndarray, found: np.ndarray, width: int) -> np.ndarray:
        """Of each point's candidates those that are nearer to it than to a chosen one, then the nearest."""
        found = np.sort(found, axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        found[found == points[:, None]] = -1
        sims = np.einsum("nd,nkd->nk", self.x[points], self.x[found])
        sims[found < 0] = -3
        rank = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * width]
        found, sims = np.take_along_axis(found, rank, 1), np.take_along_axis(sims, rank, 1)
        k = found.shape[1]
        own = self.x[found]
        nearer = np.concatenate([own[lo : lo + 128] @ own[lo : lo + 128].transpose(0, 2, 1) > sims[lo : lo + 128, :, None] for lo in range(0, len(own), 128)])
        taken = np.zeros(found.shape, bool)
        count = np.zeros(len(points), int)
        for j in range(k):
            clash = (taken[:, :j] & nearer[:, j, :j]).any(axis=1)
            pick = (found[:, j] >= 0) & ~clash & (count < width)
            taken[:, j] = pick
            count += pick
        # what is left fills up by nearness, which keeps dense groups joined
        first = np.argsort(np.where(taken, 0, np.where(found >= 0, 1, 2)), axis=1, kind="stable")[:, :width]
        return np.take_along_axis(found, first, 1)

    def _greedy(self, q: np.ndarray, links: np.ndarray, at: np.ndarray) -> np.ndarray:
        best = np.einsum("nd,nd->n", q, self.x[at])
        moving = np.arange(len(q))
        while len(moving):
            near = links[at[moving]]
            sims = np.einsum("nd,nkd->nk", q[moving], self.x[near])
            sims[near < 0] = -3
            j = sims.argmax(axis=1)
            top = sims[np.arange(len(j)), j]
            better = top > best[moving]
            moving, j, top, near = moving[better], j[better], top[better], near[better]
            at[moving], best[moving] = near[np.arange(len(j)), j], top
        return at

    def _search(self, q: np.ndarray, layers: list[np.ndarray], beam: int, entry: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of each query's beam, -1 where it isn't full."""
        at = np.full(len(q), entry)
        for links in layers[:-1]:
            at = self._greedy(q, links, at)
        links, n, size = layers[-1], len(q), len(self.x)
        ids = np.full((n, beam), -1, np.int32)
        sims = np.full((n, beam), -3.0, np.float32)
        open_ = np.zeros((n, beam), bool)
        seen = np.zeros(n * size, bool)
        ids[:, 0], sims[:, 0], open_[:, 0] = at, np.einsum("nd,nd->n", q, self.x[at]), True
        seen[np.arange(n) * size + at] = True
        active, most = np.arange(n), min(_WIDE, beam)
        while len(active):
            # the best open points of each query step together
            score = np.where(open_[active], sims[active], -4)
            j = np.argpartition(-score, most - 1, axis=1)[:, :most] if beam > most else np.broadcast_to(np.arange(beam), (len(active), beam))
            valid = np.take_along_axis(score, j, 1) > -4
            going = valid.any(axis=1)
            active, j, valid = active[going], j[going], valid[going]
            if not len(active):
                break
            row, col = np.nonzero(valid)
            q_at, slot = active[row], j[row, col]
            open_[q_at, slot] = False
            near = links[ids[q_at, slot]]
            k, c = np.nonzero(near >= 0)
            key = q_at[k] * size + near[k, c]
            key = np.sort(key[~seen[key]])
            key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
            seen[key] = True
            row, point = np.searchsorted(active, key // size), key % size
            s = np.einsum("nd,nd->n", q[active[row]], self.x[point])
            better = s > sims[active].min(axis=1)[row]
            row, point, s = row[better], point[better], s[better]
            if not len(row):
                continue
            n_new = np.bincount(row, minlength=len(active))
            place = np.arange(len(row)) - np.repeat(np.cumsum(n_new) - n_new, n_new)
            wide = int(n_new.max())
            all_s = np.concatenate([sims[active], np.full((len(active), wide), -3, np.float32)], axis=1)
            all_i = np.concatenate([ids[active], np.full((len(active), wide), -1, np.int32)], axis=1)
            all_o = np.concatenate([open_[active], np.zeros((len(active), wide), bool)], axis=1)
            all_s[row, beam + place], all_i[row, beam + place], all_o[row, beam + place] = s, point, True
            keep = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sims[active], ids[active], open_[active] = (np.take_along_axis(z, keep, 1) for z in (all_s, all_i, all_o))
        return ids, sims

    def stored(self) -> tuple[list[bytes], list[bytes]]:
        """Per point its links of the lowest layer, and of the layers above, from below."""
        upper = [b"".join(self.layers[-1 - at][p].tobytes() for at in range(1, top + 1)) for p, top in enumerate(self.level.tolist())]
        return [row.tobytes() for row in self.layers[-1]], upper

    @classmethod
    def restored(cls, vectors: np.ndarray, lowest: list[bytes], upper: list[bytes], degree: int = DEGREE) -> Graph:
        self, n = cls.__new__(cls), len(vectors)
        self.x, self.degree = vectors.astype(np.float32), degree
        self.level = np.array([len(u) // (4 * degree) for u in upper], int)
        self.layers = [np.frombuffer(b"".join(lowest), np.int32).reshape(n, 2 * degree)]
        for at in range(1, int(self.level.max()) + 1 if n else 0):
            links = np.full((n, degree), -1, np.int32)
            some = np.flatnonzero(self.level >= at)
            links[some] = np.frombuffer(b"".join(upper[p][4 * degree * (at - 1) : 4 * degree * at] for p in some), np.int32).reshape(-1, degree)
            self.layers.insert(0, links)
        self.entry = int(np.argsort(-self.level, kind="stable")[0]) if n else -1
        return self

    def near(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and point of pairs in the beams of at least that cosine, in single precision with slack."""
        out = [np.zeros((2, 0), np.int64)]
        for lo in range(0, len(q) if len(self.x) else 0, _STEP):
            ids, sims = self._search(q[lo : lo + _STEP].astype(np.float32), self.layers, beam, self.entry)
            row, col = np.nonzero(sims >= least - SLACK)
            out.append(np.stack([row + lo, ids[row, col]]))
        a, b = np.concatenate(out, axis=1)
        return a, b


def all_near(x: np.ndarray, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The same by brute force, in blocks."""
    out = [np.zeros((2, 0), np.int64)]
    for lo in range(0, len(q), 256):
        row, col = np.nonzero(q[lo : lo + 256].astype(np.float32) @ x.T >= least - SLACK)
        out.append(np.stack([row + lo, col]))
    a, b = np.concatenate(out, axis=1)
    return a, b


def clusters(graph: Graph, unit: np.ndarray, least: float) -> np.ndarray:
    """Per point the smallest point that it reaches by links of the lowest layer above the bound."""
    row, col = np.nonzero(graph.layers[-1] >= 0)
    a, b = row, graph.layers[-1][row, col].astype(np.int64)
    good = np.zeros(len(a), bool)
    for k in range(0, len(a), 1 << 16):
        s = slice(k, k + (1 << 16))
        good[s] = np.einsum("nd,nd->n", unit[a[s]], unit[b[s]]) >= least
    a, b = a[good], b[good]
    label = np.arange(len(unit))
    while len(a):
        high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        if (high == low).all():
            break
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def audited_beam(graph: Graph, label: np.ndarray, least: float, seed: int = 3, queries: int = AUDIT_QUERIES, recall: float = AUDIT_RECALL, beam: int = BEAM) -> tuple[int, float]:
    """A beam whose clusters, met by sampled queries, hold nearly all that brute force finds; and its recall.

    Queries lie beside vectors of the shard, as near copies in another shard do.
    Recall is the mean over queries that have pairs, so a large group of near
    copies does not stand for the small ones. A widest beam may still fall short.
    """
    n = len(graph.x)
    rng = np.random.default_rng(seed)
    q = graph.x[rng.integers(0, n, queries)]
    noise = rng.standard_normal(q.shape).astype(np.float32)
    noise *= np.resize(np.array(AUDIT_NOISE, np.float32), queries)[:, None] / np.linalg.norm(noise, axis=1, keepdims=True)
    q = (q + noise) / np.linalg.norm(q + noise, axis=1, keepdims=True)
    truth = q @ graph.x.T >= least + SLACK
    asked = truth.any(1)
    while True:
        a, b = graph.near(q, least, beam)
        met = np.zeros((queries, n), bool)
        met[a, label[b]] = True
        hit = (truth & met[:, label]).sum(1)
        got = float((hit[asked] / truth[asked].sum(1)).mean()) if asked.any() else 1.0
        if got >= recall or beam >= min(MAX_BEAM, n):
            return beam, got
        beam += beam // 2


def prepared(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their class, and one row per distinct usable vector: rep, n, unit."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lists = batch.column(1)
            flat, at = lists.values, np.asarray(lists.offsets)
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
            there = lists.is_valid().to_numpy(zero_copy_only=False)
            units, marks = [], []
            for i in range(batch.num_rows):
                v = values[at[i] : at[i + 1]] if there[i] else values[:0]
                top = np.abs(v).max() if len(v) else 0.0
                if not (np.isfinite(top) and top > 0):
                    units.append(None)
                    marks.append(None)
                    continue
                v = v / top
                v = v / np.sqrt((v * v).sum()) + 0.0  # one zero only
                units.append(v)
                marks.append(hashlib.sha256(v.tobytes()).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.list_(pa.float64())), pa.array(marks, pa.binary())], names=["vec_id", "unit", "mark"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, "vec_id long, unit array<double>, mark binary")
    rows = materialise(rows.withColumn("mark", F.when(F.col("vec_id").isNotNull(), F.col("mark"))), "hnsw-rows")
    reps = materialise(rows.where("mark IS NOT NULL").groupBy("mark").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("unit").alias("unit")), "hnsw-reps")
    return rows.drop("unit"), reps


_GRAPH = "shard int, width int, at int, rep long, n long, unit array<double>, lowest binary, upper binary, cluster int, beam int, recall double"
_FOUND = "a long, b long, n long"


def _units(table: pa.Table) -> np.ndarray:
    column = table.column("unit").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def shard_graphs(reps: DataFrame, least: float = COSINE, shards: int = LEAST_SHARDS) -> DataFrame:
    """A row per distinct vector: its shard, its links in the shard's graph, its cluster, and the shard's audit."""
    shard = F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int")
    rows = reps.select(shard.alias("shard"), F.size("unit").alias("width"), "rep", "n", "unit")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        unit = _units(table)
        graph, n = Graph(unit), len(unit)
        label = clusters(graph, unit, least)
        beam, recall = audited_beam(graph, label, least)
        lowest, upper = graph.stored()
        ints = lambda v: pa.array(np.resize(v, n), pa.int32())
        made = [ints(key[0].as_py()), ints(key[1].as_py()), ints(np.arange(n)), table.column("rep"), table.column("n"), table.column("unit"), pa.array(lowest, pa.binary()), pa.array(upper, pa.binary()), ints(label), ints(beam), pa.array(np.full(n, recall))]
        return pa.table(made, names=[c.split()[0] for c in _GRAPH.split(", ")])

    return rows.groupBy("shard", "width").applyInArrow(build, _GRAPH)


def audits(graphs: DataFrame) -> DataFrame:
    """Per shard and vector length: vectors, beam, recall of the audit, and whether it is searched by brute force instead."""
    return graphs.groupBy("shard", "width").agg(F.count("*").alias("vectors"), F.first("beam").alias("beam"), F.first("recall").alias("recall")).withColumn("exact", F.col("recall") < AUDIT_RECALL)


class Shard:
    """A shard's graph as its rows hold it."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("at")
        self.rep, self.n, self.unit = table.column("rep").to_numpy(), table.column("n").to_numpy(), _units(table)
        self.label = table.column("cluster").to_numpy().astype(np.int64)
        self.beam, self.recall = table.column("beam")[0].as_py(), table.column("recall")[0].as_py()
        self.graph = Graph.restored(self.unit, table.column("lowest").to_pylist(), table.column("upper").to_pylist())
        self.count = np.zeros(len(self.rep), np.int64)
        #: points by cluster, and where each cluster's begin
        self.members = np.argsort(self.label, kind="stable")
        self.begin = np.searchsorted(self.label[self.members], np.arange(len(self.rep) + 1))

    def met(self, other: Shard, least: float) -> np.ndarray:
        """Own clusters times the size of other plus the clusters of other that own vectors meet there."""
        if other.recall < AUDIT_RECALL:
            a, b = all_near(other.graph.x, self.unit, least)
        else:
            a, b = other.graph.near(self.unit, least, other.beam)
        return np.unique(self.label[a] * len(other.rep) + other.label[b])


def compared(left: Shard, right: Shard, same: bool, least: float) -> list[tuple[int, int]]:
    """Count the links between two shards, or in one, on both sides; one link of each pair of clusters that has any."""
    size = len(right.rep)
    codes = left.met(right, least)
    if same:
        c, d = codes // size, codes % size
        own = np.unique(left.label)
        codes = np.unique(np.concatenate([np.minimum(c, d) * size + np.maximum(c, d), own * size + own]))
    else:
        back = right.met(left, least)
        codes = np.union1d(codes, back % len(left.rep) * size + back // len(left.rep))
    c, d = codes // size, codes % size
    n_c, n_d = left.begin[c + 1] - left.begin[c], right.begin[d + 1] - right.begin[d]
    links: list[tuple[int, int]] = []
    # small products as rows of pairs, many at a time
    small = np.flatnonzero(n_c * n_d <= 1024)
    group = np.cumsum((n_c * n_d)[small]) // (1 << 15)
    for k in np.split(small, np.flatnonzero(np.diff(group)) + 1) if len(small) else []:
        pairs = (n_c * n_d)[k]
        of = np.repeat(np.arange(len(k)), pairs)
        turn = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        a, b = left.members[left.begin[c[k]][of] + turn // n_d[k][of]], right.members[right.begin[d[k]][of] + turn % n_d[k][of]]
        good = np.einsum("nd,nd->n", left.unit[a], right.unit[b]) >= least
        if same:
            good &= (a != b) & ((c[k] != d[k])[of] | (a < b))
        a, b, of = a[good], b[good], of[good]
        np.add.at(left.count, a, right.n[b])
        np.add.at(right.count, b, left.n[a])
        _, first = np.unique(of, return_index=True)
        links += zip(left.rep[a[first]].tolist(), right.rep[b[first]].tolist(), strict=True)
    for k in np.flatnonzero(n_c * n_d > 1024):
        a, b = left.members[left.begin[c[k]] : left.begin[c[k] + 1]], right.members[right.begin[d[k]] : right.begin[d[k] + 1]]
        link = None
        for lo in range(0, len(a), 256):
            part = a[lo : lo + 256]
            good = left.unit[part] @ right.unit[b].T >= least
            if same and c[k] == d[k]:
                good[part[:, None] >= b[None]] = False
            left.count[part] += good @ right.n[b]
            right.count[b] += left.n[part] @ good
            if link is None and good.any():
                i, j = np.argwhere(good)[0]
                link = (int(left.rep[part[i]]), int(right.rep[b[j]]))
        links += [link] if link else []
    if same:
        # a cluster hangs together by verified links
        far = np.flatnonzero(left.label != np.arange(len(left.rep)))
        links += zip(left.rep[far].tolist(), left.rep[left.label[far]].tolist(), strict=True)
    return links


def links(graphs: DataFrame, shards: int, least: float = COSINE) -> DataFrame:
    """Counts of links (a, null, n) and links that join clusters (a, b, null), by pairs of shards.

    Each pair of shards is one task: what a task holds is two shards.
    """
    pairs = F.sequence(F.lit(0), F.lit(shards - 1))
    rows = graphs.withColumn("other", F.explode(pairs)).withColumns({"i": F.least("shard", "other"), "j": F.greatest("shard", "other")})

    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        sides = [table.filter(pa.compute.equal(table.column("shard"), s)) for s in ((i,) if i == j else (i, j))]
        if not all(s.num_rows for s in sides):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        held = [Shard(s) for s in sides]
        del table, sides
        found = compared(held[0], held[-1], i == j, least)
        some = [(s.rep[s.count > 0], s.count[s.count > 0]) for s in held]
        a = np.concatenate([*(r for r, _ in some), np.array([x[0] for x in found], np.int64)])
        n = pa.array([*np.concatenate([c for _, c in some]).tolist(), *[None] * len(found)], pa.int64())
        b = pa.array([*[None] * (len(a) - len(found)), *(x[1] for x in found)], pa.int64())
        return pa.table({"a": pa.array(a), "b": b, "n": n})

    return rows.groupBy("i", "j", "width").applyInArrow(run, _FOUND)


def near_duplicates(vectors: DataFrame, least: float = COSINE, shard_rows: int = SHARD_ROWS, least_shards: int = LEAST_SHARDS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows, reps = prepared(vectors)
    shards = max(least_shards, -(-reps.count() // shard_rows))
    graphs = materialise(shard_graphs(reps, least, shards), "hnsw-graphs")
    found = materialise(links(graphs, shards, least), "hnsw-found")
    n_links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    parts = components(found.where("b IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("vertex", "rep")
    classes = reps.select("mark", "rep", "n").join(n_links, "rep", "left").join(parts, "rep", "left")
    classes = classes.select("mark", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    usable, alone = rows.where("mark IS NOT NULL"), rows.where("mark IS NULL").select("vec_id", F.lit(None).cast("binary").alias("mark"), F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id"))
    done = usable.join(classes, "mark").select("vec_id", "mark", "n_links", "component_id").unionByName(alone)
    return done.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op4_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(v, w) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.w FROM r JOIN l ON l.a = r.v),
c AS (SELECT v, min(w) AS component_id FROM r GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id JOIN c ON c.v = vec_id
"""
