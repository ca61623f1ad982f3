"""Dynamic-programming alignment of reads to references and to junctions.

The kernels work on batches of pairs of like size as whole arrays; they run in
Arrow batches. Scores follow the configuration: see the defaults.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scores:
    match: int = 2
    mismatch: int = -1
    gap: int = -2


LOCAL = Scores(10, -5, -5)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def score_matrix(read: str, reference: str, scores: Scores) -> np.ndarray:
    """(len(read) + 1) x (len(reference) + 1): the read globally, any reference start free.

    A row is the better of diagonal and vertical moves, and then a running
    maximum spreads the horizontal gaps.
    """
    a, b = _codes(read), _codes(reference)
    out = np.zeros((len(a) + 1, len(b) + 1), np.int64)
    out[:, 0] = np.arange(len(a) + 1) * scores.gap
    ramp = np.arange(len(b) + 1) * scores.gap
    for j in range(1, len(a) + 1):
        row = np.empty(len(b) + 1, np.int64)
        row[0] = out[j, 0]
        row[1:] = np.maximum(out[j - 1, :-1] + np.where(b == a[j - 1], scores.match, scores.mismatch), out[j - 1, 1:] + scores.gap)
        out[j] = np.maximum.accumulate(row - ramp) + ramp
    return out


def local_score(read: str, reference: str, scores: Scores = LOCAL) -> int:
    """The best cell of the matrix; 0 for empty input."""
    return int(score_matrix(read, reference, scores).max()) if read and reference else 0


def split_parts(read: str, ref1: str, ref2: str, scores: Scores = Scores(), least_side: int = 8, share: float = 0.9, most: int = 1 << 17) -> Iterator[np.ndarray]:
    """The rows of :func:`split_alignments` in their order, as tables of five columns.

    A table has more than ``most`` rows only if one place of ref1 has.
    """
    n = len(read)
    if not n or not ref1 or not ref2:
        return
    left, right = score_matrix(read, ref1, scores), score_matrix(read[::-1], ref2[::-1], scores)
    best_left, best_right = left.max(1), right.max(1)[::-1]
    usable = lambda v: np.where(v >= least_side, v, 0)
    total = usable(best_left) + usable(best_right)
    top = int(total.max())
    if top < int(share * scores.match * n):
        return
    cuts = [int(j) for j in np.flatnonzero((total == top) & (best_left >= least_side) & (best_right >= least_side))]
    if not cuts:
        return
    # places of ref1 that the same cuts allow meet the same places of ref2, each at its first cut
    allowed = np.stack([left[j] == best_left[j] for j in cuts])
    places = np.flatnonzero(allowed.any(0))
    kinds, kind = np.unique(allowed[:, places], axis=1, return_inverse=True)
    tails = []
    for held in kinds.T:
        ends = [np.flatnonzero(right[n - j] == best_right[j])[::-1] for j, h in zip(cuts, held, strict=True) if h]
        where, first = np.unique(len(ref2) - np.concatenate(ends) - 1, return_index=True)
        cut = np.repeat([j for j, h in zip(cuts, held, strict=True) if h], [len(v) for v in ends])[first]
        tails.append(np.stack([where, cut, n - cut, np.minimum(best_left[cut], best_right[cut])], axis=1))
    kind = kind.ravel()
    sizes = np.array([len(t) for t in tails])[kind]
    table = np.cumsum(sizes) // most
    for lo, hi in zip(*(lambda e: (e[:-1], e[1:]))(np.append(np.searchsorted(table, np.unique(table)), len(table))), strict=True):
        yield np.column_stack([np.repeat(places[lo:hi], sizes[lo:hi]), np.concatenate([tails[k] for k in kind[lo:hi]])])


def split_alignments(read: str, ref1: str, ref2: str, scores: Scores = Scores(), least_side: int = 8, share: float = 0.9) -> list[tuple[int, int, int, int, int]]:
    """ref_split1, ref_split2, read_split1, read_split2, score of all best splits.

    The read's prefix ends in ref1, its suffix starts in ref2. The stored score
    is that of the weaker side. Ties are all kept, one per pair of reference splits.
    """
    return [tuple(row) for part in split_parts(read, ref1, ref2, scores, least_side, share) for row in part.tolist()]


def local_scores(pairs: DataFrame, scores: Scores = LOCAL) -> DataFrame:
    """pairs (id, reference, sequence) with score and percent of the best possible."""

    def run(stream: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in stream:
            part["score"] = [local_score(s or "", r or "", scores) for r, s in zip(part["reference"], part["sequence"], strict=True)]
            part["percent"] = [v / (len(s) * scores.match) if s else 0.0 for v, s in zip(part["score"], part["sequence"], strict=True)]
            yield part[["id", "score", "percent"]]

    return pairs.select("id", "reference", "sequence").mapInPandas(run, "id long, score long, percent double")


def split_reads(rows: DataFrame, scores: Scores = Scores()) -> DataFrame:
    """rows (fusion_id, fragment, read_end, read, ref1, ref2) to all their best splits."""

    keys, names = ["fusion_id", "fragment", "read_end"], ["ref_split1", "ref_split2", "read_split1", "read_split2", "score"]
    most = 1 << 17  # rows of a batch, as a read may have very many

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, size = [], [], 0

        def given() -> pa.RecordBatch:
            ids = np.repeat(np.array(own, np.int64), [len(p) for p in parts], axis=0)
            found = np.concatenate(parts)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (*ids.T, *found.T)], names=[*keys, *names])

        for batch in stream:
            for row in batch.to_pylist():
                for part in split_parts(row["read"] or "", row["ref1"] or "", row["ref2"] or "", scores, most=most):
                    own.append([row[k] for k in keys])
                    parts.append(part)
                    size += len(part)
                    if size >= most:
                        yield given()
                        own, parts, size = [], [], 0
        if parts:
            yield given()

    # work grows with the ties, not with the bytes, so the rows are dealt out
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = rows.select(*[F.col(k).cast("long").alias(k) for k in keys], "read", "ref1", "ref2")
    return wanted.repartition(4 * tasks, *keys).mapInArrow(run, ", ".join(f"{c} long" for c in [*keys, *names]))


def best_splits(splits: DataFrame) -> DataFrame:
    """Per fusion the split with the highest summed score, smallest positions first among equals."""
    sums = splits.groupBy("fusion_id", "ref_split1", "ref_split2").agg(F.sum("score").alias("total"), F.count("*").alias("split_count"), F.avg("read_split1").alias("mean_left"), F.avg("read_split2").alias("mean_right"))
    order = Window.partitionBy("fusion_id").orderBy(F.desc("total"), "ref_split1", "ref_split2")
    return sums.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def junction_sequence(rem1: Column, seq1: Column, split1: Column, seq2: Column, split2: Column, rem2: Column) -> Column:
    """The predicted sequence with a bar at the junction."""
    return F.concat(rem1, F.substring(seq1, F.lit(1), split1), F.lit("|"), F.substring(seq2, split2 + 2, F.length(seq2)), rem2)


def render(read: str, left: int, ref1: str, ref2: str, split1: int, split2: int) -> str:
    """A split read under its junction, three lines of text."""
    a, b = ref1[max(split1 - left, 0) : split1], ref2[split2 + 1 : split2 + 1 + len(read) - left]
    head = read[:left].rjust(max(len(a), left))
    marks = "".join("*" if x == y else " " for x, y in zip(a.rjust(len(head)) + b.ljust(len(read) - left), head + read[left:], strict=False))
    return f"{a.rjust(len(head))}|{b}\n{marks[: len(head)]}|{marks[len(head) :]}\n{head}|{read[left:]}"


def kmer_counts(seqs: DataFrame, column: str, k: int) -> DataFrame:
    n = F.length(column) - k + 1
    every = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(F.col(column), i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return seqs.select(F.explode(every).alias("kmer")).groupBy("kmer").agg(F.count("*").alias("n"))


def kmer_path(counts: dict[str, int], start: str, goal: str, least: int = 1) -> str | None:
    """A sequence from start to goal over overlapping k-mers, commonest first; None if there is none.

    Every k-mer is visited once at most, so the search ends with the counts given.
    """
    stack, came = [start], {start: ""}
    while stack:
        node = stack.pop()
        if node == goal:
            letters = []
            while came[node]:
                letters.append(node[-1])
                node = came[node]
            return node + "".join(reversed(letters))
        nexts = [(counts.get(node[1:] + c, 0), c) for c in "ACGT"]
        for n, c in sorted(nexts):
            step = node[1:] + c
            if n >= least and step not in came:
                came[step] = node
                stack.append(step)
    return None
