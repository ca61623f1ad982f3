"""Quality classifier: cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds split its score: P(grade > k) = sigmoid(score - threshold_k). The
expected grade and the tail probability P(grade > cut) come out per document.

Features are hashed word ids, word shapes and repetitions; the score is the
mean weight of each family over the words of the text. Training rows are a
bounded sample (``max_rows``) in the order of a hash of their ids; scoring
covers every whole text.

Defined results: a null or empty text scores with the thresholds alone and is
kept by :func:`select`; a document rated more than once counts with its highest
rating, null ratings don't count; without ratings of two grades everything has
the highest grade; equal texts score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.scratch import fresh
from weftline.llm.textbytes import U64, Words, batches, mix

BUCKETS = 1 << 16
FAMILIES = 3
#: Rated documents that training reads at most.
MAX_ROWS = 4000

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = ord("A"), ord("a"), ord("a"), ord("0")


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per family and word the bucket, and where each document's words begin."""
    words, shapes = Words(data, offsets), Words(_CLASS[data], offsets)
    ids = words.hashed()
    # the shape of the first two and the last three bytes
    head = shapes.hashed(words.start, np.minimum(words.start + 2, words.end))
    tail = shapes.hashed(np.maximum(words.end - 3, words.start), words.end)
    again = np.zeros(len(ids), bool)
    if len(ids) > 1:
        again[1:] = (ids[1:] == ids[:-1]) & (words.doc[1:] == words.doc[:-1])
    lengths = np.minimum(words.end - words.start, 24).astype(U64)
    families = [ids, mix(head ^ (tail * U64(3))), mix(again.astype(U64) * U64(64) + lengths)]
    return np.stack([(f >> U64(48)).astype(np.int32) for f in families]), words.first_word


@dataclass
class Model:
    """Weights per bucket and the ordered thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def scores(self, found: np.ndarray, first: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[found].sum(0))])
        return (sums[first[1:]] - sums[first[:-1]]) / np.maximum(np.diff(first), 1)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) per document and threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))


def fit(found: np.ndarray, first: np.ndarray, ratings: np.ndarray, epochs: int = 80, rate: float = 0.3, penalty: float = 1e-6) -> Model:
    """Maximum likelihood by Adam; grades weigh alike however often they occur."""
    grades, y = np.unique(ratings, return_inverse=True)
    k = len(grades)
    if k < 2:
        return Model(np.zeros(BUCKETS), np.full(max(k - 1, 0), -20.0), grades)
    n = np.maximum(np.diff(first), 1)
    doc = np.repeat(np.arange(len(y)), np.diff(first))
    weight = (1 / np.bincount(y))[y] / k
    # thresholds are t0, t0 + exp(g1), ...: their order can't break
    free = np.concatenate([[0.0], np.zeros(k - 2)])
    params = [np.zeros(BUCKETS), free]
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    flat = found.reshape(-1)
    for step in range(1, epochs + 1):
        thresholds = np.cumsum(np.concatenate([params[1][:1], np.exp(params[1][1:])]))
        model = Model(params[0], thresholds, grades)
        s = model.scores(found, first)
        above = np.concatenate([np.ones((len(y), 1)), model.tails(s), np.zeros((len(y), 1))], axis=1)
        rows = np.arange(len(y))
        upper, lower = above[rows, y], above[rows, y + 1]
        p = np.maximum(upper - lower, 1e-12)
        # d log p / d threshold, from either side
        d_up, d_low = upper * (1 - upper) / p, lower * (1 - lower) / p
        ds = weight * (d_up - d_low)
        dt = np.zeros(k + 1)
        np.add.at(dt, y, -weight * d_up)
        np.add.at(dt, y + 1, weight * d_low)
        dt = dt[1:k]
        d_free = np.concatenate([[dt.sum()], [dt[i:].sum() * np.exp(params[1][i]) for i in range(1, k - 1)]])
        per_word = (ds / n)[doc]
        gradient = [-np.bincount(flat, np.tile(per_word, len(found)), BUCKETS) + penalty * params[0], -d_free]
        for q, (m, g) in enumerate(zip(moment, gradient, strict=True)):
            m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.99 * m[1] + 0.01 * g * g
            params[q] = params[q] - rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-9)
    return Model(params[0], np.cumsum(np.concatenate([params[1][:1], np.exp(params[1][1:])])), grades)


def rated_sample(docs: DataFrame, ratings: DataFrame, rating: str, max_rows: int) -> DataFrame:
    """text and rating of at most max_rows rated ids, first by a hash of the id."""
    chosen = ratings.where(F.col("doc_id").isNotNull() & F.col(rating).isNotNull()).groupBy("doc_id").agg(F.max(rating).cast("long").alias("__rating"))
    chosen = chosen.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(max_rows).withColumnRenamed("doc_id", "__id")
    texts = docs.select(F.col("doc_id").alias("__doc"), F.col("text").alias("__text"))
    # at most max_rows short rows are broadcast
    return texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select(F.col("__text").alias("text"), F.col("__rating").alias("rating"), F.col("__doc").alias("doc_id"))


def train(docs: DataFrame, ratings: DataFrame, rating: str = "quality", max_rows: int = MAX_ROWS, **options) -> Model:
    """Fit on the buckets of the sample's texts, which executors compute."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in batches(stream, "text"):
            found, first = buckets(data, offsets)
            rows = [found[:, a:b].astype(np.uint16).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(rows, pa.binary())], names=["rating", "doc_id", "found"])

    sample = rated_sample(docs, ratings, rating, max_rows).mapInArrow(run, "rating long, doc_id long, found binary")
    rows = sorted(sample.collect(), key=lambda r: (r.doc_id, r.rating, bytes(r.found)))
    if not rows:
        return Model(np.zeros(BUCKETS), np.zeros(0), np.zeros(1, np.int64))
    parts = [np.frombuffer(r.found, np.uint16).reshape(FAMILIES, -1) for r in rows]
    first = np.concatenate([[0], np.cumsum([p.shape[1] for p in parts])])
    return fit(np.concatenate(parts, axis=1).astype(np.int32), first, np.array([r.rating for r in rows]), **options)


def score(docs: DataFrame, model: Model, expected: str = "expected_grade", tail: str = "p_good", cut: int | None = None) -> DataFrame:
    """docs with the expected grade and P(grade > cut), cut being the lowest grade if not given.

    Columns of docs with these names are replaced; give others to keep them.
    """
    spark = docs.sparkSession
    kept = docs.drop(expected, tail)
    held = spark.sparkContext.broadcast(model)  # BUCKETS numbers, whatever the input
    schema = T.StructType([*kept.schema.fields, T.StructField(expected, T.DoubleType()), T.StructField(tail, T.DoubleType())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        at = 0 if cut is None else int(np.searchsorted(own.grades, cut))
        for batch, data, offsets in batches(stream, "text"):
            tails = own.tails(own.scores(*buckets(data, offsets)))
            mean = own.grades[0] + (tails * np.diff(own.grades)).sum(1) if tails.shape[1] else np.full(batch.num_rows, float(own.grades[0]))
            above = tails[:, at] if tails.shape[1] else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mean, pa.float64()), pa.array(above, pa.float64())], names=[*batch.schema.names, expected, tail])

    return kept.mapInArrow(run, schema)


def select(docs: DataFrame, ratings: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of docs whose tail probability reaches ``least``; texts without words stay."""
    grade, tail = fresh("__grade", *docs.columns), fresh("__tail", *docs.columns)
    scored = score(docs, train(docs, ratings, **options), grade, tail)
    wordless = F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    return scored.where((F.col(tail) >= least) | wordless).drop(grade, tail)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", "expected_grade", "p_good", (F.col("p_good") >= 0.5).alias("kept"))
