"""AdaBoost over decision stumps: trained on labelled rows, applied anywhere."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Stump:
    feature: str
    threshold: float
    sign: int
    weight: float


def fit(x: np.ndarray, y: np.ndarray, names: list[str], rounds: int = 50) -> list[Stump]:
    """Discrete AdaBoost; y is 0 or 1. Ties go to the first feature and lowest threshold."""
    target = np.where(y > 0, 1.0, -1.0)
    w = np.full(len(y), 1 / max(len(y), 1))
    order = np.argsort(x, axis=0, kind="stable")
    out: list[Stump] = []
    for _ in range(rounds if len(set(y.tolist())) == 2 else 0):
        best = (0.5, 0, 0.0, 1)
        for f in range(x.shape[1]):
            v, s = x[order[:, f], f], (w * target)[order[:, f]]
            # error of "above the threshold is positive", for each gap between values
            error = w[target < 0].sum() + np.concatenate([[0], np.cumsum(s)])
            gap = np.concatenate([[True], v[1:] > v[:-1], [False]])
            for sign, e in ((1, error), (-1, 1 - error)):
                k = int(np.where(gap, e, 2).argmin())
                if e[k] < best[0] - 1e-12:
                    best = (float(e[k]), f, float(v[0] - 1 if k == 0 else (v[k - 1] + v[k]) / 2), sign)
        error, f, threshold, sign = best
        if error >= 0.5 - 1e-9:
            break
        weight = 0.5 * math.log((1 - error + 1e-9) / (error + 1e-9))
        out.append(Stump(names[f], threshold, sign, weight))
        said = np.where(x[:, f] > threshold, sign, -sign)
        w = w * np.exp(-weight * target * said)
        w /= w.sum()
        if error < 1e-9:
            break
    return out


def train(rows: DataFrame, features: list[str], label: Column, rounds: int = 50, max_rows: int | None = None) -> list[Stump]:
    """Fit on all labelled rows, nulls as 0; they come to the driver as one number per feature.

    More than ``max_rows``, if given, is an error, not a sample.
    """
    wanted = rows.select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features], label.cast("int").alias("__y"))
    found = (wanted if max_rows is None else wanted.limit(max_rows + 1)).toArrow()
    if max_rows is not None and found.num_rows > max_rows:
        raise ValueError("too many labelled rows for one machine")
    x = np.stack([found[f].to_numpy() for f in features], axis=1) if found.num_rows else np.zeros((0, len(features)))
    return fit(x, found["__y"].to_numpy() if found.num_rows else np.zeros(0, int), features, rounds)


def probability(model: list[Stump]) -> Column:
    """Probability of the positive class as one expression; 0.5 without a model."""
    score = F.lit(0.0)
    for s in model:
        score = score + F.when(F.coalesce(F.col(s.feature).cast("double"), F.lit(0.0)) > s.threshold, s.sign * s.weight).otherwise(-s.sign * s.weight)
    return 1 / (1 + F.exp(-2 * score))


def classify(rows: DataFrame, controls: DataFrame, features: list[str], label: Column, rounds: int = 50, max_rows: int | None = None) -> DataFrame:
    """rows with a probability; the column is there for empty input too."""
    return rows.withColumn("probability", probability(train(controls, features, label, rounds, max_rows)))
