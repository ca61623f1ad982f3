"""Normal distribution and the p-values of breakpoint predictions.

The distribution function is West's double-precision rational approximation
("Better approximations to cumulative normal functions", 2005). Formulas that
must be equal in both engines are SQL text, valid in Spark and DuckDB.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: West's coefficients, highest power first
_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
_LOW = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def _number(x: float) -> str:
    return f"cast('{x!r}' as double)"


def _horner(coefficients: tuple[float, ...], x: str) -> str:
    text = _number(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {_number(c)})"
    return text


def normal_cdf_sql(x: str) -> str:
    """SQL text of the standard normal distribution function of a double expression."""
    a = f"abs({x})"
    e = f"exp(-({a} * {a}) / {_number(2.0)})"
    near = f"{e} * {_horner(_TOP, a)} / {_horner(_LOW, a)}"
    tail = f"({a} + {_number(0.65)})"
    for k in (4.0, 3.0, 2.0, 1.0):
        tail = f"({a} + {_number(k)} / {tail})"
    far = f"{e} / {tail} / {_number(2.506628274631)}"
    lower = f"(CASE WHEN {a} > {_number(37.0)} THEN {_number(0.0)} WHEN {a} < {_number(7.07106781186547)} THEN {near} ELSE {far} END)"
    return f"(CASE WHEN {x} > {_number(0.0)} THEN {_number(1.0)} - {lower} ELSE {lower} END)"


def normal_cdf(column: str) -> Column:
    return F.expr(normal_cdf_sql(column))


def normal_pdf(x: Column, mean: float, sd: float) -> Column:
    return F.exp(-((x - mean) * (x - mean)) / (2 * sd * sd)) / (sd * math.sqrt(2 * math.pi))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def span_pvalue_sql(x: str, n: str, mean: float, sd: float, cov: float, read_max: int) -> str:
    """Two-sided p-value of a mean fragment length over n spanning fragments.

    Where the part of short fragments that cannot span is not negligible, the
    adjusted model is taken if the mean lies at most as many deviations from it.
    """
    mu, var = _number(mean), f"({_number(sd * sd)} / {n} + ({n} - 1) * {_number(cov)} / {n})"
    plain = _two_sided(x, mu, var)
    gap = mean - 2 * read_max
    if gap <= 0 or 1 - NormalDist().cdf(gap / sd) >= 0.05:
        return plain
    mean2, square2 = mean + sd * sd / gap, sd * sd - (sd * sd / gap) ** 2
    mu2, var2 = _number(mean2), f"({_number(square2)} / {n} + ({n} - 1) * {_number(cov)} / {n})"
    off = lambda m, v: f"(({x} - {m}) * ({x} - {m}) / {v})"
    return f"(CASE WHEN {x} >= {mu} AND {x} <= {mu2} THEN {_number(1.0)} WHEN {off(mu2, var2)} <= {off(mu, var)} THEN {_two_sided(x, mu2, var2)} ELSE {plain} END)"


def _two_sided(x: str, mean: str, var: str) -> str:
    z = f"(-abs({x} - {mean}) / sqrt({var}))"
    return f"({_number(2.0)} * {normal_cdf_sql(z)})"


def split_pvalue_sql(x: str, n: str, mean: float, cov: float, two_sided: bool) -> str:
    """p-value of an average split position over n reads: two-sided, or from below."""
    var = f"({_number(cov)} + {_number(1.0)} / ({_number(12.0)} * {n}))"
    if two_sided:
        return _two_sided(x, _number(mean), var)
    return normal_cdf_sql(f"(({x} - {_number(mean)}) / sqrt({var}))")
