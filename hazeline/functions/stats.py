"""Student-t quantiles as a column expression."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

TABLE_SIZE = 200


def _beta_cf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny, c, d = 1e-300, 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def _inc_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_cf(a, b, x) / a
    return 1.0 - front * _beta_cf(b, a, 1 - x) / b


def t_cdf(t: float, dof: float) -> float:
    tail = 0.5 * _inc_beta(dof / 2, 0.5, dof / (dof + t * t))
    return 1.0 - tail if t > 0 else tail


def _normal_quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


@lru_cache(maxsize=None)
def t_quantile(p: float, dof: int) -> float:
    """Quantile by bisection on the distribution function (p > 0.5)."""
    lo, hi = 0.0, 1.0
    while t_cdf(hi, dof) < p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if t_cdf(mid, dof) < p else (lo, mid)
    return (lo + hi) / 2


@lru_cache(maxsize=None)
def t_table(p: float, size: int = TABLE_SIZE) -> tuple[float, ...]:
    """Quantiles for 1..size degrees of freedom."""
    return tuple(t_quantile(p, dof) for dof in range(1, size + 1))


def t_quantile_column(p: float, dof: Column) -> Column:
    """Table look-up up to TABLE_SIZE degrees of freedom, an expansion above; null below 1."""
    z = _normal_quantile(p)
    g1 = (z**3 + z) / 4
    g2 = (5 * z**5 + 16 * z**3 + 3 * z) / 96
    g3 = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    g4 = (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160
    w = 1.0 / dof.cast("double")
    expansion = F.lit(z) + w * (F.lit(g1) + w * (F.lit(g2) + w * (F.lit(g3) + w * F.lit(g4))))
    table = F.expr("array(" + ", ".join(f"{q!r}D" for q in t_table(p)) + ")")
    return F.when(
        dof.between(1, TABLE_SIZE), F.get(table, dof.cast("int") - 1)
    ).when(dof > TABLE_SIZE, expansion)


def ci_half_width(sd: Column, n: Column, level: float = 0.95) -> Column:
    """Half-width of the two-sided interval at the given one-sided level; null for n < 2."""
    return t_quantile_column(level, n - 1) * sd / F.sqrt(n.cast("double"))
