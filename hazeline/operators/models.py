"""Least-squares models fitted by aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import RFormula
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def simple_regression(df: DataFrame, keys: Sequence[str], y: str, x: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.regr_count(F.col(y), F.col(x)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
    )


def polynomial_trend(
    df: DataFrame, keys: Sequence[str], y: str, x: Column, origin: float, scale: float,
    degree: int = 3,
) -> DataFrame:
    """Raw-polynomial least squares in t = (x - origin) / scale, coefficients c0..cd by group.

    One pass of power sums; the (d+1)-square normal equations are then eliminated in
    columns, one row per group. Choose origin and scale so that t lies within [-1, 1].
    """
    t = (x.cast("double") - F.lit(float(origin))) / F.lit(float(scale))
    rows = df.select(*keys, t.alias("t"), F.col(y).cast("double").alias("y")).where(
        F.col("t").isNotNull() & F.col("y").isNotNull()
    )
    size = degree + 1

    def power(k: int) -> Column:
        result = F.lit(1.0)
        for _ in range(k):
            result = result * F.col("t")
        return result

    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(power(k)).alias(f"s{k}") for k in range(2 * degree + 1)],
        *[F.sum(power(k) * F.col("y")).alias(f"r{k}") for k in range(size)],
    )
    # Augmented matrix m{i}_{j}; forward elimination, then back substitution.
    solved = sums.select(
        *keys, "n",
        *[F.col(f"s{i + j}").alias(f"m{i}_{j}") for i in range(size) for j in range(size)],
        *[F.col(f"r{i}").alias(f"m{i}_{size}") for i in range(size)],
    )
    for p in range(size):
        factors = {
            f"f{i}": F.try_divide(F.col(f"m{i}_{p}"), F.col(f"m{p}_{p}"))
            for i in range(p + 1, size)
        }
        solved = solved.withColumns(factors).withColumns(
            {
                f"m{i}_{j}": F.col(f"m{i}_{j}") - F.col(f"f{i}") * F.col(f"m{p}_{j}")
                for i in range(p + 1, size) for j in range(p, size + 1)
            }
        )
    for i in reversed(range(size)):
        rest = F.col(f"m{i}_{size}")
        for j in range(i + 1, size):
            rest = rest - F.col(f"m{i}_{j}") * F.col(f"c{j}")
        solved = solved.withColumn(f"c{i}", F.try_divide(rest, F.col(f"m{i}_{i}")))
    return solved.select(*keys, "n", *[f"c{i}" for i in range(size)])


def linear_model(df: DataFrame, formula: str) -> DataFrame:
    """Gaussian linear model with categorical terms (treatment contrasts, first level as base).

    Rows with a missing term are left out. One row per coefficient.
    """
    prepared = RFormula(
        formula=formula, stringIndexerOrderType="alphabetDesc", handleInvalid="skip"
    ).fit(df).transform(df)
    fit = GeneralizedLinearRegression(family="gaussian", link="identity").fit(prepared)
    terms = _term_names(prepared)
    errors = fit.summary.coefficientStandardErrors
    values = [*fit.coefficients, fit.intercept]
    rows = [
        (term, float(v), float(e))
        for term, v, e in zip([*terms, "(Intercept)"], values, errors)
    ]
    return df.sparkSession.createDataFrame(
        rows, "term string, estimate double, std_error double"
    )


def _term_names(prepared: DataFrame) -> list[str]:
    attributes = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    flat = [a for group in attributes.values() for a in group]
    return [a["name"] for a in sorted(flat, key=lambda a: a["idx"])]
