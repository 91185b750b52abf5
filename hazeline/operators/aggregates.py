"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.fixed_values import BOX_PROBS, NOTCH_FACTOR
from hazeline.functions.stats import ci_half_width
from hazeline.operators.joins import null_safe_join
from hazeline.operators.quantiles import exact_quantiles
from hazeline.sources.stages import staged


def numeric_columns(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in but
    ]


def mean_all_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of every numeric column by group; null where a group has no value."""
    return df.groupBy(*keys).agg(
        *[F.avg(c).alias(c) for c in numeric_columns(df, keys)]
    )


def mean_ci(df: DataFrame, keys: Sequence[str], value: str, level: float = 0.95) -> DataFrame:
    """Mean, count of present values, standard deviation and interval half-width."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(
            F.avg(value).alias("mean"),
            F.count(value).alias("n"),
            F.when(F.count(value) > 1, F.stddev_samp(value)).alias("sd"),
        )
        .withColumn("ci", ci_half_width(F.col("sd"), F.col("n"), level))
    )


def median_iqr(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], **options
) -> DataFrame:
    """Median and quartiles, long by compound: unpivot first, then one grouping."""
    long = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(
        list(keys), list(measures), "compound", "value"
    )
    return exact_quantiles(
        long, [*keys, "compound"], "value", (0.25, 0.5, 0.75),
        ("lower_iqr", "median", "upper_iqr"), **options,
    ).where(F.col("median").isNotNull())


def box_stats(df: DataFrame, keys: Sequence[str], value: str, **options) -> DataFrame:
    """Whisker ends, quartiles, median and notch limits by group."""
    q = exact_quantiles(
        df.where(F.col(value).isNotNull()), keys, value, BOX_PROBS,
        ("ymin", "lower", "middle", "upper", "ymax"), **options,
    )
    half = F.lit(NOTCH_FACTOR) * (F.col("upper") - F.col("lower")) / F.sqrt(F.col("n"))
    return q.withColumns(
        {
            "notch_lower": F.col("middle") - half,
            "notch_upper": F.col("middle") + half,
            "relvarwidth": F.sqrt(F.col("n")),
        }
    )


def box_outliers(df: DataFrame, keys: Sequence[str], value: str, **options) -> DataFrame:
    """Rows outside the whiskers, one row per outlier (never a collected list)."""
    bounds = staged(
        exact_quantiles(
            df.where(F.col(value).isNotNull()), keys, value, (BOX_PROBS[0], BOX_PROBS[-1]), ("ymin", "ymax"), **options,
        ).drop("n"),
        "box-bounds",
    )
    v = F.col(value)
    return null_safe_join(df, bounds, keys, "inner").where(
        (v < F.col("ymin")) | (v > F.col("ymax"))
    )


def global_bounds(
    df: DataFrame, value: str, probs: tuple[float, float] = (0.02, 0.98), **options
) -> DataFrame:
    """Quantiles over the whole table attached to every row, as one scalar subquery."""
    q = exact_quantiles(
        df.where(F.col(value).isNotNull()), [], value, probs, ("lo", "hi"), **options
    )
    bounds = q.select(F.struct("lo", "hi")).scalar()
    return df.withColumns({"min": bounds.getField("lo"), "max": bounds.getField("hi")})


def ratio_quantiles(
    df: DataFrame, keys: Sequence[str], numerator: str, denominator: str, **options
) -> DataFrame:
    """Median and quartiles of a ratio by group; a zero denominator gives no ratio."""
    ratio = df.select(
        *keys, F.try_divide(F.col(numerator), F.col(denominator)).alias("ratio_value")
    )
    return exact_quantiles(
        ratio, keys, "ratio_value", (0.25, 0.5, 0.75),
        ("lower_iqr", "ratio", "upper_iqr"), **options,
    ).where(F.col("ratio").isNotNull())


def coverage_span(df: DataFrame, keys: Sequence[str], start: str, end: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(start).alias("start"), F.max(end or start).alias("end")
    )


def composition_share(
    df: DataFrame, keys: Sequence[str], components: Sequence[str]
) -> DataFrame:
    """Means first, then their total, then each mean's share of it."""
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in components])
    total = F.col(components[0])
    for c in components[1:]:
        total = total + F.col(c)
    return means.withColumn("total", total).withColumns(
        {f"{c}_perc": F.try_divide(F.col(c), F.col("total")) for c in components}
    )
