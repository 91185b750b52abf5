"""Top rows, extremes and outlier labels by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazeline.operators.joins import null_safe_join
from hazeline.sources.stages import staged


def top_k(
    df: DataFrame, keys: Sequence[str], by: str, k: int, ties: Sequence[str]
) -> DataFrame:
    """The k largest rows per group, nulls last, ties broken by the given columns.

    The rank filter becomes a group limit before the shuffle, so no task ever
    receives more than k rows per group from any other task.
    """
    w = W.partitionBy(*keys).orderBy(F.col(by).desc_nulls_last(), *ties)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in a total order. Limited before the shuffle like top_k."""
    w = W.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")
    )


def group_extreme(
    df: DataFrame, keys: Sequence[str], value: str, largest: bool = True
) -> DataFrame:
    """Rows that attain the group's largest (or smallest) present value; ties kept.

    The extreme is combined before the shuffle, written, and joined back: Spark then knows its true size, and can split
    a hot group where it does not broadcast.
    """
    best = staged(df.groupBy(*keys).agg((F.max if largest else F.min)(value).alias("extreme")), "group-extremes")
    return null_safe_join(df, best, keys, "inner").where(
        F.col(value) == F.col("extreme")
    )


def sigma_outliers(
    df: DataFrame, keys: Sequence[str], value: str, sigmas: float = 3.0
) -> DataFrame:
    """Label rows farther than some standard deviations from the group mean.

    Aggregate, write and join back instead of a window: a hot group is never held by one task.
    """
    stats = staged(
        df.groupBy(*keys).agg(
            F.avg(value).alias("group_mean"),
            F.when(F.count(value) > 1, F.stddev_samp(value)).alias("group_sd"),
        ),
        "group-stats",
    )
    distance = F.abs(F.col(value) - F.col("group_mean"))
    return (
        null_safe_join(df, stats, keys, "inner")
        .withColumn(
            "label",
            F.when(distance > sigmas * F.col("group_sd"), "Outlier").when(
                distance <= sigmas * F.col("group_sd"), "Normal"
            ),
        )
        .drop("group_mean", "group_sd")
    )
