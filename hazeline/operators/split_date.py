"""The date that best splits every city's record in half."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import SPLIT_FIRST, SPLIT_LAST, SPLIT_STEP_MONTHS
from hazeline.sources.stages import staged


def candidate_dates(
    first: str = SPLIT_FIRST, last: str = SPLIT_LAST, months: int = SPLIT_STEP_MONTHS
) -> list[Date]:
    """Dates from first to last in steps of whole months (first day of a month)."""
    start, end = Date.fromisoformat(first), Date.fromisoformat(last)
    result = []
    while start <= end:
        result.append(start)
        m = start.month - 1 + months
        start = start.replace(year=start.year + m // 12, month=m % 12 + 1)
    return result


def candidate_counts(df: DataFrame, city: str, date: str, candidates: Sequence[Date]) -> DataFrame:
    """City, total, dated, min, max and split_date, before, after: a row for each city and candidate.

    All candidates are counted in one map-side combined pass (one counter per candidate and city); no row is repeated
    per candidate.
    """
    d = F.to_date(F.col(date))
    counted = df.groupBy(city).agg(
        F.count(F.lit(1)).alias("total"), F.count(d).alias("dated"), F.min(d).alias("min"), F.max(d).alias("max"),
        *[F.count_if(d <= F.lit(c)).alias(f"b{i}") for i, c in enumerate(candidates)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("split_date"),
                F.col(f"b{i}").alias("before"),
                (F.col("dated") - F.col(f"b{i}")).alias("after"),
            )
            for i, c in enumerate(candidates)
        ]
    )
    return counted.select(city, "total", "dated", "min", "max", F.inline(entries))


def split_scores(
    df: DataFrame, city: str, date: str, candidates: Sequence[Date], missing_as_zero: bool = True
) -> DataFrame:
    """Mean share before and after each candidate over cities, and the distance from halves.

    With ``missing_as_zero`` false, a city without rows on one side is left out of that side's mean.
    """
    return scores_of_counts(candidate_counts(df, city, date, candidates), missing_as_zero)


def scores_of_counts(counts: DataFrame, missing_as_zero: bool = True) -> DataFrame:
    share = {s: F.col(s) / F.col("total") for s in ("before", "after")}
    if not missing_as_zero:
        share = {s: F.when(F.col(s) > 0, v) for s, v in share.items()}
    means = counts.groupBy("split_date").agg(
        F.avg(share["before"]).alias("mean_before"), F.avg(share["after"]).alias("mean_after")
    )
    # Rounded so that equal scores compare equal whatever the order of summation.
    return means.withColumn(
        "score",
        F.round(F.abs(0.5 - F.col("mean_before")) + F.abs(0.5 - F.col("mean_after")), 12),
    )


def best_split(scores: DataFrame) -> DataFrame:
    """The candidate with the smallest score, the earliest on ties."""
    return scores.orderBy("score", "split_date").limit(1)


def searched_split_table(df: DataFrame, city: str, date: str, candidates: Sequence[Date]) -> DataFrame:
    """``split_table`` at the best candidate, from the counters of the search itself: one pass over the rows."""
    counts = staged(candidate_counts(df, city, date, candidates), "split-counts")
    chosen = best_split(scores_of_counts(counts)).select("split_date")
    return with_shares(
        counts.join(chosen, "split_date").select(
            city, F.col("before").alias("before_samp"), F.col("after").alias("after_samp"), "min", "max",
            F.col("total").alias("total_samp"),
        )
    )


def split_table(df: DataFrame, city: str, date: str, cutoff) -> DataFrame:
    """Counts and rounded shares before (<=) and after one date, and the span, by city.

    ``cutoff`` is a date column: a literal, or a scalar subquery with the chosen date.
    """
    d = F.to_date(F.col(date))
    counts = df.groupBy(city).agg(
        F.count_if(d <= cutoff).alias("before_samp"),
        F.count_if(d > cutoff).alias("after_samp"),
        F.min(d).alias("min"),
        F.max(d).alias("max"),
        F.count(F.lit(1)).alias("total_samp"),
    )
    return with_shares(counts)


def with_shares(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "perc_before": F.round(F.col("before_samp") / F.col("total_samp"), 2),
            "perc_aft": F.round(F.col("after_samp") / F.col("total_samp"), 2),
        }
    ).fillna(0, subset=["before_samp", "after_samp", "total_samp", "perc_before", "perc_aft"])
