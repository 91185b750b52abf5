"""Tables behind the figures: periods, seasons, blanks, top days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import COMPONENTS
from hazeline.functions.dates import half_year
from hazeline.functions.numeric import null_count
from hazeline.operators.aggregates import composition_share
from hazeline.operators.ranking import top_k
from hazeline.operators.reshape import gather


def with_period(df: DataFrame, cutoff: Column, date: str = "date") -> DataFrame:
    """before (<) or after (>=) as a column instead of two frames."""
    return df.withColumn(
        "period",
        F.when(F.col(date) < cutoff, "before").when(F.col(date) >= cutoff, "after"),
    )


def compare_periods(
    df: DataFrame, keys: Sequence[str], value: str, cutoff: Column, date: str = "date"
) -> DataFrame:
    """Mean before and after, difference and ratio, for keys present in both periods.

    One conditional aggregate over one scan; no self join.
    """
    early, late = F.col(date) < cutoff, F.col(date) >= cutoff
    v = F.col(value)
    means = df.groupBy(*keys).agg(
        F.avg(F.when(early, v)).alias("before"),
        F.avg(F.when(late, v)).alias("after"),
        F.count_if(early).alias("__b"),
        F.count_if(late).alias("__a"),
    )
    return means.where((F.col("__b") > 0) & (F.col("__a") > 0)).select(
        *keys, "before", "after",
        (F.col("before") - F.col("after")).alias("diff"),
        F.try_divide(F.col("after"), F.col("before")).alias("ratio"),
    )


def mean_difference(compared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Second stage: mean of the per-key differences."""
    return compared.groupBy(*keys).agg(F.avg("diff").alias("mean_diff"))


def compare_medians(medians: DataFrame, keys: Sequence[str], value: str = "median") -> DataFrame:
    """Medians before and after, difference and ratio, for keys that have both; ``medians`` has a row for each period."""
    wide = medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("period") == p, F.col(value))).alias(p) for p in ("before", "after")]
    )
    return wide.where(F.col("before").isNotNull() & F.col("after").isNotNull()).select(
        *keys, "before", "after", (F.col("before") - F.col("after")).alias("diff"),
        F.try_divide(F.col("after"), F.col("before")).alias("ratio"),
    )


def share_ratios(shares: DataFrame, measures: Sequence[str], keys: Sequence[str] = ("city",)) -> DataFrame:
    """Ratios of each share, long by measure: after to before in either half-year, and winter to summer in either period.

    ``shares`` has a row for each of the keys, period and season. A ratio without both of its sides, or over zero, is null.
    """
    cells = {(p, h): f"{p}_{h}" for p in ("before", "after") for h in ("summer", "winter")}
    entries = F.array(*[F.struct(F.lit(m).alias("type"), F.col(m).alias("share")) for m in measures])
    long = shares.select(*keys, "period", "season", F.inline(entries))
    wide = long.groupBy(*keys, "type").agg(
        *[
            F.max(F.when((F.col("period") == p) & (F.col("season") == h), F.col("share"))).alias(name)
            for (p, h), name in cells.items()
        ]
    )
    return wide.select(
        *keys, "type",
        F.try_divide("after_summer", "before_summer").alias("summer_change"),
        F.try_divide("after_winter", "before_winter").alias("winter_change"),
        F.try_divide("before_winter", "before_summer").alias("winter_to_summer_before"),
        F.try_divide("after_winter", "after_summer").alias("winter_to_summer_after"),
    )


def range_over(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Smallest and largest value by key."""
    return df.groupBy(*keys).agg(F.min(value).alias("lowest"), F.max(value).alias("highest"))


def season_means(
    df: DataFrame, measures: Sequence[str] = COMPONENTS, city: str = "city", month: str = "month"
) -> DataFrame:
    """Mean of each measure by city, period and half-year, long; empty cells dropped."""
    keys = [city, "period", "season"]
    means = (
        df.withColumn("season", half_year(F.col(month)))
        .where(F.col("season").isNotNull())
        .groupBy(*keys).agg(*[F.avg(m).alias(m) for m in measures])
    )
    return gather(means, keys, measures).where(F.col("val").isNotNull())


def season_shares(df: DataFrame, city: str = "city", month: str = "month") -> DataFrame:
    """Share of each component by city, period and half-year, with the combined shares."""
    keyed = df.withColumn("season", half_year(F.col(month)))
    shares = composition_share(keyed, [city, "period", "season"], COMPONENTS)
    return shares.withColumns(
        {
            "aso4_pbw": F.col("ASO4_perc") + F.col("PBW_perc"),
            "aso4_ano3": F.col("ASO4_perc") + F.col("ANO3_perc"),
        }
    )


def top_days_composition(
    df: DataFrame, ties: Sequence[str], mass: str = "spec_pm2_5", k: int = 10,
    city: str = "city", month: str = "month",
) -> DataFrame:
    """Mean components over the k days of highest mass by city, period and half-year, long.

    In the later period only days without any missing part count.
    """
    keys = [city, "period", "season"]
    complete = null_count(
        F.col(city), F.col(month), F.col(mass), F.col("total"), *[F.col(c) for c in COMPONENTS]
    ) == 0
    days = df.withColumn("season", half_year(F.col(month))).where(
        (F.col("period") == "before") | ((F.col("period") == "after") & complete)
    )
    best = top_k(days.where(F.col("season").isNotNull()), keys, mass, k, ties)
    means = best.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in COMPONENTS])
    return gather(means, keys, COMPONENTS).where(F.col("val").isNotNull())


def blank_comparison(
    df: DataFrame, front: Column, back: Column, blanks: Sequence[Column], keys: Sequence[str] = ("city",)
) -> DataFrame:
    """Mean carbon of front and back cartridge and of the summed blanks by key, long.

    Columns that differ between periods are conditions of one pass, with the period among the keys.
    """
    blank = blanks[0]
    for b in blanks[1:]:
        blank = blank + b
    names = ["mean_oc_cart_a", "mean_oc_cart_b", "passive_travel_field_blank"]
    means = df.groupBy(*keys).agg(
        *[F.avg(c).alias(n) for n, c in zip(names, (front, back, blank))]
    )
    return gather(means, keys, names).where(F.col("val").isNotNull())


def compare_long(long: DataFrame, keys: Sequence[str], value: str = "val") -> DataFrame:
    """Value after and before by key, difference (after less before) and ratio, for keys with both; ``long`` has a row for each period."""
    wide = long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("period") == p, F.col(value))).alias(p) for p in ("after", "before")]
    )
    return wide.where(F.col("before").isNotNull() & F.col("after").isNotNull()).withColumns({
        "diff": F.col("after") - F.col("before"), "ratio": F.try_divide("after", "before"),
    })
