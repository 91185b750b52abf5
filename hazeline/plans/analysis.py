"""The main study: from merged tables to the tables behind every figure."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import (
    ANALYSIS_COLUMNS, BAD_OBSERVATIONS, CITY_ORDER, COMPONENTS,
    PUBLISHED_COUNTS, STATION_EXCLUSIONS, STUDY_STATIONS, WEATHER_COLUMNS,
)
from hazeline.functions.dates import fill_date_parts, month_label
from hazeline.operators import aggregates as A
from hazeline.operators import split_date as S
from hazeline.operators.columns import add_missing, with_prefix
from hazeline.operators.joins import anti_ranges, compare_with_reference, literal_table
from hazeline.operators.models import polynomial_trend, simple_regression
from hazeline.operators.naming import LIMIT_RULES_SHORT, match_limits
from hazeline.operators.quality import drop_null_rows, with_null_count
from hazeline.operators.ranking import group_extreme, sigma_outliers
from hazeline.operators.sets import add_relabelled_copy, relabel_branch
from hazeline.plans import compose, summaries

FIRST_DATA_COLUMN = ("season", "city", "date", "month")
MAX_MISSING = 3


def study_stations(metadata: DataFrame, chosen: Sequence[tuple] = STUDY_STATIONS) -> DataFrame:
    """(station, city) of the chosen stations and of the stations combined with them.

    ``metadata`` is the station table; its combined_stations column names one other station,
    which takes the city of the station that refers to it.
    """
    listed = literal_table(metadata.sparkSession, "station string, city string", chosen)
    own = metadata.select("station", "combined_stations").join(F.broadcast(listed), "station")
    other = own.where(F.col("combined_stations").isNotNull()).select(
        F.concat(F.lit("S"), F.col("combined_stations")).alias("station"), "city"
    )
    known = other.join(metadata.select("station"), "station", "left_semi")
    return own.select("station", "city").unionByName(known)


def published_comparison(
    observations: DataFrame, last_year: int = 2008, published: Sequence[tuple] = PUBLISHED_COUNTS
) -> DataFrame:
    """Observations per city and station up to a year, beside the published counts."""
    counts = observations.where(F.year("date") <= last_year).groupBy("city", "station").agg(
        F.count(F.lit(1)).alias("n")
    )
    table = literal_table(
        observations.sparkSession, "station string, n_published bigint", published
    )
    return compare_with_reference(counts, table, "station", "n", "n_published")


def box_rows_after(after: DataFrame, city: str = "Edmonton", limit: float = 50.0) -> DataFrame:
    """Later-period masses for the box plot: one city under its own label, and its values below
    the limit once more among the other cities."""
    rows = after.where(F.col("spec_pm2_5") >= 0).select(
        "city", "spec_pm2_5", F.lit("no").alias("apart")
    )
    chosen = F.col("city") == city
    labelled = relabel_branch(rows, chosen, {"apart": F.lit("yes")})
    return add_relabelled_copy(
        labelled, chosen & (F.col("spec_pm2_5") < limit), {"apart": F.lit("no")}
    )


def prepare(
    fine: DataFrame, blanks: DataFrame, stations: DataFrame,
    exclusions: Sequence[tuple] = STATION_EXCLUSIONS, cities: Sequence[str] = CITY_ORDER,
) -> DataFrame:
    """Observations with blanks beside them, station metadata attached, overlaps left out.

    ``fine`` and ``blanks`` have one row per (station, date); ``stations``: (station, city).
    """
    keys = ["station", "date"]
    blank_cols = [c for c in blanks.columns if c not in (*keys, "year", "month", "day")]
    fb = with_prefix(blanks.select(*keys, *blank_cols), "fb_", keys)
    joined = fine.join(fb, keys, "full").join(stations.select("station", "city"), "station")
    ranges = literal_table(
        fine.sparkSession, "station string, from_date date, to_date date", exclusions
    )
    kept = anti_ranges(joined.where(F.col("city").isin(*cities)), ranges, "station")
    return fill_date_parts(kept)


def substitute(df: DataFrame, columns: Sequence[str] = ANALYSIS_COLUMNS) -> DataFrame:
    """Half the limit where a value is below its limit column, matched by name."""
    present = [c for c in columns if c in df.columns]
    limits = match_limits(
        present, [c for c in df.columns if "mdl" in c], LIMIT_RULES_SHORT, overrides={}
    )
    return compose.substitute_limits(df, limits)


#: Orders of samplers in the study of the earlier years: "" stands for columns without a sampler in their name.
EARLIER_SAMPLERS = {
    "ion_samplers": ("spec", ""), "salt_samplers": ("", "spec", "dich"), "soil_samplers": ("", "dich", "spec"),
    "organic_carbon": "ocec_spec_oc_b",
}


def reconstruction(
    observations: DataFrame, om_factor: DataFrame, bad: Sequence[tuple] = BAD_OBSERVATIONS, **samplers
) -> DataFrame:
    """Reconstructed components per city, station and date, with the row's null count.

    Empty rows and known bad observations are left out. ``samplers`` are orders of samplers as ``compose.reconstruct_mass`` takes
    them, such as EARLIER_SAMPLERS. Persist it: every table below starts here.
    """
    needed = compose.columns_of(**samplers) if samplers else []
    whole = add_missing(observations, ["spec_pm2_5", *ANALYSIS_COLUMNS, *needed])
    gases = compose.coalesce_gases(whole)
    full = compose.reconstruct_mass(gases, om_factor, **samplers)
    kept = full.select(
        "season", "city", "date", "month", "spec_pm2_5", "station",
        "ammonia_ic_spec_ammonia", "myso2", "myhno3", *COMPONENTS, "PBW_h", "PBW_molar", "total",
    )
    measured = [c for c in kept.columns if c not in FIRST_DATA_COLUMN and c != "station"]
    counted = with_null_count(drop_null_rows(kept, measured), kept.columns)
    listed = literal_table(
        observations.sparkSession, "city string, date date", [(c, d) for c, d in bad]
    )
    return counted.join(F.broadcast(listed), ["city", "date"], "left_anti")


def enough_data(spec: DataFrame) -> DataFrame:
    return spec.where(F.col("na_count") < MAX_MISSING)


def cutoff(spec: DataFrame) -> Column:
    """The splitting date as a scalar subquery."""
    scores = S.split_scores(enough_data(spec), "city", "date", S.candidate_dates())
    return S.best_split(scores).select("split_date").scalar()


def study_tables(
    spec: DataFrame, observations: DataFrame, split: Column, **quantile_options
) -> dict[str, DataFrame]:
    """The result tables of the study for one splitting date.

    Quantiles and statistics that are joined back to rows are computed and written as their table is made; the rest is lazy.
    """
    dated = summaries.with_period(spec, split)
    full = enough_data(dated)
    labelled = dated.withColumn("month_text", month_label(F.col("date")))
    month = ["city", "period", "month", "month_text"]
    weather = observations.select("city", "date", *WEATHER_COLUMNS)
    after = full.where(F.col("period") == "after")
    january = dated.where(
        (F.col("period") == "after") & (F.col("month") == 1) & F.col("spec_pm2_5").isNotNull()
    ).withColumn("day", F.dayofmonth("date"))
    measured = full.where(F.col("spec_pm2_5").isNotNull())
    iqr = {
        name: A.median_iqr(labelled, month, list(measures), **quantile_options)
        for name, measures in {
            "ammonium": ("ASO4", "ANO3"), "carbon": ("EC", "OM"), "soil_salt": ("SOIL", "NaCl"),
            "ammonia": ("ammonia_ic_spec_ammonia",), "gases": ("myso2", "myhno3"),
        }.items()
    }
    monthly = summaries.compare_periods(labelled, ["city", "month_text"], "spec_pm2_5", split)
    oc = observations.select(
        "city", "date", "ocec_spec_oc_a", "ocec_spec_oc_b", "ocec_spec_oc_r_a",
        "ocec_spec_oc_r_b", "fb_ocec_spec_poc_b", "fb_ocec_spec_oc_r", "fb_ocec_spec_oc_b",
    )
    sulphur = summaries.compare_medians(iqr["gases"].where("compound = 'myso2'"), ["city", "month_text"])
    shares = summaries.season_shares(full)
    ratio = A.ratio_quantiles(
        labelled.where(F.col("period") == "after"), ["city", "month_text"], "OM", "EC", **quantile_options,
    )
    carbon = summaries.with_period(oc, split).where(F.col("period").isNotNull())
    early = F.col("period") == "before"

    def by_period(before: str, later: str) -> Column:
        return F.when(early, F.col(before)).otherwise(F.col(later))

    blanks = summaries.blank_comparison(
        carbon, by_period("ocec_spec_oc_r_a", "ocec_spec_oc_a"), by_period("ocec_spec_oc_r_b", "ocec_spec_oc_b"),
        [by_period("fb_ocec_spec_poc_b", "fb_ocec_spec_oc_b"), by_period("fb_ocec_spec_oc_r", "fb_ocec_spec_poc_b")],
        ["city", "period"],
    )
    blank_change = summaries.compare_long(blanks, ["city", "type"])
    return {
        "split_table": S.split_table(enough_data(spec), "city", "date", split),
        "mass_closure": compose.mass_closure(spec).agg(F.avg("diff").alias("mean_diff")),
        "box_stats": A.box_stats(measured, ["period", "city"], "spec_pm2_5", **quantile_options),
        "box_outliers": A.box_outliers(
            measured, ["period", "city"], "spec_pm2_5", **quantile_options
        ),
        "box_stats_after": A.box_stats(
            box_rows_after(after), ["apart", "city"], "spec_pm2_5", **quantile_options
        ),
        "monthly_mean_ci": A.mean_ci(labelled, month, "spec_pm2_5"),
        "january_mean_ci": A.mean_ci(january, ["city", "day"], "spec_pm2_5"),
        "january_outliers": sigma_outliers(january, ["city"], "spec_pm2_5"),
        "monthly_change": monthly,
        "city_change": summaries.mean_difference(monthly, ["city"]),
        "blank_before": blanks.where(early).drop("period"), "blank_after": blanks.where(~early).drop("period"),
        "blank_change": blank_change, "blank_city_change": summaries.mean_difference(blank_change, ["city"]),
        "water_regression": simple_regression(after, [], "PBW_molar", "PBW_h"),
        "season_means": summaries.season_means(full),
        "season_shares": shares,
        "share_ratios": summaries.share_ratios(
            shares, [*[f"{c}_perc" for c in COMPONENTS], "aso4_pbw", "aso4_ano3"]
        ),
        "sulphur_change": sulphur,
        "sulphur_city_change": summaries.mean_difference(sulphur, ["city"]),
        "top_days": summaries.top_days_composition(full, ["date", "station"]),
        **{f"median_{name}": t for name, t in iqr.items()},
        "nitrate_peaks": group_extreme(
            iqr["ammonium"].where("compound = 'ANO3'"), ["city", "period"], "median"
        ),
        **{
            f"{side}_{name}": group_extreme(t, ["city", "period", "compound"], "median", largest=side == "peaks")
            for name, t in iqr.items() for side in ("peaks", "lows")
        },
        "period_medians": reduce(DataFrame.unionByName, iqr.values()).groupBy("period", "compound", "city").agg(
            F.avg("median").alias("mean_median")
        ),
        "om_ec_ratio": ratio,
        "om_ec_ratio_range": summaries.range_over(ratio, ["city"], "ratio"),
        "with_weather": after.join(weather, ["city", "date"]),
        "soil_trend": polynomial_trend(
            after, ["city"], "SOIL", F.unix_date("date"), 14_610.0, 3_650.0
        ),
    }
