"""Daily means of hourly data, wide by pollutant, joined with filter data and station info."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import (
    HOUR_COLUMNS, HOURLY_POLLUTANTS, STUDY_CENTRE, STUDY_RADIUS_KM,
)
from hazeline.functions.dates import fill_date_parts
from hazeline.functions.numeric import row_mean
from hazeline.functions.text import clean_name
from hazeline.operators.aggregates import coverage_span
from hazeline.operators.joins import within_radius
from hazeline.operators.quality import dedupe

INFO = ("station_name", "location_address", "city", "latitude", "longitude")


def daily_means(hourly: DataFrame, hours: Sequence[str] = HOUR_COLUMNS) -> DataFrame:
    """One row per pollutant, station and day; of repeated keys the first row in a total order."""
    keys = ["pollutant", "napsid", "date"]
    unique = dedupe(hourly.select(*keys, *hours), keys, [F.col(h).asc_nulls_last() for h in hours])
    return unique.select(*keys, row_mean(*[F.col(h) for h in hours]).alias("summary"))


def spread_pollutants(daily: DataFrame, pollutants: Sequence[str]) -> DataFrame:
    """hourly_mean_<pollutant> columns by station and day: one shuffle, declared columns."""
    return daily.groupBy("napsid", "date").agg(
        *[
            F.max(F.when(F.col("pollutant") == p, F.col("summary"))).alias(
                f"hourly_mean_{clean_name(p)}"
            )
            for p in pollutants
        ]
    )


def daily_station_table(
    daily_wide: DataFrame, filter_tables: Sequence[DataFrame], stations: DataFrame,
) -> DataFrame:
    """Outer join of hourly and filter tables on (napsid, date), with station info attached.

    Every input has one row per key, so the outer joins cannot multiply rows; ``napsid`` is
    kept throughout.
    """
    keys = ["napsid", "date"]
    joined = daily_wide
    for t in filter_tables:
        joined = joined.join(t, keys, "full")
    dated = fill_date_parts(joined)
    info = stations.select("napsid", *[c for c in INFO if c in stations.columns])
    return dated.join(info, "napsid", "left")


def radius_study(
    hourly: DataFrame, fine: DataFrame, coarse: DataFrame, stations: DataFrame,
    centre: tuple[float, float] = STUDY_CENTRE, km: float = STUDY_RADIUS_KM,
) -> dict[str, DataFrame]:
    """All tables of the study around one centre.

    ``fine`` and ``coarse`` are keyed by (napsid, date) and hold only mass columns besides.
    """
    near = within_radius(stations, centre, km, out="centre_dist")
    ids = near.select("napsid")
    hourly_near = hourly.join(ids, "napsid", "left_semi")
    wide = spread_pollutants(daily_means(hourly_near), HOURLY_POLLUTANTS)
    tables = [t.join(ids, "napsid", "left_semi") for t in (coarse, fine)]
    return {
        "stations": near,
        "coverage_by_pollutant": coverage_span(hourly_near, ["pollutant", "napsid"], "date"),
        "coverage": coverage_span(hourly_near, ["napsid"], "date"),
        "daily": daily_station_table(wide, tables, near),
    }
