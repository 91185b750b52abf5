"""Numbers: safe casts, null-skipping sums and means, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.fixed_values import EARTH_RADIUS_KM


def to_double(cell: Column) -> Column:
    """Number, or null for bad text. NaN becomes null too."""
    number = cell.try_cast("double")
    return F.when(~F.isnan(number), number)


def null_skipping_sum(*columns: Column) -> Column:
    """Sum of the present values; null only if all are missing."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0.0))
    return F.when(F.coalesce(*columns).isNotNull(), total)


def row_mean(*columns: Column) -> Column:
    """Mean over the present values of a row; null if there are none."""
    present = F.filter(F.array(*columns), lambda v: v.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, v: acc + v)
    return F.try_divide(total, F.size(present))


def null_count(*columns: Column) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + c.isNull().cast("int")
    return total


def haversine_km(lat: Column, lon: Column, centre_lat: float | Column, centre_lon: float | Column) -> Column:
    """Great-circle distance to a centre."""
    centre = [c if isinstance(c, Column) else F.lit(c) for c in (centre_lat, centre_lon)]
    dphi = F.radians(lat - centre[0]) / 2
    dlam = F.radians(lon - centre[1]) / 2
    a = F.pow(F.sin(dphi), 2) + F.cos(F.radians(centre[0])) * F.cos(F.radians(lat)) * F.pow(F.sin(dlam), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))
