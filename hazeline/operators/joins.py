"""Joins. Null-safe where the data model says that missing keys match."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.fixed_values import EARTH_RADIUS_KM
from hazeline.functions.numeric import haversine_km
from hazeline.operators.sizes import broadcast_if_small
from hazeline.sources.stages import staged


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "full"
) -> DataFrame:
    """Join on keys where null matches null; keys appear once, coalesced."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    )
    joined = left.join(renamed, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    key_out = [
        F.coalesce(F.col(k), F.col(f"__{k}")).alias(k) if how in ("full", "right") else F.col(k)
        for k in keys
    ]
    rest = [c for c in left.columns if c not in keys] + [
        c for c in right.columns if c not in keys
    ]
    return joined.select(*key_out, *rest)


def union_observations(*frames: DataFrame) -> DataFrame:
    """Union of observation sets in which equal rows (nulls equal) collapse to one."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), frames
    ).distinct()


#: Bits of the numbers behind an order column: enough for every value and one more for null.
_BITS = {
    T.BooleanType: 2, T.ByteType: 9, T.ShortType: 17, T.IntegerType: 33, T.LongType: 65, T.DateType: 33, T.TimestampType: 59,
    T.TimestampNTZType: 59,
}
#: What a decimal of 38 digits holds.
_PACKED_BITS = 126


def _whole(number: int) -> Column:
    return F.lit(Decimal(number)).cast("decimal(38,0)")


def _side_by_side(parts: Sequence[tuple[Column, int]]) -> Column:
    """Whole numbers from 0, each below 2 to its bits, as one number that sorts like them, in order."""
    below = sum(width for _, width in parts)
    if below > _PACKED_BITS:
        raise ValueError(f"more than {_PACKED_BITS} bits")
    result = _whole(0)
    for number, width in parts:
        below -= width
        result = result + number.cast("decimal(38,0)") * _whole(2**below)
    return result.cast("decimal(38,0)")


def packed_order(bits: Mapping[str, int]) -> Column:
    """One number for columns of whole numbers from 0 that need no more than the given bits."""
    return _side_by_side([(F.col(name), width) for name, width in bits.items()])


def _from_zero(name: str, data_type: T.DataType) -> Column:
    """The values of an order column as whole numbers from 0, null last."""
    c = F.col(name)
    if isinstance(data_type, T.DateType):
        c = F.unix_date(c)
    elif isinstance(data_type, T.TimestampNTZType):  # without a detour over the session's time zone
        seconds = F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
        c = seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    elif isinstance(data_type, T.TimestampType):
        c = F.unix_micros(c)
    width = _BITS[type(data_type)]
    least = 2**58 if width == 59 else 2 ** (width - 2)
    return F.coalesce((c.cast("decimal(20,0)") + _whole(least)).cast("decimal(38,0)"), _whole(2**width - 1))


def _rank(df: DataFrame, order: Sequence[str]) -> Column:
    """Never-null sort key of the order columns, missing ones last.

    One whole number where the columns are whole numbers, dates or times that fit into one, which keeps aggregates
    over it hash-based; anything else becomes a struct.
    """
    types = [df.schema[c].dataType for c in order]
    if len(order) == 1 and isinstance(types[0], (T.IntegerType, T.LongType)):
        return F.coalesce(F.col(order[0]).cast("long"), F.lit(2**63 - 1))
    if len(order) == 1 and isinstance(types[0], T.DecimalType) and types[0].scale == 0:
        return F.coalesce(F.col(order[0]).cast("decimal(38,0)"), _whole(10**38 - 1))
    if all(type(t) in _BITS for t in types) and sum(_BITS[type(t)] for t in types) <= _PACKED_BITS:
        return _side_by_side([(_from_zero(c, t), _BITS[type(t)]) for c, t in zip(order, types, strict=True)])
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])


def first_non_null(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: per measure the first present value in the given order.

    Rows with a missing key are left out. Combines before the shuffle.
    """
    rank = _rank(df, order)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.where(present)
        .groupBy(*keys)
        .agg(
            *[
                F.min_by(F.col(m), F.when(F.col(m).isNotNull(), rank)).alias(m)
                for m in measures
            ]
        )
    )


def merge_sources(
    sources: Sequence[DataFrame],
    keys: Sequence[str],
    measures: Sequence[str],
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Sources in order of priority, aligned by name, then first_non_null.

    Rows of one source with the same key are ordered by the tie breakers, or else by all
    measures, so that the winner never depends on row order. With one tie breaker every
    source is aggregated under its own name and the sources are coalesced afterwards, which
    keeps the aggregate hash-based for numeric columns.
    """
    tagged = [
        s.withColumn("source_priority", F.lit(i)) for i, s in enumerate(sources)
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    ties = list(tie_breakers) or list(measures)
    if len(ties) > 1:
        return first_non_null(union, keys, measures, ["source_priority", *ties])
    by_source = {
        f"{m}__{i}": F.when(F.col("source_priority") == i, F.col(m))
        for m in measures for i in range(len(sources))
    }
    apart = union.select(*keys, *ties, *[c.alias(n) for n, c in by_source.items()])
    firsts = first_non_null(apart, keys, list(by_source), ties)
    return firsts.select(
        *keys,
        *[F.coalesce(*[f"{m}__{i}" for i in range(len(sources))]).alias(m) for m in measures],
    )


def fold_full_outer(
    df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Sequence[str]
) -> DataFrame:
    """N tables side by side on common keys, from the long layout, without a join chain.

    A pivot over declared columns: the largest value of each cell, then one array per key, filled by place. The work of a row does not
    grow with the number of columns.
    """
    return df.groupBy(*keys).pivot(name, list(columns)).agg(F.max(value)).select(
        *keys, *[F.col(f"`{c}`") for c in columns]
    )


def anti_ranges(
    df: DataFrame, ranges: DataFrame, key: str, date: str = "date"
) -> DataFrame:
    """Drop rows whose key and date fall into an exclusion range ``(key, from_date, to_date)``, for any number of ranges.

    An open end is null. A row of an excluded key without a date is dropped too, because
    the condition on it cannot be decided. Ranges with an open end come down to one row for each key; the others are cut into years,
    so that rows meet only the ranges of their own key and year.
    """
    first, last = F.to_date("from_date"), F.to_date("to_date")
    open_ends = ranges.groupBy(F.col(key).alias("__key")).agg(
        F.max(F.when(first.isNull(), last)).alias("__until"), F.min(F.when(last.isNull(), first)).alias("__since"),
        F.max(first.isNull() & last.isNull()).alias("__always"),
    )
    d = F.to_date(F.col(date))
    gone = F.col("__always") | d.isNull() | F.coalesce(d <= F.col("__until"), F.lit(False)) | F.coalesce(d >= F.col("__since"), F.lit(False))
    open_kept = df.join(open_ends, F.col(key) == F.col("__key"), "left").where(F.col("__key").isNull() | ~gone).select(df.columns)
    years = ranges.where(first.isNotNull() & last.isNotNull() & (first <= last)).select(
        F.col(key).alias("__key"), first.alias("__from"), last.alias("__to"),
        F.explode(F.sequence(F.year(first), F.year(last))).alias("__year"),
    )
    hit = (F.col(key) == F.col("__key")) & (F.year(d) == F.col("__year")) & d.between(F.col("__from"), F.col("__to"))
    return open_kept.join(years, hit, "left_anti")


def within_radius(
    df: DataFrame, centre: tuple[float, float], km: float,
    lat: str = "latitude", lon: str = "longitude", out: str = "distance_km",
) -> DataFrame:
    """Rows nearer than ``km`` to the centre, with the distance.

    A latitude band on the plain column comes first: it reaches the scan as a pushed
    filter and spares the trigonometry for most rows.
    """
    band = km / 110.5
    near = df.where(F.col(lat).between(centre[0] - band, centre[0] + band))
    return near.withColumn(
        out, haversine_km(F.col(lat), F.col(lon), *centre)
    ).where(F.col(out) < km)


#: Rows that a block of a cell holds of either side, about, and pairs that a task meets.
BLOCK, TASK_PAIRS = 1000, 16_000_000


def _meet_in_blocks(left: DataFrame, right: DataFrame, cell: Sequence[str], near: Column) -> DataFrame:
    """The pairs of rows with the same cell for which ``near`` holds, cells of any size.

    A cell's rows are cut into blocks on both sides, and every block of one side meets every block of the other under a key of its own. A row
    is copied once for each block of the other side, so the copies are fewer than the pairs by the size of a block. The number of
    tasks follows from the number of pairs: the rows alone, few beside them, would be put together into one task.
    """
    # written: a row keeps its number, and so its block
    sides = {
        name: staged(df.withColumn("__n", F.monotonically_increasing_id()), "cell-rows") for name, df in (("__a", left), ("__b", right))
    }
    sizes = [df.groupBy(*cell).agg(F.count(F.lit(1)).alias(f"{name}_rows")) for name, df in sides.items()]
    cells = staged(sizes[0].join(sizes[1], list(cell)), "cell-sizes")
    pairs = cells.agg(F.sum(F.col("__a_rows").cast("double") * F.col("__b_rows"))).first()[0] or 0
    tasks = math.ceil(pairs / TASK_PAIRS)

    def spread(mine: str, other: str) -> DataFrame:
        blocks = {name: F.ceil(F.col(f"{name}_rows") / BLOCK) for name in (mine, other)}
        copies = (
            sides[mine].join(cells, list(cell)).withColumn(mine, F.pmod(F.xxhash64("__n"), blocks[mine]))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), blocks[other] - 1)))
            .drop("__n", "__a_rows", "__b_rows")
        )
        return copies.repartition(tasks, *cell, "__a", "__b") if tasks > 1 else copies

    # the blocks are far more rows than the tables Spark knows, so no broadcast
    met = spread("__a", "__b").join(spread("__b", "__a").hint("merge"), [*cell, "__a", "__b"]).where(near)
    return met.drop(*cell, "__a", "__b")


def near_centres(
    points: DataFrame, centres: DataFrame, km: float, lat: str = "latitude", lon: str = "longitude", out: str = "distance_km",
) -> DataFrame:
    """Every pair of a point and a centre nearer than ``km``, with the distance; both tables may be of any size.

    The globe is cut into rows of latitude as high as the radius, and each row into cells as wide as the radius reaches there. A point
    lies in one cell, a centre looks into its own and the neighbouring ones, and the two meet by an equality join, in blocks where a
    cell is full. Pairs whose straight distance is too long go before the distance on the globe is worked out.
    Centres' coordinates are named ``centre_latitude`` and ``centre_longitude``.
    """
    step = km / (math.pi * EARTH_RADIUS_KM / 180) * 1.0001
    half_chord = math.sin(min(km / (2 * EARTH_RADIUS_KM), math.pi / 2))

    def row_of(latitude: Column) -> Column:
        return F.floor(latitude / step).cast("long")

    def cells_in(row: Column) -> Column:
        """Number of cells of a row: the widest difference of longitude within the radius of any of its points fits into one."""
        edge = F.least(F.greatest(F.abs((row - 1) * step), F.abs((row + 2) * step)), F.lit(90.0))
        reach = F.lit(half_chord) / F.cos(F.radians(edge))
        width = F.when(reach < 1, F.degrees(F.asin(reach)) * 2.0002).otherwise(F.lit(360.0))
        return F.greatest(F.floor(F.lit(360.0) / width), F.lit(1)).cast("long")

    def cell_of(longitude: Column, count: Column) -> Column:
        turned = F.pmod(longitude + 180, F.lit(360.0))
        return F.least(F.floor(turned / 360 * count).cast("long"), count - 1)

    def in_space(side: str, latitude: str, longitude: str) -> dict[str, Column]:
        """The place on a globe of radius 1."""
        phi, theta = F.radians(latitude), F.radians(longitude)
        return {f"{side}x": F.cos(phi) * F.cos(theta), f"{side}y": F.cos(phi) * F.sin(theta), f"{side}z": F.sin(phi)}

    placed = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("__row", row_of(F.col(lat)))
    placed = placed.withColumn("__cell", cell_of(F.col(lon), cells_in(F.col("__row")))).withColumns(in_space("__p", lat, lon))
    mine = row_of(F.col("centre_latitude"))
    looking = (
        centres.where("centre_latitude IS NOT NULL AND centre_longitude IS NOT NULL")
        .withColumns(in_space("__c", "centre_latitude", "centre_longitude"))
        .withColumn("__row", F.explode(F.array(mine - 1, mine, mine + 1))).withColumn("__count", cells_in(F.col("__row")))
        .withColumn("__at", cell_of(F.col("centre_longitude"), F.col("__count")))
    )
    around = F.array_distinct(F.transform(F.array(*[F.col("__at") + i for i in (-1, 0, 1)]), lambda c: F.pmod(c, F.col("__count"))))
    looking = looking.withColumn("__cell", F.explode(around)).drop("__count", "__at")
    apart = [F.col(f"__p{axis}") - F.col(f"__c{axis}") for axis in "xyz"]
    # a little longer than the chord of the radius: the distance itself decides
    chord = 2 * half_chord * 1.000001 + 1e-12
    met = _meet_in_blocks(placed, looking, ["__row", "__cell"], reduce(lambda a, b: a + b, [d * d for d in apart]) <= chord * chord)
    distance = haversine_km(F.col(lat), F.col(lon), F.col("centre_latitude"), F.col("centre_longitude"))
    return met.withColumn(out, distance).where(F.col(out) < km).drop(*[f"__{side}{axis}" for side in "pc" for axis in "xyz"])


def compare_with_reference(
    counts: DataFrame, published: DataFrame, key: str, n: str, n_published: str
) -> DataFrame:
    """Inner join with a table of published values, and the difference."""
    return counts.join(broadcast_if_small(published), key, "inner").withColumn(
        "diff", F.col(n) - F.col(n_published)
    )


def literal_table(spark, columns: str, rows: Sequence[Sequence]) -> DataFrame:
    """Small constant table as a local relation (no Python worker behind it)."""

    def cell(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if isinstance(value, float):
            return f"{value!r}D"
        return str(value)

    body = ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)
    fields = [f.strip().split() for f in columns.split(",")]
    casts = ", ".join(f"cast({n} as {t}) as {n}" for n, t in fields)
    names = ", ".join(n for n, _ in fields)
    return spark.sql(f"select {casts} from values {body} as t({names})")
