"""Filters and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import BLANK_CODES
from hazeline.functions.numeric import null_count
from hazeline.functions.text import any_of
from hazeline.operators.ranking import keep_first


def is_blank_sample(columns: Sequence[str], candidates: Sequence[str]) -> Column:
    """True for test and field blanks, by the first discriminator column that exists."""
    for c in candidates:
        if c in columns:
            return any_of(F.col(c), BLANK_CODES)
    return F.lit(False)


def split_blanks(
    df: DataFrame,
    candidates: Sequence[str] = ("cart", "cartridge", "media", "sample_type", "sampling_type"),
) -> tuple[DataFrame, DataFrame]:
    """(samples, blanks). A missing discriminator counts as a sample."""
    blank = is_blank_sample(df.columns, candidates)
    return df.where(~blank), df.where(blank)


def split_fractions(
    df: DataFrame, discriminator: str, mass: str | None = None,
    mass_names: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Fine (F) and coarse (C) rows without the discriminator; mass renamed per branch.

    Rows without a fraction belong to neither.
    """
    result = {}
    for code in ("F", "C"):
        branch = df.where(F.col(discriminator) == code).drop(discriminator)
        if mass and mass_names:
            branch = branch.withColumnRenamed(mass, mass_names[code])
        result[code] = branch
    return result


def drop_null_rows(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(measures))


def drop_sparse_rows(df: DataFrame, max_missing: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at most ``max_missing`` missing cells."""
    cols = list(columns or df.columns)
    return df.dropna(thresh=max(len(cols) - max_missing, 0), subset=cols)


def with_null_count(df: DataFrame, columns: Sequence[str], out: str = "na_count") -> DataFrame:
    return df.withColumn(out, null_count(*[F.col(c) for c in columns]))


def drop_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns without any present value: one aggregate over all columns."""
    counts = df.agg(
        *[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(df.columns)]
    ).first()
    return df.select(
        *[f"`{c}`" for i, c in enumerate(df.columns) if counts[i] or c in keep]
    )


def split_invalid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows); an undecided condition is not valid."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_first(df, keys, order)


def source_report(
    df: DataFrame, stations: DataFrame, source: str = "source", declared_year: str = "declared_year",
    date: str = "date", station: str = "station", allow_invalid_dates: bool = False,
) -> DataFrame:
    """Per source file: rows, rows of another year, invalid dates, unknown stations, verdict.

    Rows of another year are dropped but do not condemn the file; invalid dates and unknown
    stations do. ``stations`` has one column with the station's name.
    """
    known = stations.select(F.col(station).alias("__known")).distinct()
    tagged = df.join(known, F.col(station) == F.col("__known"), "left")
    other_year = F.year(date) != F.col(declared_year)
    counts = tagged.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.coalesce(other_year, F.lit(False))).alias("n_other_year"),
        F.count_if(F.col(date).isNull()).alias("n_invalid_dates"),
        F.count_if(F.col("__known").isNull()).alias("n_unknown_stations"),
    )
    dates_ok = F.lit(allow_invalid_dates) | (F.col("n_invalid_dates") == 0)
    return counts.withColumn("accepted", dates_ok & (F.col("n_unknown_stations") == 0))


def accept_sources(
    df: DataFrame, report: DataFrame, source: str = "source",
    declared_year: str = "declared_year", date: str = "date",
) -> DataFrame:
    """Rows of the right year from accepted files."""
    rejected = report.where(~F.col("accepted")).select(source)
    return df.where(F.year(date) == F.col(declared_year)).join(rejected, source, "left_anti")


def complete_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, quarantined rows)."""
    full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(full), df.where(~full)
