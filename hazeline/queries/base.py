"""Registry of queries and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(column: Column | str, digits: int = 6) -> Column:
    """Rounded half away from zero, never negative zero.

    In binary arithmetic, like the SQL side: ``round`` goes through decimals, which costs more
    than most of the queries themselves and differs in the last digit on near ties. A double of
    2^52 and more after scaling has no fraction to round and stays as it is.
    """
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    scaled = c * F.lit(10.0**digits)
    # adding zero turns a negative one around
    whole = F.signum(scaled) * F.floor(F.abs(scaled) + 0.5) / F.lit(10.0**digits) + F.lit(0.0)
    return F.when(F.abs(scaled) < F.lit(2.0**52), whole).otherwise(c)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


def text_date(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.to_date(c).cast("string")
