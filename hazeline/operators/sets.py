"""Unions and set differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bind_rows(frames: dict[str, DataFrame], id_column: str) -> DataFrame:
    """Row bind by name, missing columns null, with the frame's name as a column."""
    tagged = [f.withColumn(id_column, F.lit(k)) for k, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def relabel_branch(df: DataFrame, condition, changes: dict) -> DataFrame:
    """Take a branch out, change columns in it, put it back: one pass, no union."""
    return df.withColumns(
        {c: F.when(condition, new).otherwise(F.col(c)) for c, new in changes.items()}
    )


def add_relabelled_copy(df: DataFrame, condition, changes: dict) -> DataFrame:
    """Rows of a branch repeated with changed columns, beside all original rows."""
    return df.unionByName(df.where(condition).withColumns(changes))
