"""Wide to long and back, and completion of categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_many(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    categories: Sequence[str],
    values: Sequence[str],
    glue: str = "{name}_{value}",
) -> DataFrame:
    """Several value columns spread over declared categories, names glued by a template.

    Several rows for one cell: the smallest present value wins (never the first seen).
    """
    return df.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col(name) == c, F.col(v))).alias(glue.format(name=c, value=v))
            for v in values
            for c in categories
        ]
    )


def gather(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str],
    name: str = "type", value: str = "val",
) -> DataFrame:
    """Measures to rows; nulls kept."""
    cast = [F.col(m).cast("double").alias(m) for m in measures]
    return df.select(*keys, *cast).unpivot(list(keys), list(measures), name, value)


def complete(
    df: DataFrame, category: str, categories: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Add rows with null measures for declared categories that a key set lacks.

    The full grid is the distinct key sets times a short literal list, written as an
    explode; it never pairs rows with rows.
    """
    grid = (
        df.select(*keys).distinct()
        .withColumn(category, F.explode(F.lit(list(categories))))
    )
    return grid.join(df, [category, *keys], "left")
