"""Column names, dictionaries and value/limit pairs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.fixed_values import TEXT_COLUMN_FRAGMENTS
from hazeline.functions.numeric import to_double
from hazeline.functions.text import clean_names
from hazeline.operators.sizes import broadcast_if_small


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def with_prefix(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Prefix on all but the key columns."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keys})


def select_matching(df: DataFrame, pattern: str, invert: bool = False) -> DataFrame:
    """Columns whose name matches a regex (or does not)."""
    return df.select(
        *[c for c in df.columns if bool(re.search(pattern, c, re.IGNORECASE)) != invert]
    )


def numeric_by_name(df: DataFrame, fragments: Sequence[str] = TEXT_COLUMN_FRAGMENTS) -> DataFrame:
    """Every text column whose name holds none of the fragments becomes a number."""
    text = re.compile("|".join(map(re.escape, fragments)), re.IGNORECASE)
    return df.select(
        *[
            to_double(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and not text.search(f.name)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def fallback_columns(df: DataFrame, fixes: dict[str, str], where: Column | None = None) -> DataFrame:
    """Fill columns from misnamed ones (target -> source), optionally for some rows only."""
    changes = {}
    for target, source in fixes.items():
        value = F.col(source) if where is None else F.when(where, F.col(source))
        changes[target] = F.coalesce(F.col(target), value) if target in df.columns else value
    return df.withColumns(changes)


def rename_long(
    df: DataFrame, dictionary: DataFrame, name: str = "col_name", keys: Sequence[str] = (),
    keep_unmapped: bool = True,
) -> DataFrame:
    """Rename through a dictionary ``(keys..., old_name, new_name)``; always lower case.

    Unmapped names keep their own name, or are dropped if ``keep_unmapped`` is false. The
    dictionary must hold one row per old name; it is broadcast while small.
    """
    d = broadcast_if_small(dictionary.select(*keys, F.col("old_name").alias(name), "new_name"))
    joined = df.join(d, [*keys, name], "left" if keep_unmapped else "inner")
    return joined.withColumn(
        name, F.lower(F.coalesce(F.col("new_name"), F.col(name)))
    ).drop("new_name")


def rename_wide(df: DataFrame, dictionary: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(
        {c: (dictionary.get(c) or c).lower() for c in df.columns}
    )


def value_limit_pairs(
    df: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Neighbouring (species, value column, limit column) triples to long rows."""
    entries = [
        F.struct(
            F.lit(species).alias("species"),
            F.col(value).cast("double").alias("value"),
            F.col(limit).cast("double").alias("mdl"),
        )
        for species, value, limit in pairs
    ]
    return df.select(*keys, F.inline(F.array(*entries)))


def route_pairs(long: DataFrame, scheme: DataFrame, sampler: str, keys: Sequence[str] = ()) -> DataFrame:
    """Target names and table of each species; unmapped species go to "No file".

    ``scheme`` has one row per species: (keys..., old_name, new_name, mdl_name, file_type).
    """
    s = broadcast_if_small(
        scheme.where(F.col("new_name").isNotNull()).select(
            *keys, F.col("old_name").alias("species"), "new_name", "mdl_name", "file_type"
        )
    )
    return long.join(s, [*keys, "species"], "left").select(
        *[c for c in long.columns if c not in ("value", "mdl")],
        F.concat(F.lit(f"{sampler}_"), F.coalesce("new_name", "species")).alias("value_name"),
        F.concat(
            F.lit(f"{sampler}_"),
            F.coalesce(F.col("mdl_name"), F.concat("species", F.lit("_mdl"))),
        ).alias("limit_name"),
        F.coalesce(F.col("file_type"), F.lit("No file")).alias("file_type"),
        "value",
        "mdl",
    )


def substitute_in_scheme(scheme: DataFrame, replacements: Sequence[tuple[str, str]], columns: Sequence[str] | None = None) -> DataFrame:
    """A scheme derived from another by literal text replacement, in order."""
    changes: dict[str, Column] = {}
    for c in columns or scheme.columns:
        value = F.col(c)
        for old, new in replacements:
            value = F.replace(value, F.lit(old), F.lit(new))
        changes[c] = value
    return scheme.withColumns(changes)


def add_missing(df: DataFrame, columns: Sequence[str], data_type: str = "double") -> DataFrame:
    """Null columns for those of the given names that the frame lacks."""
    lacking = [c for c in dict.fromkeys(columns) if c not in df.columns]
    return df.select("*", *[F.lit(None).cast(data_type).alias(c) for c in lacking])
