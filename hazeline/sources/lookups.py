"""Lookup tables, each with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.text import na_to_null
from hazeline.operators.columns import with_clean_names

SCHEMAS = {
    "header_dict": "file_type string, old_name string, new_name string, new_file_type string, col_type string",
    "part_scheme": "old_name string, new_name string, mdl_name string, file_type string",
    "file_type_short": "file_type string, short_name string",
    "om_factor": "season string, city string, correction_factor double",
    "canonical_names": "old_name string, new_name string",
    "station_exclusion": "station string, from_date date, to_date date",
    "published_counts": "station string, n_published int",
}


def read_lookup(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).csv(path, header=True)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station metadata: clean names, a key ``station`` = S + number, no pollutant flags."""
    raw = spark.read.csv(path, header=True)  # all text; only the header is read here
    named = with_clean_names(raw)
    columns = named.columns
    if "so2" in columns and "pah" in columns:
        first, last = columns.index("so2"), columns.index("pah")
        columns = columns[:first] + columns[last + 1:]
    numbers = {"latitude": "double", "longitude": "double", "naps": "int", "combined_stations": "int"}
    typed = named.select(
        *[
            na_to_null(F.col(c)).try_cast(numbers.get(c, "string")).alias(c) for c in columns
        ]
    )
    return typed.withColumn("station", F.concat(F.lit("S"), F.col("naps")))
