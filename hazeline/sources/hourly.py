"""Hourly files: ragged CSV, several header spellings, one optional column.

Read by the splittable CSV source; nothing here needs a whole file in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.fixed_values import (
    HOUR_COLUMNS, HOURLY_COLUMNS, HOURLY_HEADER_MARK, HOURLY_MAX_FIELDS, HOURLY_POLLUTANTS,
    METHOD_HEADERS,
)
from hazeline.functions.dates import fill_date_parts, parse_date
from hazeline.functions.numeric import to_double
from hazeline.functions.text import na_to_null, strip_leading_zeros, strip_quotes
from hazeline.operators.quality import accept_sources, source_report, split_invalid
from hazeline.sources.grid import comma_cells
from hazeline.sources.provenance import path_parts
from hazeline.sources.stages import staged


def ragged_cells(line, width: int):
    """Cells of one text line: quotes gone, tokens null, padded or cut to ``width``."""
    cells = comma_cells(line)
    padding = F.array_repeat(F.lit(None).cast("string"), width)
    return F.slice(F.concat(cells, padding), 1, width)


def read_ragged_csv(spark: SparkSession, path: str, width: int = HOURLY_MAX_FIELDS) -> DataFrame:
    """(path, place, c1..c<width>): short rows filled with null, quoting off, latin1.

    ``place`` orders the rows of a file although files are read in splits.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(1, width + 1)])
    raw = (
        spark.read.schema(schema)
        .options(header=False, encoding="ISO-8859-1", quote="", mode="PERMISSIVE")
        .csv(path)
    )
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("place"),
        *[na_to_null(strip_quotes(F.col(c.name))).alias(c.name) for c in schema],
    )


def header_rows(raw: DataFrame) -> DataFrame:
    """(path, second): second cell of each file's last header row. One small row per file."""
    return (
        raw.where(F.contains("c1", F.lit(HOURLY_HEADER_MARK)))
        .groupBy("path")
        .agg(F.max_by("c2", "place").alias("second"))
    )


def read_hourly(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(typed hourly rows, paths of files without a header).

    The one row per file with its header is written once, so that later steps do not read the files again for it.
    Rejects come from Spark's own listing of files, so empty ones, which no task reads, are among them.
    """
    raw = read_ragged_csv(spark, path)
    headers = staged(header_rows(raw), "hourly-headers")
    listed = spark.createDataFrame([(f,) for f in raw.inputFiles()], "path string")
    # local paths are written with one slash or with three
    same = F.regexp_replace(listed["path"], "^file:/+", "/") == F.regexp_replace(headers["path"], "^file:/+", "/")
    rejects = listed.join(headers, same, "left_anti")
    wanted = raw.where(F.col("c1").isin(*HOURLY_POLLUTANTS)).drop("place")
    rows = wanted.join(headers, "path").withColumn(
        "shifted", F.coalesce(F.col("second").isin(*METHOD_HEADERS), F.lit(False))
    )

    def cell(i: int):
        """Cell i (from 1) of the fixed layout: one further right behind an optional column."""
        plain = F.col(f"c{i}")
        return plain if i == 1 else F.when(F.col("shifted"), F.col(f"c{i + 1}")).otherwise(plain)

    convert = {
        "date": parse_date, "napsid": strip_leading_zeros, "latitude": to_double,
        "longitude": to_double, **{h: to_double for h in HOUR_COLUMNS},
    }
    typed = rows.select(
        F.col("path").alias("source"),
        path_parts(F.col("path"))["year"].alias("declared_year"),
        *[
            convert.get(name, lambda c: c)(cell(i)).alias(name)
            for i, name in enumerate(HOURLY_COLUMNS, 1)
        ],
    )
    return fill_date_parts(typed), rejects


def checked_hourly(
    hourly: DataFrame, stations: DataFrame, allow_invalid_dates: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted rows, quarantined rows without a date, report per file).

    ``stations`` has one column ``napsid``. Invalid dates condemn their file unless allowed;
    the rows themselves are set aside in either case.
    """
    report = source_report(
        hourly, stations, station="napsid", allow_invalid_dates=allow_invalid_dates
    )
    valid, invalid = split_invalid(hourly, F.col("date").isNotNull())
    accepted = accept_sources(valid, report)
    # Equal rows from several files collapse to one.
    return accepted.drop("source", "declared_year").distinct(), invalid, report
