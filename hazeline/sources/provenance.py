"""Year, station and file type from a file's own name, wherever the file lies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import FILE_REJECT_PATTERN, SHEET_REJECT_PATTERN


def file_name(path: Column) -> Column:
    """The file's own name; for a part of a folder that Spark wrote as ``column=name``, that name."""
    folder = F.regexp_extract(path, r"=([^/]+)/part-[^/]*$", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), F.regexp_extract(path, r"([^/]+)$", 1))


def path_parts(path: Column) -> dict[str, Column]:
    """Parts of ``<year>_S<station>[_<file type>...].<extension>``; null where absent."""
    name = file_name(path)

    def found(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))

    return {
        "year": found(r"(?:^|_)(\d{4})(?:_|\.|$)").try_cast("int"),
        "station": found(r"_(S\d+)(?:_|\.)"),
        "file_type": found(r"_S\d+_([^_.]+)"),
        "leading": found(r"^([^_.]+)"),
    }


def with_path_parts(df: DataFrame, path: str = "path") -> DataFrame:
    parts = path_parts(F.col(path))
    return df.withColumns({k: parts[k] for k in ("year", "station", "file_type")})


def wanted_files(df: DataFrame, path: str = "path") -> DataFrame:
    """Leave out French copies, change logs and the like, by file name.

    The extension is not looked at: sheets reach us as text exports, which end in csv.
    """
    stem = F.regexp_replace(file_name(F.col(path)), r"\.[^.]+$", "")
    return df.where(~stem.rlike(FILE_REJECT_PATTERN))


def wanted_sheets(df: DataFrame, sheet: str = "sheet") -> DataFrame:
    return df.where(~F.col(sheet).rlike(SHEET_REJECT_PATTERN))
