"""The batch run: folders of raw files to the merged, persisted tables.

Every file is read once, into lines, and parsed once, into tagged long rows. Every table is a stage of a run that can be taken up again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.operators.naming import canonical_names
from hazeline.plans import harmonise as Z
from hazeline.sources import hourly, lookups
from hazeline.sources.grid import Grids, read_grids, rejected, sampler_info
from hazeline.sources.provenance import wanted_files, wanted_sheets
from hazeline.sources.stages import Run, fingerprint, scratch, write_table_csv

INFO_SHEET = "Station Info"


@dataclass(frozen=True)
class Folders:
    """Paths (globs allowed) of the raw files and of the lookup tables."""

    integrated_fine: str
    integrated_coarse: str
    speciation: str
    mass: str
    dichotomous: str
    header_dict: str
    part_scheme: str
    file_type_short: str
    stations: str | None = None
    hourly: str | None = None


def integrated(grids: Grids, fraction: str) -> DataFrame:
    """Long rows of a folder of 2010+ sheets, with the samplers of its station-info sheets."""
    info = sampler_info(grids.where(F.col("sheet") == INFO_SHEET)).where("description = 'Description' AND type <> 'pm'")
    return Z.integrated_long(grids.pick(wanted_sheets), info, fraction)


SHEETS = ("integrated_fine", "integrated_coarse", "speciation", "mass", "dichotomous")


def parse(spark: SparkSession, folders: Folders) -> tuple[DataFrame, DataFrame]:
    """(tagged long rows of all sources, paths of files without a header)."""
    grids = {name: read_grids(spark, getattr(folders, name)).pick(wanted_files) for name in SHEETS}
    header_dict = lookups.read_lookup(spark, "header_dict", folders.header_dict)
    scheme = lookups.read_lookup(spark, "part_scheme", folders.part_scheme)
    # In order of trust; the same value from a later source is not used.
    rows = Z.tagged_rows([
        Z.mass_file_long(grids["dichotomous"], scheme, "dich", ("F", "C")),
        Z.mass_file_long(grids["mass"], scheme, "spec", ("F",)),
        integrated(grids["integrated_fine"], "F"),
        integrated(grids["integrated_coarse"], "C"),
        Z.speciation_long(grids["speciation"], header_dict),
    ])
    data = [grids[n].pick(wanted_sheets) for n in ("integrated_fine", "integrated_coarse")]
    headed = [*data, *[grids[n] for n in ("speciation", "mass", "dichotomous")]]
    return rows, reduce(DataFrame.unionByName, map(rejected, headed))


def hourly_tables(spark: SparkSession, folders: Folders) -> dict[str, DataFrame]:
    """The checked hourly rows, the rows set aside, the report of the file check and the files without a header."""
    rows, no_header = hourly.read_hourly(spark, folders.hourly)
    known = lookups.read_stations(spark, folders.stations).select(F.col("naps").cast("string").alias("napsid"))
    accepted, invalid, report = hourly.checked_hourly(rows, known, allow_invalid_dates=True)
    return {"hourly": accepted, "hourly_invalid": invalid, "hourly_report": report, "hourly_rejects": no_header}


def run(spark: SparkSession, folders: Folders, target: str) -> dict[str, DataFrame]:
    """Every table of the batch below ``target``: merged (by fraction, clustered by station and date), quarantine (rows without station
    or date), rejects (files without a header) and the hourly ones.

    A run that died is taken up behind its last finished stage, as long as the files are the same; stale tables are removed at the end.
    """
    stages = Run(spark, target)
    lookup_files = (folders.header_dict, folders.part_scheme, folders.file_type_short)
    key = fingerprint(spark, *(getattr(folders, n) for n in SHEETS), *lookup_files)
    with scratch(spark):
        if not (stages.finished("parsed", key) and stages.finished("rejects", key)):
            rows, without_header = parse(spark, folders)
            stages.stage("rejects", key, lambda: without_header)
            stages.stage("parsed", key, lambda: rows)
        short = lookups.read_lookup(spark, "file_type_short", folders.file_type_short)
        merged, aside = Z.merge_long(stages.read("parsed"), short)
        tables = {
            "merged": stages.stage("merged", key, lambda: merged, ["fraction", "is_blank"], ["station", "date"]),
            "quarantine": stages.stage("quarantine", key, lambda: aside), "rejects": stages.read("rejects"),
        }
        if folders.hourly and folders.stations:
            hours = fingerprint(spark, folders.hourly, folders.stations)
            names = ("hourly", "hourly_invalid", "hourly_report", "hourly_rejects")
            if not all(stages.finished(n, hours) for n in names):
                for name, df in hourly_tables(spark, folders).items():
                    stages.stage(name, hours, lambda df=df: df)
            tables |= {n: stages.read(n) for n in names}
    stages.remove_stale()
    return tables


def write_canonical_names(spark: SparkSession, merged: DataFrame, target: str) -> DataFrame:
    """Canonical-name table of the fine samples' columns, written as CSV and returned."""
    fine = merged.where((F.col("fraction") == "F") & ~F.col("is_blank"))
    table = canonical_names(fine.select(F.col("col_name").alias("old_name")).distinct())
    write_table_csv(table, target)
    return spark.read.schema(table.schema).csv(target, header=True)
