"""Which sampler ran where and when."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.dates import year_end, year_start
from hazeline.operators.aggregates import coverage_span
from hazeline.operators.joins import anti_ranges
from hazeline.operators.sets import relabel_branch
from hazeline.sources.grid import Grids, sampler_info

COLOURS = {"Spec": "#F8766D", "Dichot": "#B79F00"}
OTHER_COLOUR = "#00BA38"


KIND_NAMES = {"spec": "Spec", "dich": "Dichot", "pm": "PM"}


def sheet_samplers(info_grids: Grids, folder: str) -> DataFrame:
    """Samplers of the 2010+ station-info sheets, with the type names of the dictionary."""
    kind = F
    for code, name in KIND_NAMES.items():
        kind = kind.when(F.col("type") == code, name)
    return sampler_info(info_grids).select(
        "sampler", "station", "year", F.lit(folder).alias("dir"), kind.alias("type"), "sampler_num"
    )


def file_samplers(grids: Grids, folder: str, kind: str, text: str | None = None) -> DataFrame:
    """Samplers of the older files: the first cell up to " at ", or a fixed text."""
    sampler = F.lit(text) if text is not None else F.regexp_replace(F.get("top", F.lit(0)), " at .*", "")
    return grids.files.select(
        sampler.alias("sampler"), "station", "year", F.lit(folder).alias("dir"),
        F.lit(kind).alias("type"), F.lit(None).cast("string").alias("sampler_num"),
    )


def sampler_dictionary(*parts: DataFrame) -> DataFrame:
    """All samplers of all folders in one table."""
    return reduce(lambda a, b: a.unionByName(b), parts)


#: Folder whose samplers the timeline leaves out: they are those of the fine sheets again.
LEFT_OUT_FOLDER = "IntegratedPM2.5-10"


def sampler_timeline(
    samplers: DataFrame, stations: DataFrame, exclusions: DataFrame,
    corrected_city: str | None = None, corrected_type: str = "PM", corrected_text: str = "",
) -> DataFrame:
    """Span of years by city, type and sampler, with the colour of the type.

    ``samplers``: (station, year, sampler, type) and the folder as dir, if known; ``stations``: (station, city), all others are left
    out; ``exclusions``: (station, from_date, to_date). For one city the sampler text of one type
    can be overwritten.
    """
    if "dir" in samplers.columns:
        # as a filter on text reads it: rows without a folder go too
        samplers = samplers.where(F.col("dir") != LEFT_OUT_FOLDER)
    spans = samplers.withColumns(
        {"start_year": year_start(F.col("year")), "end_year": year_end(F.col("year"))}
    )
    kept = anti_ranges(spans, exclusions, "station", "start_year")
    placed = kept.join(stations.select("station", "city"), "station", "inner")
    if corrected_city is not None:
        wrong = (F.col("city") == corrected_city) & (F.col("type") == corrected_type)
        placed = relabel_branch(placed, wrong, {"sampler": F.lit(corrected_text)})
    colour = F
    for kind, code in COLOURS.items():
        colour = colour.when(F.col("type") == kind, code)
    return coverage_span(placed, ["city", "type", "sampler"], "start_year", "end_year").withColumn(
        "colour", colour.otherwise(OTHER_COLOUR)
    )


def figure_rows(timeline: DataFrame, kinds: Sequence[str], cities: Sequence[str] = ()) -> DataFrame:
    """The timeline's rows of some types, and an otherwise empty row for each listed city that has none."""
    shown = timeline.where(F.col("type").isin(*kinds))
    listed = shown.sparkSession.createDataFrame([(c,) for c in cities], "city string")
    return shown.unionByName(listed.join(shown.select("city").distinct(), "city", "left_anti"), allowMissingColumns=True)
