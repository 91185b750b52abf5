"""From sheet grids to one row per station and date, over the long layout.

Long rows: (station, date, fraction, is_blank, file_type, col_name, value). Every step up to the parsed rows joins lines with what
holds for their file and nothing else. Parsed rows of all sources are written once, tagged with their source; the merged table, the
rows set aside and every report read them there. The merge is one combined aggregate over numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import (
    BLANK_CODES, CARBON_VALUES, CARTRIDGE_IN_X0, COLUMN_FIXES, COLUMNS_DROPPED,
)
from hazeline.functions.dates import fill_date_parts
from hazeline.functions.text import any_of
from hazeline.operators.columns import rename_long, route_pairs, substitute_in_scheme
from hazeline.operators.joins import first_non_null, fold_full_outer, packed_order
from hazeline.operators.quality import complete_keys
from hazeline.operators.ranking import keep_first
from hazeline.operators.sizes import broadcast_if_small
from hazeline.sources import grid as G
from hazeline.sources.stages import staged

LONG = ["station", "date", "fraction", "is_blank", "file_type", "col_name", "value"]
SKIP = (
    "flag|time|naps|^sampling_date$|^date$|^year$|^month$|^day$|^cart$|^cartridge$|^media$"
    "|^sample_type$|^sampling_type$|^c_f$|^f_c$|^fraction$|(^|_)id(_|$)|^x0$"
)
# Row order inside a file must never decide which value wins.
ORDER = ["file_no", "row_no"]
#: Bits that source, file and row number may take in one number that orders rows.
ORDER_BITS = {"source_priority": 8, "file_no": 63, "row_no": 55}


def integrated_long(grids: G.Grids, samplers: DataFrame | None, fraction: str) -> DataFrame:
    """2010+ sheets: sampler and medium in the names, blanks by sample type."""
    named = G.with_sheet_names(grids, samplers)
    rows = G.observations(named, "sampling_date", True, ["file_no", "station", "sheet"], SKIP)
    return G.measures_long(
        rows.select(
            *ORDER, "station", "date", F.lit(fraction).alias("fraction"),
            any_of(F.col("blank_code"), BLANK_CODES).alias("is_blank"),
            F.col("sheet").alias("file_type"), "measured", "cells",
        ),
        [*ORDER, *LONG[:5]],
    )


def _in_files(files):
    """Membership in a short list of (station, file type)."""
    result = F.lit(False)
    for station, file_type in files:
        result = result | ((F.col("station") == station) & (F.col("file_type") == file_type))
    return F.coalesce(result, F.lit(False))


def _fixed_columns(long: DataFrame) -> DataFrame:
    """Known misnamed columns get their right name; known stray columns go."""
    name = F.col("col_name")
    meant = name
    for station, file_type, found, target in COLUMN_FIXES:
        meant = F.when(
            _in_files([(station, file_type)]) & (name == found), target
        ).otherwise(meant)
    kept = long
    for station, file_type, prefix in COLUMNS_DROPPED:
        kept = kept.where(~(_in_files([(station, file_type)]) & name.startswith(prefix)))
    return kept.withColumn("col_name", meant)


def speciation_long(grids: G.Grids, header_dict: DataFrame) -> DataFrame:
    """Pre-2010 speciation files: cartridges and media into the names, then the dictionary.

    ``header_dict``: (file_type, old_name, new_name, new_file_type).
    """
    rows = G.observations(G.with_sheet_names(grids), "date", False, ["file_no", "station", "file_type"], SKIP, ["x0"])
    media = F.when((F.col("file_type") == "NA") & (F.col("media") == "y"), "C").otherwise(F.col("media"))
    # ICPMS rows need a fraction; WICPMS only where the file has one; others are fine.
    fraction = (
        F.when(F.col("file_type") == "ICPMS", F.col("fraction"))
        .when(
            (F.col("file_type") == "WICPMS") & F.array_contains("names", "f_c"), F.col("f_c")
        )
        .otherwise("F")
    )
    cells = rows.withColumns(
        {
            "media": media,
            "fraction": fraction,
            "cart": F.when(_in_files(CARTRIDGE_IN_X0), F.col("x0")).otherwise(F.col("cart")),
            "is_blank": any_of(F.col("blank_code"), BLANK_CODES),
        }
    ).where(F.col("fraction").isin("F", "C"))
    keep = [*ORDER, "station", "date", "fraction", "is_blank", "file_type", "cart", "media"]
    long = _fixed_columns(G.measures_long(cells, keep))
    name = F.col("col_name")
    glued = (
        F.when(
            (F.col("file_type") == "CARB") & ~F.col("is_blank") & F.col("cart").isNotNull()
            & name.isin(*CARBON_VALUES),
            F.concat(F.lit("cart_"), F.col("cart"), F.lit("_"), name),
        )
        .when(
            (F.col("file_type") == "IC") & F.col("media").isNotNull(),
            F.concat(F.col("media"), F.lit("F_"), name),
        )
        .otherwise(name)
    )
    renamed = rename_long(
        long.withColumn("col_name", glued).drop("cart", "media"), header_dict,
        keys=["file_type"],
    )
    types = header_dict.where(F.col("new_file_type").isNotNull()).groupBy("file_type").agg(
        F.min("new_file_type").alias("new_file_type")
    )
    return (
        renamed.join(broadcast_if_small(types), "file_type", "left")
        .withColumns(
            {
                "file_type": F.coalesce("new_file_type", "file_type"),
                "col_name": F.concat(F.lit("spec_"), F.col("col_name")),
            }
        )
        .select(*ORDER, *LONG)
    )


MASS_TYPES = {"F": "PM2.5", "C": "PM2.5-10"}
MASS_NAMES = {
    ("spec", "F"): "spec_pm2_5", ("dich", "F"): "dich_pm2_5", ("dich", "C"): "dich_pm2_5_10",
}
SCHEME_CHANGES = {
    ("spec", "F"): (),
    ("dich", "F"): (("spec_pm2_5", "dich_pm2_5"),),
    ("dich", "C"): (("PM2.5", "PM2.5-10"), ("spec_pm2_5", "dich_pm2_5_10")),
}


def mass_file_long(grids: G.Grids, scheme: DataFrame, sampler: str, fractions: Sequence[str]) -> DataFrame:
    """Pre-2010 mass files: value and limit columns in pairs behind the mass, all fractions in one pass.

    Dichotomous files keep the first row of a station, date and fraction.
    """
    rows = G.observations(G.with_sheet_names(grids), "date", False, ["file_no", "station"], more=["mass"]).where(
        F.col("c_f").isin(*fractions)
    )
    if sampler == "dich":
        rows = keep_first(rows, ["station", "date", "c_f"], ORDER)
    keep = [*ORDER, "station", "date", "fraction", "is_blank"]
    keyed = rows.select(
        *ORDER, "station", "date", F.col("c_f").alias("fraction"), F.lit(False).alias("is_blank"), "names", "cells", "mass",
    )
    hits = {f: F.col("fraction") == f for f in fractions}

    def by_fraction(values: dict[str, str]):
        result = F
        for f, hit in hits.items():
            result = result.when(hit, values[f])
        return result

    # the mass goes along with the pairs, under its own table and name
    entries = F.concat(
        F.array(F.struct(
            F.lit(None).cast("string").alias("species"), G.to_double(F.col("mass")).alias("value"),
            F.lit(None).cast("double").alias("mdl"),
        )),
        F.coalesce(G.pair_entries(), F.array()),
    )
    long = keyed.select(*keep, F.inline(entries))
    derived = reduce(
        lambda a, b: a.unionByName(b),
        [substitute_in_scheme(scheme, SCHEME_CHANGES[sampler, f]).withColumn("fraction", F.lit(f)) for f in fractions],
    )
    routed = route_pairs(long, derived, sampler, ["fraction"])
    is_mass = F.col("species").isNull()
    both = F.array(
        F.struct(
            F.when(is_mass, by_fraction({f: MASS_NAMES[sampler, f] for f in fractions})).otherwise(F.col("value_name")).alias("col_name"),
            F.col("value").alias("value"),
        ),
        F.struct(F.col("limit_name").alias("col_name"), F.col("mdl").alias("value")),
    )
    tables = F.when(is_mass, by_fraction(MASS_TYPES)).otherwise(F.col("file_type"))
    return (
        routed.select(*keep, tables.alias("file_type"), F.inline(both)).where(F.col("value").isNotNull())
        .select(*ORDER, *LONG)
    )


def tagged_rows(sources: Sequence[DataFrame]) -> DataFrame:
    """The long rows of all sources, tagged with their place in the order of trust."""
    tagged = [s.withColumn("source_priority", F.lit(i)) for i, s in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def parsed_rows(sources: Sequence[DataFrame]) -> DataFrame:
    """The tagged rows, written, so that files are parsed once whatever reads them."""
    return staged(tagged_rows(sources), "parsed-rows")


def merge_long(parsed: DataFrame, file_type_short: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged long rows, quarantined rows with a missing key) of the parsed rows.

    One value per station, date, fraction, blank flag, file type and column: the first source in the order of trust that has one,
    inside it the first file and row. Names then get the file type's short name in front.
    """
    kept, aside = complete_keys(parsed, ["station", "date"])
    ordered = kept.withColumn("order_key", packed_order(ORDER_BITS))
    merged = first_non_null(ordered, LONG[:-1], ["value"], ["order_key"])
    short = broadcast_if_small(file_type_short.select("file_type", "short_name"))
    named = merged.join(short, "file_type", "left").withColumn(
        "col_name",
        F.when(
            F.col("short_name").isNotNull(), F.concat("short_name", F.lit("_"), "col_name")
        ).otherwise(F.col("col_name")),
    )
    return named.drop("short_name"), aside


def widen(
    long: DataFrame, columns: Sequence[str], more_keys: Sequence[str] = ()
) -> DataFrame:
    """One row per station and date with the declared columns, whatever their number."""
    declared = long.where(F.col("col_name").isin(*columns))
    return fill_date_parts(fold_full_outer(declared, ["station", "date", *more_keys], "col_name", "value", columns))


def select_canonical(long: DataFrame, names: DataFrame) -> DataFrame:
    """Rename through the canonical table (old_name, new_name), keeping mapped columns only."""
    table = broadcast_if_small(names.select(F.col("old_name").alias("col_name"), "new_name"))
    return long.join(table, "col_name", "inner").withColumn("col_name", F.col("new_name")).drop(
        "new_name"
    )
