"""Raw sheet grids: untyped cells, the header somewhere below a few odd rows.

Sheets are read line by line (``sources.lines``), so a file may be of any length. What holds for a whole file (its header row, the
marker rows above it, its provenance) is one row of a file table, found with one combined pass over the lines; data rows
get it through a join by split, which spreads a long file over many keys. Lines are cut into cells only where cells are needed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.fixed_values import (
    GRID_HEADER_PATTERN, MEDIUM_MARK, MEDIUM_SHEET, SAMPLER_INFO_MARK, SAMPLER_MARK,
)
from hazeline.functions.dates import parse_date, serial_date
from hazeline.functions.numeric import to_double
from hazeline.functions.text import (
    clean_name_column, na_to_null, parenthesised, sampler_kind, strip_quotes,
)
from hazeline.sources import lines as L
from hazeline.sources.provenance import file_name, with_path_parts
from hazeline.sources.stages import staged

DISCRIMINATORS = (
    "cart", "cartridge", "media", "sample_type", "sampling_type", "c_f", "f_c", "fraction",
)
CellCutter = Callable[[Column], Column]


def comma_cells(line: Column) -> Column:
    """Cells of a line: quotes gone, missing-value tokens null."""
    return F.transform(plain_cells(line), lambda cell: na_to_null(cell))


def plain_cells(line: Column) -> Column:
    """Cells of a line as they stand, but for quotes: for rows of which only some cells are looked at, each by ``na_to_null``."""
    return F.split(strip_quotes(line), ",")


def _first_cell(line: Column, cells: CellCutter) -> Column:
    return F.get(cells(line), F.lit(0))


def has_cell(pattern: str, cells: CellCutter = comma_cells) -> Column:
    """The line has a matching cell. ``pattern`` must match inside a cell; lines without any match are not cut up."""
    line = F.col("line")
    return F.when(
        line.rlike(pattern), F.exists(cells(line), lambda c: F.coalesce(c.rlike(pattern), F.lit(False)))
    ).otherwise(F.lit(False))


def starts_with(mark: str, whole: bool = False, cells: CellCutter = comma_cells) -> Column:
    """The line's first cell contains the mark, or is it; decided on the plain line where that rules it out."""
    line = F.col("line")
    cell = _first_cell(line, cells)
    hit = cell == mark if whole else F.contains(cell, F.lit(mark))
    return F.when(F.contains(line, F.lit(mark)), F.coalesce(hit, F.lit(False))).otherwise(F.lit(False))


@dataclass(frozen=True)
class Grids:
    """lines: (path, block, at, line); splits: as of ``lines.splits``; files: one row for each file.

    For each mark the file table has ``<mark>_row``, 0 where the file has no such row, and ``<mark>``, its cells. Choosing files
    chooses their lines: every step joins lines with the file table.
    """

    lines: DataFrame
    splits: DataFrame
    files: DataFrame

    def where(self, condition: Column | str) -> Grids:
        return replace(self, files=self.files.where(condition))

    def pick(self, files: Callable[[DataFrame], DataFrame]) -> Grids:
        return replace(self, files=files(self.files))

    def rows(self, *keep: str) -> DataFrame:
        """Every line of the chosen files: path, block, at, line, row_no and columns of the file table.

        What lines meet is written, one row for each split: by its true size Spark sends it to the lines, and never the lines to it.
        """
        spread = staged(self.splits.select(*L.SPLIT, "shift").join(self.files.select("path", *keep), "path"), "file-splits")
        return self.lines.join(spread, L.SPLIT).withColumn("row_no", F.col("at") + F.col("shift")).drop("shift")


def grids_of(
    lines: DataFrame, marks: Mapping[str, Column], files: DataFrame | None = None, cells: CellCutter = comma_cells
) -> Grids:
    """The first row of each mark in every file; marks are conditions on ``line`` and ``block``.

    files: all files, with a column path; by default those that have lines.
    """
    of = L.splits(lines, marks)
    places = staged(
        reduce(DataFrame.unionByName, [L.marked(of, name).withColumn("mark", F.lit(name)) for name in marks]), "marked-rows"
    )
    candidates = lines.where(reduce(lambda a, b: a | b, marks.values()))
    found = candidates.join(places, [*L.SPLIT, "at"]).select("path", "mark", "row_no", cells(F.col("line")).alias("cells"))
    # one row for each mark of a file
    wide = found.groupBy("path").agg(
        *[F.max(F.when(F.col("mark") == m, F.col("row_no"))).alias(f"{m}_row") for m in marks],
        *[F.max(F.when(F.col("mark") == m, F.col("cells"))).alias(m) for m in marks],
    )
    files = of.select("path").distinct() if files is None else files
    full = files.join(wide, "path", "left").withColumns(
        {f"{m}_row": F.coalesce(f"{m}_row", F.lit(0).cast("long")) for m in marks}
    )
    return Grids(lines, of, staged(full, "grid-files"))


def read_grids(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> Grids:
    """Sheets with header and marker rows; files: path, file_no (in the order of paths), year, station, file_type and sheet.

    The sheet is the part of the file name between the last ``__`` and the extension. Every file is read once.
    """
    files = L.listed_files(spark, path).repartitionByRange("path").sortWithinPartitions("path")
    files = with_path_parts(files.withColumn("file_no", F.monotonically_increasing_id())).withColumn(
        "sheet", F.nullif(F.regexp_extract(file_name(F.col("path")), r"__([^/]+)\.[^.]+$", 1), F.lit(""))
    )
    marks = {
        "header": has_cell(GRID_HEADER_PATTERN), "medium": starts_with(MEDIUM_MARK, whole=True),
        "sampler": starts_with(SAMPLER_MARK, whole=True), "top": F.col("block") == 0,
    }
    return grids_of(L.read_lines(spark, path, encoding), marks, files)


def rejected(grids: Grids) -> DataFrame:
    """(path): files without a header, empty ones among them."""
    return grids.files.where(F.col("header_row") == 0).select("path")


def has_optional_column(header: Column, spellings: Sequence[str]) -> Column:
    """True if the second header cell is one of the spellings."""
    return F.coalesce(F.get(header, F.lit(1)).isin(*spellings), F.lit(False))


def narrowed(cells: Column, optional: Column) -> Column:
    """Cells without column 2 where it is the optional one."""
    dropped = F.concat(F.slice(cells, 1, 1), F.slice(cells, F.lit(3), F.size(cells)))
    return F.when(optional, dropped).otherwise(cells)


def unique_names(names: Column) -> Column:
    """Repeated names get _2, _3, ... in order of appearance."""

    def numbered(name: Column, i: Column) -> Column:
        same = F.size(F.filter(F.slice(names, F.lit(1), i + 1), lambda n: n == name))
        return F.when(same > 1, F.concat(name, F.lit("_"), same)).otherwise(name)

    return F.transform(names, numbered)


def _below_header(grids: Grids, keep: Sequence[str], cells: CellCutter) -> DataFrame:
    headed = grids.where(F.col("header_row") > 0)
    below = headed.rows("header_row", *[c for c in keep if c != "path"]).where(F.col("row_no") > F.col("header_row"))
    return below.select(*keep, "row_no", cells(F.col("line")).alias("cells"))


def body_rows(grids: Grids, keep: Sequence[str], cells: CellCutter = comma_cells) -> DataFrame:
    """Kept columns, row_no and cells of each row below the header that is not empty."""
    return _below_header(grids, keep, cells).where(F.exists("cells", lambda c: c.isNotNull()))


def cells_long(grids: Grids, cells: CellCutter = comma_cells, optional: Column | None = None) -> DataFrame:
    """(path, row_no, place, value): the cells below the header, places from 1.

    With ``optional``, a condition on the header, the second column goes where it holds.
    """
    if optional is not None:
        grids = replace(grids, files=grids.files.withColumn("optional", optional))
    rows = body_rows(grids, ["path", *(["optional"] if optional is not None else [])], cells)
    row = narrowed(F.col("cells"), F.col("optional")) if optional is not None else F.col("cells")
    return rows.select("path", "row_no", F.posexplode(row).alias("place", "value")).withColumn("place", F.col("place") + 1)


def header_places(grids: Grids, optional: Column | None = None) -> DataFrame:
    """(path, place, col_name) of the header cells, places from 1."""
    names = F.col("header") if optional is None else narrowed(F.col("header"), optional)
    named = grids.files.where(F.col("header_row") > 0).select("path", F.posexplode(names).alias("place", "col_name"))
    return named.withColumn("place", F.col("place") + 1)


def with_place_names(df: DataFrame, places: DataFrame) -> DataFrame:
    """Adds col_name to rows with path and place; places beyond the header are named by their number.

    Rows may be cells or what was counted of them by place: names then meet far fewer rows.
    """
    known = places.withColumn("named", F.lit(True))
    beyond = F.when(F.col("named").isNull(), F.concat(F.lit("..."), "place"))
    return df.join(known, ["path", "place"], "left").withColumn("col_name", F.coalesce("col_name", beyond)).drop("named")


def promote_long(grids: Grids, cells: CellCutter = comma_cells, optional: Column | None = None) -> DataFrame:
    """Header cells become column names: (path, row_no, col_name, value), without cells that lack either."""
    named = with_place_names(cells_long(grids, cells, optional), header_places(grids, optional))
    return named.select("path", "row_no", "col_name", "value").where(F.col("col_name").isNotNull() & F.col("value").isNotNull())


def _prefixed(names: Column, prefix: Column) -> Column:
    """Cell-wise prefix where one is given."""
    return F.zip_with(
        names, prefix,
        lambda n, p: F.when(p.isNull() | n.isNull(), n).otherwise(F.concat(p, F.lit("_"), n)),
    )


def _marker_cells(row: str, mark: str) -> Column:
    """Cells of a marker row; the mark itself and N/A are no values."""
    return F.transform(row, lambda c: F.when(~c.rlike(f"(?i)N/A|{mark}"), c))


def with_sheet_names(grids: Grids, samplers: DataFrame | None = None) -> Grids:
    """Adds ``names`` to the files: cleaned header cells with filter medium and sampler type in front.

    ``samplers`` is the output of :func:`sampler_info`; its S-1 and S-2 types replace the
    codes of the Sampler row. Without an entry for station and year no sampler is prefixed.
    Missing marker rows are listed in ``warnings``.
    """
    medium = F.when(F.col("sheet") == MEDIUM_SHEET, _marker_cells("medium", MEDIUM_MARK))
    df = grids.files.withColumns({"__medium": medium, "__sampler": _marker_cells("sampler", SAMPLER_MARK)})
    if samplers is None:
        df = df.withColumns({"s1": F.lit(None).cast("string"), "s2": F.lit(None).cast("string"),
                             "has_info": F.lit(False)})
    else:
        types = samplers.groupBy("station", "year").agg(
            F.min(F.when(F.col("sampler_num") == "S-1", F.col("type"))).alias("s1"),
            F.min(F.when(F.col("sampler_num") == "S-2", F.col("type"))).alias("s2"),
        )
        df = df.join(types.withColumn("has_info", F.lit(True)), ["station", "year"], "left")
    kinds = F.transform(
        F.col("__sampler"),
        lambda c: F.replace(
            F.replace(c, F.lit("S-1"), F.coalesce("s1", F.lit(""))),
            F.lit("S-2"), F.coalesce("s2", F.lit("")),
        ),
    )
    named = F.when(F.col("__medium").isNotNull(), _prefixed(F.col("header"), F.col("__medium"))
                   ).otherwise(F.col("header"))
    named = F.when(
        F.col("__sampler").isNotNull() & F.coalesce("has_info", F.lit(False)),
        _prefixed(named, kinds),
    ).otherwise(named)
    cleaned = unique_names(F.transform(named, lambda n: clean_name_column(n)))
    warnings = F.array_compact(
        F.array(
            F.when((F.col("sheet") == MEDIUM_SHEET) & F.col("__medium").isNull(), "no medium row"),
            F.when(F.col("__sampler").isNull(), "no sampler row"),
        )
    )
    named = df.withColumns({"names": cleaned, "warnings": warnings}).drop("__medium", "__sampler", "s1", "s2", "has_info")
    # names are worked out once for each file, not where they meet its rows
    return replace(grids, files=staged(named, "sheet-names"))


def observations(grids: Grids, date_column: str, serial: bool, keep: Sequence[str], skip: str = "$^", more: Sequence[str] = ()) -> DataFrame:
    """Data rows with date, discriminators and ``more`` named cells as columns, and the cells still together, as they stand.

    Adds ``blank_code``: the cell of the first discriminator column that the sheet has; and ``measured``: the names that do not match
    ``skip``, null for the others, worked out once for each file. Rows without any cell are still there: they have no measures.
    """
    place = {c: F.nullif(F.array_position("names", c).cast("int"), F.lit(0)) - 1 for c in (date_column, *DISCRIMINATORS, *more)}
    single = {c: place[c] for c in (*DISCRIMINATORS, *more)}
    at = {"date": place[date_column], "blank_code": F.coalesce(*[place[c] for c in DISCRIMINATORS[:5]]), **single}
    # worked out once for each file, so that little code runs for each row
    known = {f"at_{name}": column for name, column in at.items()}
    named = replace(grids, files=grids.files.withColumns(
        {**known, "measured": F.transform("names", lambda n: F.when(~n.rlike(skip), n))}
    ))
    body = _below_header(named, [*keep, "names", "measured", *known], plain_cells)
    cell = {name: na_to_null(F.get("cells", F.col(f"at_{name}"))) for name in at}
    date = serial_date(cell["date"]) if serial else parse_date(cell["date"], ("yyyy-MM-dd", "yyyyMMdd"))
    return body.withColumns({**cell, "date": date}).drop(*known)


def _number(cell: Column) -> Column:
    return to_double(na_to_null(cell))


def measures_long(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep..., col_name, value): the numeric cells under the measured names."""
    cells = df.select(*keep, F.inline(F.arrays_zip(F.col("measured").alias("col_name"), F.col("cells").alias("cell"))))
    numbers = cells.where(F.col("col_name").isNotNull() & F.col("cell").isNotNull())
    return numbers.select(*keep, "col_name", _number(F.col("cell")).alias("value")).where(F.col("value").isNotNull())


def pair_entries(mass: str = "mass") -> Column:
    """(species, value, mdl) entries of a data row, from neighbouring columns behind the mass column; null without any."""
    names, cells = F.col("names"), F.col("cells")
    start = F.array_position(names, mass).cast("int")
    # Integer division keeps the sequence empty-safe when no pair follows.
    pairs = F.floor((F.size(names) - start) / 2).cast("int")
    steps = F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1))
    return F.transform(
        steps,
        lambda i: F.struct(
            F.get(names, start + 2 * i).alias("species"),
            _number(F.get(cells, start + 2 * i)).alias("value"),
            _number(F.get(cells, start + 2 * i + 1)).alias("mdl"),
        ),
    )


def next_rows(grids: Grids, mark: str, keep: Sequence[str], cells: CellCutter = comma_cells) -> DataFrame:
    """For every row whose first cell contains the mark: that cell and the row after it, also across the border of splits."""
    found = grids.lines.where(starts_with(mark, cells=cells)).join(
        grids.files.select("path", *[c for c in keep if c != "path"]), "path"
    )
    pairs = L.successors(found, grids.lines, grids.splits)
    return pairs.select(
        *keep, F.col("row_no").alias("marker_row"), _first_cell(F.col("line"), cells).alias("marker"),
        cells(F.col("after")).alias("next_cells"),
    )


def sampler_info(grids: Grids) -> DataFrame:
    """Sampler dictionary from station-info sheets.

    (description, sampler, sampler_num, station, year, type) with type spec, dich or pm.
    """
    found = next_rows(grids, SAMPLER_INFO_MARK, ["station", "year"])
    return found.select(
        F.get("next_cells", F.lit(0)).alias("description"),
        F.get("next_cells", F.lit(1)).alias("sampler"),
        F.explode(parenthesised(F.col("marker"))).alias("sampler_num"),
        "station",
        "year",
    ).withColumn("type", sampler_kind(F.col("sampler"))).distinct()
