"""Lines of text files with their number in the file, from splits of any size.

Files are read in splits, so no task and no row ever holds a whole file. A line is (path, block, at, line): the split's first
byte, and a number that grows by one from line to line inside the split. What has to be known about order is kept in a table of one row for
each split: its first and last line, how far ``at`` is from the line number, and the line that follows the split. Line numbers are a
join with that table by split, which spreads a huge file over many keys, and the line after a given one is found across the border of
splits in the same way.

Texts in a column take the same form with ``table_lines``: a row is a file of a single split.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazeline.sources.stages import staged

SPLIT = ["path", "block"]


def plain_path(path: Column) -> Column:
    """A path as it was written, from Spark's address of a file; local ones come with one slash or with three."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    # most paths have no escape, and lines have one each
    plain = F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)
    local = F.concat(F.lit("file:/"), F.ltrim(F.substring(plain, 7, 2**31 - 1), F.lit("/")))
    return F.when(F.startswith(plain, F.lit("file:/")), local).otherwise(plain)


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path): every file. From Spark's own listing, because a scan leaves empty files out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles()
    return spark.createDataFrame([(f,) for f in files], "path string").select(plain_path(F.col("path")).alias("path"))


def read_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Every line of every file. Written, so that files are read once and places stay the same afterwards."""
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    return staged(
        raw.select(
            plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"), F.decode(F.col("value").cast("binary"), encoding).alias("line"),
        ),
        "lines",
    )


def table_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """The lines of a text column, under the key as path; a null text has none."""
    return df.select(
        F.col(key).alias("path"), F.lit(0).cast("long").alias("block"), F.posexplode(F.split(text, "\n")).alias("at", "line")
    ).withColumn("at", F.col("at").cast("long"))


def splits(lines: DataFrame, marks: Mapping[str, Column] | None = None) -> DataFrame:
    """One row for each split: path, block, first, last, shift (line number = at + shift), next_block and next_at.

    For each mark, a condition on ``line``, also the ``at`` of the first and the last such line of the split. One combined
    pass over the lines; the window is over splits.
    """
    marks = marks or {}
    found = lines.groupBy(*SPLIT).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n"),
        *[f(F.when(hit, F.col("at"))).alias(f"{side}_{name}")
          for name, hit in marks.items() for side, f in (("first", F.min), ("last", F.max))],
    )
    order = W.partitionBy("path").orderBy("block")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return staged(
        found.withColumns({
            "shift": before - F.col("first") + 1,
            "next_block": F.lead("block").over(order), "next_at": F.lead("first").over(order),
        }),
        "splits",
    )


def marked(of: DataFrame, name: str, last: bool = False) -> DataFrame:
    """(path, block, at, row_no) of each file's first or last line with a mark; files without one are left out."""
    at = F.col(f"{'last' if last else 'first'}_{name}")
    place = F.struct("block", at.alias("at"), (at + F.col("shift")).alias("row_no"))
    return (
        of.where(at.isNotNull()).groupBy("path").agg((F.max if last else F.min)(place).alias("place"))
        .select("path", "place.*")
    )


def numbered(lines: DataFrame, of: DataFrame, *more: str) -> DataFrame:
    """Adds row_no, from 1 in each file, and further columns of the split table."""
    return lines.join(of.select(*SPLIT, "shift", *more), SPLIT).withColumn("row_no", F.col("at") + F.col("shift")).drop("shift")


def successors(found: DataFrame, lines: DataFrame, of: DataFrame) -> DataFrame:
    """``found``, some of the lines, with ``after``: the line behind each, null behind a file's last one.

    The found lines are written, so Spark knows how few they are before it meets them with all lines.
    """
    keep = [c for c in found.columns if c not in ("block", "at")]
    inside = F.col("at") < F.col("last")
    places = staged(
        found.join(of.select(*SPLIT, "shift", "last", "next_block", "next_at"), SPLIT).select(
            *keep, (F.col("at") + F.col("shift")).alias("row_no"),
            F.when(inside, F.col("block")).otherwise(F.col("next_block")).alias("block"),
            F.when(inside, F.col("at") + 1).otherwise(F.col("next_at")).alias("at"),
        ),
        "found-lines",
    )
    behind = lines.select(*SPLIT, "at", F.col("line").alias("after"))
    # the written places come first: a left join keeps them all
    return places.join(behind, [*SPLIT, "at"], "left").drop("block", "at")
