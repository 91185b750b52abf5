"""Removal of repeated runs of lines, by suffixes of line-id sequences named in prefix doubling.

A document is the sequence of its lines that hold a word. Every line begins a suffix of such a sequence. The first round names suffixes by
their first line; each further round names them by twice as many lines, from the two names that make them up, until no name is shared. Names
that nobody shares drop out at once, so rounds after the first work on repeated lines only. Suffixes under one name share that many lines: they
are an interval of the suffix array with at least this longest common prefix.

The exact length that a suffix shares with an earlier one then comes from the names, longest first. All suffixes begin in one interval, of common
length 0. A round of 2^k lines parts each interval by the name of the next 2^k lines: members that an earlier one follows in this move
on to the longer interval; the first member of a part stays, because shorter extensions may still meet an earlier suffix of another part, and is also put in
the longer interval, to be met there. So one member of each part stays, and the intervals together hold little more than one row for a suffix.

A run of lines that also starts earlier is a later copy. Maximal later copies of at least MIN_WORDS words are deleted, whether they are one line
or many. The deleted lines of a document follow from a running maximum of the ends of such runs, so a long run costs a row for each line.

Names are pairs of 64-bit hashes of the content, the same on every executor. A name that many suffixes share is counted
with a partial aggregate before it is shuffled, and the join that hands the counts back can be split by Spark.

The first copy is that of the smallest doc_id, null last, then of the smaller text hash, then the first in the text; a copy may overlap its
original. Runs are judged on the input, not on what is left. Nulls and odd rows: a null text has no lines; blank lines are in no run and always stay;
rows of equal doc_id and text are one document and keep the same lines; every input row gives one output row; an empty table gives an
empty result. Other columns are not looked at, and ``deduplicated`` passes all of them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hazeline.llm.registry import query, table
from hazeline.llm.stages import discard, materialise

#: Words of a later copy from which it is deleted.
MIN_WORDS = 10
BLANK = " \t\n\x0b\x0c\r"


def name_of(*parts: Column | str) -> Column:
    """128 bits of content: two hashes with different beginnings."""
    return F.struct(F.xxhash64(F.lit(0), *parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, no, at, words, name): a row for each line with a word; no counts these, at counts all lines."""
    lines = F.filter(
        F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("at"), line.alias("line"))),
        lambda x: F.length(F.trim(x["line"], F.lit(BLANK))) > 0,
    )
    line = F.col("x.line")
    # single spaces between words, as nearly always, are counted; anything else is cut up
    odd = line.startswith(" ") | line.endswith(" ")
    for mark in ("  ", *BLANK[1:]):
        odd = odd | line.contains(mark)
    cut = F.size(F.array_remove(F.split(F.translate(line, BLANK, " " * len(BLANK)), " "), ""))
    words = F.when(odd, cut).otherwise(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)
    return (
        docs.select("doc_id", F.xxhash64("text").alias("tie"), F.posexplode(lines).alias("no", "x"))
        .select(
            "doc_id", "tie", "no", F.col("x.at").alias("at"), words.cast("long").alias("words"), name_of("x.line").alias("name"),
        )
    )


def placed(lines: DataFrame) -> DataFrame:
    """(doc_id, tie, at, words, name, doc, pos): pos is the line's number among all lines in the order of documents, doc that of its
    document's first line.

    Documents are put in order by range; the driver sees the number of lines of each range. Rows of equal doc_id and text are one document.
    """
    lines = materialise(lines.distinct(), "line-names")
    sizes = lines.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("n"))
    ordered = sizes.withColumn("last", F.col("doc_id").isNull())
    ranged = materialise(
        ordered.repartitionByRange("last", "doc_id", "tie").withColumn("range", F.spark_partition_id()), "line-documents"
    )
    before, offsets = 0, []
    for r in sorted(ranged.groupBy("range").agg(F.sum("n").alias("n")).collect()):
        offsets.append((r["range"], before))
        before += r.n
    # as many rows as partitions
    offsets = F.broadcast(lines.sparkSession.createDataFrame(offsets, "range int, before long"))
    inside = W.partitionBy("range").orderBy("last", "doc_id", "tie").rowsBetween(W.unboundedPreceding, -1)
    doc = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    ranged = ranged.join(offsets, "range")
    starts = ranged.select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), doc.alias("doc"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t"))
    return materialise(
        lines.join(starts, same).select("doc_id", "tie", "at", "words", "name", "doc", (F.col("doc") + F.col("no")).alias("pos")),
        "line-places",
    )


def at_place(df: DataFrame, other: DataFrame, pos: Column, how: str = "inner") -> DataFrame:
    """df joined with the suffix of ``other`` that begins at ``pos`` in the same document; its other columns come along."""
    there = other.withColumnsRenamed({"doc": "__d", "pos": "__p"})
    return df.join(there, (pos == F.col("__p")) & (F.col("doc") == F.col("__d")), how).drop("__d", "__p")


def shared(suffixes: DataFrame) -> DataFrame:
    """The suffixes whose name others have too."""
    # written before it is joined, so that Spark can split a name that very many suffixes share
    intervals = materialise(
        suffixes.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"), "line-intervals"
    )
    return suffixes.join(intervals, "name").select("doc", "pos", "name")


def doubled(suffixes: DataFrame, by: int) -> DataFrame:
    """Suffixes named by their own name and that of the suffix ``by`` lines on."""
    ahead = suffixes.withColumnRenamed("name", "next")
    return at_place(suffixes, ahead, F.col("pos") + by).select("doc", "pos", name_of("name.a", "name.b", "next.a", "next.b").alias("name"))


def levels(lines: DataFrame) -> list[DataFrame]:
    """Shared names of 1, 2, 4, ... lines, as far as there are any."""
    found = [materialise(shared(lines.select("doc", "pos", "name")), "line-suffixes")]
    while found[-1].limit(1).count():
        found.append(materialise(shared(doubled(found[-1], 1 << (len(found) - 1))), "line-suffixes"))
    return found[:-1]


def parted(state: DataFrame | None, names: DataFrame, step: int) -> DataFrame:
    """One round: intervals are parted by the next ``step`` lines.

    state: (doc, pos, length, node, own): the suffix is in the interval ``node`` of common ``length``; own marks the row that stands for
    what is known of the suffix itself, others are there to be met. Suffixes without a row of their own are still in the first interval, of
    length 0; only those with a name of ``step`` lines matter now.
    """
    next_name = names.withColumnRenamed("name", "next")
    root = next_name.select(
        "doc", "pos", F.lit(0).cast("long").alias("length"), name_of(F.lit("root")).alias("node"), F.lit(True).alias("own"), "next"
    )
    if state is not None:
        moved = state.where("own").select(F.col("pos").alias("p"))
        root = root.join(moved, F.col("pos") == F.col("p"), "left_anti").unionByName(
            at_place(state, next_name, F.col("pos") + F.col("length"), "left")
        )
    part = name_of("node.a", "node.b", "next.a", "next.b", F.lit(step))
    met = materialise(root.withColumn("part", F.when(F.col("next").isNotNull(), part)).drop("next"), "line-met")
    # a part without a second member moves nothing
    firsts = materialise(
        met.where("part IS NOT NULL").groupBy("part").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("part").alias("of"), "first"),
        "line-firsts",
    )
    joined = met.join(firsts, F.col("part") == F.col("of"), "left").drop("of")
    here = F.struct("length", "node", "own")
    longer = F.struct((F.col("length") + step).cast("long").alias("length"), F.col("part").alias("node"), F.col("own"))
    served = F.struct((F.col("length") + step).cast("long").alias("length"), F.col("part").alias("node"), F.lit(False).alias("own"))
    moves = (
        F.when(F.col("first").isNull(), F.array(here)).when(F.col("pos") == F.col("first"), F.array(here, served)).otherwise(F.array(longer))
    )
    # who stays in the first interval needs no row
    after = materialise(joined.select("doc", "pos", F.inline(moves)).where("length > 0"), "line-state")
    for done in (met, firsts):
        discard(done)
    return after


def earlier_lengths(lines: DataFrame) -> DataFrame:
    """(doc, pos, length): for each suffix the most lines that also start earlier, where there are any. lines: as of ``placed``."""
    names = levels(lines)
    if not names:
        return lines.select("doc", "pos", F.lit(0).cast("long").alias("length")).where("false")
    state = None
    for k in reversed(range(len(names))):
        after = parted(state, names[k], 1 << k)
        for used in [names[k]] * (k > 0) + [state] * (state is not None):
            discard(used)
        state = after
    return state.where("own").select("doc", "pos", "length")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tie, at): the lines, by their number in the text, that later copies of enough words cover."""
    lines = placed(line_rows(docs))
    in_text = W.partitionBy("doc").orderBy("pos")
    upto = lines.select("doc", "pos", F.sum("words").over(in_text).alias("upto"), "words")
    runs = materialise(earlier_lengths(lines), "line-runs")
    begun = at_place(runs, upto.select("doc", "pos", (F.col("upto") - F.col("words")).alias("before")), F.col("pos"))
    ended = at_place(begun, upto.select("doc", "pos", "upto"), F.col("pos") + F.col("length") - 1)
    long_enough = ended.where(F.col("upto") - F.col("before") >= min_words).select("doc", "pos", (F.col("pos") + F.col("length")).alias("end"))
    ends = at_place(lines.select("doc_id", "tie", "at", "doc", "pos"), long_enough, F.col("pos"), "left")
    return ends.withColumn("reach", F.max("end").over(in_text)).where("reach > pos").select("doc_id", "tie", "at")


def with_removed(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs and ``__removed``, the numbers of its lines that are deleted; null if none is."""
    removed = later_copies(docs.select("doc_id", "text"), min_words).groupBy(
        F.col("doc_id").alias("__d"), F.col("tie").alias("__t")
    ).agg(F.collect_set("at").alias("__removed"))
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__t"))
    return docs.join(removed, same, "left").drop("__d", "__t")


def kept_text() -> Column:
    lines = F.filter(
        F.split("text", "\n", -1), lambda line, i: ~F.array_contains(F.col("__removed"), i)
    )
    return F.when(F.col("__removed").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with later copies of line runs cut out of ``text``."""
    rows = with_removed(docs, min_words).withColumn("__kept", kept_text())
    return rows.select(*(F.col("__kept").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))


# Every line of a later copy of ten words and more lies in a window of such words as short as can be from its first line on, or from its last line back.
SQL = r"""
WITH l AS (
  SELECT doc_id, t[p] AS line, p AS pl
  FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS p FROM (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents))
), s AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pl) AS no, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), d AS (SELECT doc_id, list(line ORDER BY no) AS ls, list(pl ORDER BY no) AS pls, list(words ORDER BY no) AS ws FROM s GROUP BY doc_id
), e AS (SELECT doc_id, no, len(ws) AS n, ls, pls, ws FROM s JOIN d USING (doc_id)
), w AS (
  SELECT doc_id, no AS a, (SELECT min(x) FROM (SELECT unnest(range(no, least(n, no + 9) + 1)) AS x) WHERE list_sum(ws[no:x]) >= 10) AS b, ls, pls FROM e
  UNION
  SELECT doc_id, (SELECT max(x) FROM (SELECT unnest(range(greatest(1, no - 9), no + 1)) AS x) WHERE list_sum(ws[x:no]) >= 10), no, ls, pls FROM e
), c AS (
  SELECT doc_id, pls[a:b] AS covered, row_number() OVER (PARTITION BY ls[a:b] ORDER BY doc_id, a) AS copy FROM w WHERE a IS NOT NULL AND b IS NOT NULL
), gone AS (SELECT DISTINCT doc_id, unnest(covered) AS pl FROM c WHERE copy > 1
), r AS (
  SELECT l.doc_id, count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_lines, count(gone.pl) AS n_removed,
         string_agg(line, chr(10) ORDER BY l.pl) FILTER (gone.pl IS NULL) AS kept
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pl = gone.pl GROUP BY l.doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN r USING (doc_id)
"""


@query("op9_line_dedup", SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.length(F.trim(line, F.lit(BLANK))) > 0)
    return with_removed(docs).select(
        "doc_id", F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(F.coalesce(kept_text(), F.lit("")), 256).alias("kept_sha256"),
    )
