"""Quality rules with thresholds that follow the corpus.

Per document a few counts are taken from the whole text. Fixed base rules remove documents that are too short or repeat
themselves; the other rules compare three measures with fences around the quartiles of the document's own language and
source. The quartiles come from mergeable sketches: a row per (language, source, measure, bin) with its count, where bins
are the integers cut to their seven leading bits. Adding counts merges sketches exactly, in any order, so reruns agree;
a bin's relative error is below 1/64. A group with few documents uses the merged sketch of its language, a language with
few documents that of all.

Nulls and odd rows: a null text has no words and fails the base rules; null languages and sources are groups of their own;
every input row gives one output row, so repeated rows repeat; an empty table gives an empty result. Columns beside
doc_id, text, lang and source are not looked at by ``measured``, and ``kept_documents`` passes all of them on, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from hazeline.llm import words as wd
from hazeline.llm.registry import query, table
from hazeline.llm.stages import materialise

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
#: Documents that a group needs for thresholds of its own.
MIN_GROUP = 50
#: Fences lie this many interquartile ranges beyond the quartiles.
REACH = 3
#: and this part of the upper quartile, so that groups of nearly equal values keep their like.
NEAR = 4


@dataclass(frozen=True)
class Measure:
    """``scale * top / bottom`` as a whole number; slack is what a single odd line or word may add in a short text."""

    name: str
    top: str
    bottom: str
    scale: int
    slack: int
    low_side: bool = False


MEASURES = (
    Measure("symbols", "n_symbols", "word_chars", 1000, 20),
    Measure("dup_lines", "n_dup_lines", "n_lines", 1000, 500),
    Measure("word_length", "word_chars", "n_words", 100, 300, low_side=True),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def text_counts(texts: list[str | None], hasher: wd.Hasher) -> dict[str, np.ndarray]:
    raw = [(t or "").encode() for t in texts]
    tokens = [t.split() for t in raw]
    flat, begin = wd.flat(tokens)
    out = {name: np.zeros(len(texts), np.int64) for name in COUNTS}
    out["n_words"] = np.diff(begin)
    for i, (data, own) in enumerate(zip(raw, tokens, strict=True)):
        # UTF-8 continuation bytes do not begin a character
        joined = np.frombuffer(b"".join(own), np.uint8)
        out["word_chars"][i] = len(joined) - np.count_nonzero((joined & 0xC0) == 0x80)
        out["n_symbols"][i] = len(data) - len(data.translate(None, SYMBOLS))
        lines = [line for line in data.split(b"\n") if line and not line.isspace()]
        out["n_lines"][i] = len(lines)
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
    k = REPEAT_WINDOW
    window = hasher.windows(hasher.words(flat), k)
    if len(window):
        doc = wd.owners(begin)
        at = np.flatnonzero(doc[: len(window)] == doc[k - 1 :])
        order = at[np.lexsort((window[at], doc[at]))]
        same = (window[order][1:] == window[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = order[twice]
        change = np.zeros(len(flat) + 1, np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + k, -1)
        covered = np.concatenate(([0], np.cumsum(np.cumsum(change[:-1]) > 0)))
        out["n_repeat_words"] = covered[begin[1:]] - covered[begin[:-1]]
    return out


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = wd.Hasher()
    for rows, texts in wd.text_chunks(batches, "__text"):
        counts = text_counts(texts, hasher)
        keep = [n for n in rows.schema.names if n != "__text"]
        columns = [rows.column(rows.schema.get_field_index(n)) for n in keep]
        yield pa.RecordBatch.from_arrays(
            [*columns, *(pa.array(counts[n]) for n in COUNTS)], names=[*keep, *(f"__{n}" for n in COUNTS)],
        )


def measured(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The named columns of docs and the counts of each text, as ``__n_words`` and so on."""
    given = docs.select(*(F.col(f"`{c}`") for c in carry), F.col("text").alias("__text"))
    fields = [docs.schema[c] for c in carry] + [T.StructField(f"__{n}", T.LongType()) for n in COUNTS]
    return given.mapInArrow(count_batches, T.StructType(fields))


def base_failed() -> F.Column:
    return (F.col("__n_words") < MIN_WORDS) | (
        100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n_words")
    )


def measure_value(m: Measure) -> F.Column:
    """Null where there is nothing to divide by."""
    return F.expr(f"IF(__{m.bottom} > 0, {m.scale} * __{m.top} DIV __{m.bottom}, NULL)")


def bin_edge(column: str) -> F.Column:
    """The largest whole number with the same seven leading bits."""
    shift = f"GREATEST(LENGTH(BIN({column})) - 7, 0)"
    return F.expr(f"SHIFTLEFT(SHIFTRIGHT({column}, {shift}) + 1, {shift}) - 1")


def quantile_sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, measure, edge, n) over the documents that pass the base rules."""
    pairs = F.array(*(F.struct(F.lit(m.name).alias("measure"), measure_value(m).alias("value")) for m in MEASURES))
    return (
        counts.where(~base_failed())
        .select("lang", "source", F.explode(pairs).alias("p"))
        .where("p.value IS NOT NULL")
        .select("lang", "source", F.col("p.measure").alias("measure"), F.col("p.value").alias("value"))
        .groupBy("lang", "source", "measure", bin_edge("value").alias("edge"))
        .agg(F.count("*").alias("n"))
    )


def adaptive_thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, measure, low, high), from the group's sketch or the first wider one that is large enough."""
    def level(number: int, lang: F.Column, source: F.Column) -> F.Column:
        return F.struct(F.lit(number).alias("level"), lang.alias("l"), source.alias("s"))

    nothing = F.lit(None).cast("string")
    levels = F.array(
        level(0, F.col("lang"), F.col("source")), level(1, F.col("lang"), nothing), level(2, nothing, nothing)
    )
    key = ["level", "l", "s", "measure"]
    merged = (
        sketches.select(F.inline(levels), "measure", "edge", "n")
        .groupBy(*key, "edge").agg(F.sum("n").alias("n"))
    )
    upto = W.partitionBy(*key).orderBy("edge").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*key)
    quartiles = (
        merged.withColumns({"below": F.sum("n").over(upto), "size": F.sum("n").over(whole)})
        .groupBy(*key)
        .agg(
            F.max("size").alias("size"),
            F.min(F.when(4 * F.col("below") >= F.col("size"), F.col("edge"))).alias("q1"),
            F.min(F.when(4 * F.col("below") >= 3 * F.col("size"), F.col("edge"))).alias("q3"),
        )
    )
    slack = F.create_map(*(F.lit(x) for m in MEASURES for x in (m.name, m.slack)))[F.col("measure")]
    spread = REACH * (F.col("q3") - F.col("q1")) + F.expr(f"q3 DIV {NEAR}") + slack
    fences = quartiles.select(*key, "size", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))
    own = fences.where("level = 0").select(
        F.col("l").alias("lang"), F.col("s").alias("source"), "measure",
        F.col("size").alias("size0"), F.struct("low", "high").alias("f0"),
    )
    of_lang = fences.where("level = 1").select(
        F.col("l").alias("lang1"), F.col("measure").alias("measure1"), F.col("size").alias("size1"),
        F.struct("low", "high").alias("f1"),
    )
    of_all = fences.where("level = 2").select(F.col("measure").alias("measure2"), F.struct("low", "high").alias("f2"))
    chosen = F.when(F.col("size0") >= MIN_GROUP, F.col("f0")).when(F.col("size1") >= MIN_GROUP, F.col("f1")).otherwise(
        F.col("f2")
    )
    return (
        own.join(of_lang, F.col("lang").eqNullSafe(F.col("lang1")) & (F.col("measure") == F.col("measure1")))
        .join(of_all, F.col("measure") == F.col("measure2"))
        .select("lang", "source", "measure", chosen.alias("f"))
        .select("lang", "source", "measure", "f.low", "f.high")
    )


def with_verdict(counts: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Adds ``__base_failed`` and ``__kept``; counts needs columns lang and source."""
    columns = []
    for m in MEASURES:
        mine = F.col("measure") == m.name
        columns.append(F.max(F.when(mine, F.col("high"))).alias(f"__{m.name}_high"))
        columns.append(F.max(F.when(mine, F.col("low"))).alias(f"__{m.name}_low"))
    # written before it is joined: Spark then knows that it is small and need not shuffle the documents, or can split a hot group
    wide = materialise(
        thresholds.groupBy(F.col("lang").alias("__lang"), F.col("source").alias("__source")).agg(*columns),
        "quality-thresholds",
    )
    ok = F.lit(True)
    for m in MEASURES:
        value = measure_value(m)
        ok &= F.coalesce(value <= F.col(f"__{m.name}_high"), F.lit(True))
        if m.low_side:
            ok &= F.coalesce(value >= F.col(f"__{m.name}_low"), F.lit(True))
    joined = counts.join(
        wide,
        counts["lang"].eqNullSafe(F.col("__lang")) & counts["source"].eqNullSafe(F.col("__source")),
        "left",
    )
    failed = base_failed()
    return joined.withColumns({"__base_failed": failed, "__kept": ~failed & ok}).drop("__lang", "__source")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass all rules, with their columns.

    The texts are read twice, once for the sketches and once for the verdict, so that they are never shuffled.
    """
    sketches = materialise(quantile_sketches(measured(docs, ["lang", "source"])), "quality-sketches")
    thresholds = adaptive_thresholds(sketches)
    return with_verdict(measured(docs, docs.columns), thresholds).where("__kept").select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), win AS (
  SELECT doc_id, p, array_to_string(w[p:p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS p FROM d)
), twice AS (
  SELECT doc_id, unnest(range(p, p + 5)) AS q
  FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM twice GROUP BY doc_id
), f AS (
  SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)
), v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars END AS symbols,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines END AS dup_lines,
         CASE WHEN n_words > 0 THEN 100 * word_chars // n_words END AS word_length FROM f
), long AS (
  SELECT lang, source, m.k AS measure, m.x AS x, greatest(length(bin(m.x)) - 7, 0) AS s FROM (
    SELECT lang, source, unnest([{'k': 'symbols', 'x': symbols}, {'k': 'dup_lines', 'x': dup_lines},
                                 {'k': 'word_length', 'x': word_length}]) AS m
    FROM v WHERE NOT base_failed) WHERE m.x IS NOT NULL
), bins AS (
  SELECT lvl.l AS level, CASE WHEN lvl.l < 2 THEN lang END AS l, CASE WHEN lvl.l = 0 THEN source END AS s, measure,
         (((x >> s) + 1) << s) - 1 AS edge, count(*) AS n
  FROM long, (SELECT unnest([0, 1, 2]) AS l) lvl GROUP BY ALL
), cum AS (
  SELECT *, sum(n) OVER (PARTITION BY level, l, s, measure ORDER BY edge) AS below,
         sum(n) OVER (PARTITION BY level, l, s, measure) AS size FROM bins
), q AS (
  SELECT level, l, s, measure, max(size) AS size, min(edge) FILTER (4 * below >= size) AS q1,
         min(edge) FILTER (4 * below >= 3 * size) AS q3 FROM cum GROUP BY ALL
), fence AS (
  SELECT *, q1 - 3 * (q3 - q1) - q3 // 4 - slack AS low, q3 + 3 * (q3 - q1) + q3 // 4 + slack AS high
  FROM q JOIN (VALUES ('symbols', 20), ('dup_lines', 500), ('word_length', 300)) sl(measure, slack) USING (measure)
), pick AS (
  SELECT a.l AS lang, a.s AS source, a.measure,
         CASE WHEN a.size >= 50 THEN a.low WHEN b.size >= 50 THEN b.low ELSE c.low END AS low,
         CASE WHEN a.size >= 50 THEN a.high WHEN b.size >= 50 THEN b.high ELSE c.high END AS high
  FROM fence a JOIN fence b ON b.level = 1 AND a.l IS NOT DISTINCT FROM b.l AND a.measure = b.measure
  JOIN fence c ON c.level = 2 AND a.measure = c.measure WHERE a.level = 0
), wide AS (
  SELECT lang, source, max(high) FILTER (measure = 'symbols') AS sh, max(high) FILTER (measure = 'dup_lines') AS dh,
         max(high) FILTER (measure = 'word_length') AS wh, max(low) FILTER (measure = 'word_length') AS wl
  FROM pick GROUP BY ALL
)
SELECT v.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbols <= sh, true) AND coalesce(dup_lines <= dh, true)
       AND coalesce(word_length <= wh, true) AND coalesce(word_length >= wl, true) AS kept
FROM v LEFT JOIN wide ON v.lang IS NOT DISTINCT FROM wide.lang AND v.source IS NOT DISTINCT FROM wide.source
"""


@query("op7_quality_rules", SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialise(measured(table(spark, sf_dir, "documents"), ["doc_id", "lang", "source"]), "quality-counts")
    verdict = with_verdict(counts, adaptive_thresholds(quantile_sketches(counts)))
    return verdict.select(
        "doc_id",
        *(F.col(f"__{n}").alias(n) for n in COUNTS if n != "n_lines"),
        F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"),
    )
