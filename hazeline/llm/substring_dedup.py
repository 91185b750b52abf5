"""Removal of long repeated word sequences, by the first rounds of recompression.

Recompression names runs of one token, then pairs of neighbours, over and over. Names depend on content alone, so equal word
sequences get the same symbols in their interior wherever they stand; only symbols at their edges may differ. Here a word's name is a hash
of its bytes, the same on every executor. The first round joins runs of a word; the second and third pair neighbours, of which the left
one's name falls in one half of the names and the right one's in the other, newly drawn each round. Whether two words are parted after that is decided by
the two words on either side, and the eight words around the parting are its name.

Each window of WINDOW words is represented by one parting in its interior, that with the smallest name, or by all its words if
it has none. Equal windows have equal representatives. A representative found once in the corpus is the end of its windows: none of them
is repeated. Only windows of repeated representatives are hashed whole, and of those with one hash the first in the corpus stays. The
words that other windows cover are removed.

Order of documents: by doc_id, null last; different texts under one doc_id follow each other by their hash, and rows of equal
doc_id and text are one document. Windows are judged on the input, not on what is left, and do not cross
documents. A null text has no words; every input row gives one output row; an empty table gives an empty result.
Other columns are not looked at, and ``deduplicated`` passes all of them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from hazeline.llm import words as wd
from hazeline.llm.registry import query, table
from hazeline.llm.stages import discard, materialise, release_shuffles

WINDOW = 20
#: Words on either side of a parting that make up its name.
SIDE = 4
ROUNDS = (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A35)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
LAST_ID = (1 << 63) - 1


def partings(names: np.ndarray) -> np.ndarray:
    """For each word but the first, at its own place, whether it begins a symbol after the rounds."""
    n = len(names)
    parted = np.zeros(n, bool)
    if n < 2:
        return parted
    parted[1:] = names[1:] != names[:-1]  # runs are one symbol
    left, right = names.copy(), names.copy()  # of the symbol that ends with, and of the one that begins with, each word
    for salt in ROUNDS:
        half = wd.mix(left[:-1] ^ np.uint64(salt)) >> np.uint64(63), wd.mix(right[1:] ^ np.uint64(salt)) >> np.uint64(63)
        pair = parted[1:] & (half[0] == 0) & (half[1] == 1)
        name = wd.mix(left[:-1] + right[1:] * np.uint64(wd.ROOT))
        left[1:][pair] = name[pair]
        right[:-1][pair] = name[pair]
        parted[1:] &= ~pair
    return parted


def representatives(hasher: wd.Hasher, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first window, windows) of the representatives of all windows of one document."""
    count = len(names) - WINDOW + 1
    inner = WINDOW - 2 * SIDE + 1
    around = np.full(len(names), NONE)
    keyed = hasher.windows(names, 2 * SIDE)
    around[SIDE : SIDE + len(keyed)] = np.minimum(keyed, NONE - np.uint64(1))
    around[~partings(names)] = NONE
    view = np.lib.stride_tricks.sliding_window_view(around[SIDE : len(names) - SIDE + 1], inner)[:count, ::-1]
    choice = inner - 1 - view.argmin(axis=1) + np.arange(count) + SIDE
    chosen = around[choice]
    bare = chosen == NONE
    if bare.any():
        chosen[bare] = hasher.windows(names, WINDOW)[bare]
        choice[bare] = -1 - np.flatnonzero(bare)
    begin = np.flatnonzero(np.concatenate(([True], choice[1:] != choice[:-1])))
    return chosen[begin], begin, np.diff(np.append(begin, count))


def representative_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = wd.Hasher()
    for rows, texts in wd.text_chunks(batches):
        every, begin = wd.flat([(t or "").encode().split() for t in texts])
        names = hasher.words(every)
        out: list[list[np.ndarray]] = [[], [], [], []]
        columns = rows.column(0).to_pylist(), rows.column(1).to_pylist()
        for doc, base, b, e in zip(*columns, begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            if e - b >= WINDOW:
                name, first, windows = representatives(hasher, names[b:e])
                for column, values in zip(out, (name.view(np.int64), np.full(len(name), doc), first + base, windows), strict=True):
                    column.append(values)
        arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.astype(k.to_pandas_dtype()), k) for a, k in zip(arrays, kinds, strict=True)],
            names=["name", "doc", "first", "windows"],
        )


def within(ranges: list[dict] | None, base: int, count: int) -> np.ndarray:
    """The windows of a document with ``count`` of them that the ranges of its id hold, without ``base``."""
    change = np.zeros(count + 1, np.int64)
    for r in ranges or ():
        low, high = max(0, r["first"] - base), min(count, r["first"] - base + r["windows"])
        if low < high:
            change[low] += 1
            change[high] -= 1
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows of repeated representatives, with their places."""
    hasher = wd.Hasher()
    for rows, texts in wd.text_chunks(batches):
        for doc, base, ranges, text in zip(*(rows.column(i).to_pylist() for i in (0, 1, 3)), texts, strict=True):
            names = hasher.words((text or "").encode().split())
            at = within(ranges, base, max(0, len(names) - WINDOW + 1))
            if len(at):
                one = hasher.windows(names, WINDOW)[at].view(np.int64)
                two = (hasher.windows(wd.mix(names + np.uint64(1)), WINDOW)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(two), pa.array(np.full(len(at), doc)), pa.array(at + base)],
                    names=["one", "two", "doc", "place"],
                )


def kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each document that no later window covers, joined by spaces, and the numbers of words."""
    for rows, texts in wd.text_chunks(batches, "__text"):
        field = {n: rows.column(i) for i, n in enumerate(rows.schema.names)}
        parts = (field[n].to_pylist() for n in ("__base", "__ranges", "__firsts"))
        total, removed, kept = [], [], []
        for base, ranges, firsts, text in zip(*parts, texts, strict=True):
            tokens = (text or "").encode().split()
            count = max(0, len(tokens) - WINDOW + 1)
            later = np.setdiff1d(within(ranges, base, count), np.array(firsts or [], np.int64) - base)
            change = np.zeros(len(tokens) + 1, np.int64)
            change[later] += 1
            np.subtract.at(change, later + WINDOW, 1)
            stays = np.cumsum(change[:-1]) == 0
            total.append(len(tokens))
            removed.append(int(len(tokens) - stays.sum()))
            kept.append(b" ".join(tokens[i] for i in np.flatnonzero(stays).tolist()).decode())
        keep = [n for n in field if n not in ("__base", "__ranges", "__firsts", "__text")]
        yield pa.RecordBatch.from_arrays(
            [*(field[n] for n in keep), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=[*keep, "__n_words", "__n_removed", "__kept"],
        )


def placed(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The named columns, ``__doc``, ``__base`` and ``__text``; a word's place is (__doc, __base + its number).

    Null ids share the largest id. Different texts under one id get bases that keep their places apart.
    """
    tie = F.xxhash64("text")
    known = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.col("doc_id").isNull().alias("no_id"),
        tie.alias("tie"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
    ).distinct()
    several = known.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc")
    before = W.partitionBy("doc").orderBy("no_id", "tie").rowsBetween(W.unboundedPreceding, -1)
    bases = materialise(
        known.join(several, "doc").withColumn("base", F.sum("size").over(before))
        .select(F.col("doc").alias("__d"), F.col("no_id").alias("__n"), F.col("tie").alias("__t"), "base")
        .where("base > 0"),
        "substring-bases",
    )
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    same = (doc == F.col("__d")) & (F.col("doc_id").isNull() == F.col("__n")) & (tie == F.col("__t"))
    return docs.join(bases, same, "left").select(
        *(F.col(f"`{c}`") for c in carry), doc.alias("__doc"), F.coalesce("base", F.lit(0).cast("long")).alias("__base"),
        F.col("text").alias("__text"),
    )


RANGES = "array<struct<first: long, windows: int>>"


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, ranges): the windows whose representative occurs more than once."""
    named = materialise(
        docs.mapInArrow(representative_batches, "name long, doc long, first long, windows int"), "substring-names"
    )
    # written before it is joined, so that Spark can split a name that very many windows share
    shared = materialise(
        named.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "substring-shared"
    )
    release_shuffles(docs.sparkSession)
    ranges = materialise(
        named.join(shared, "name").groupBy("doc").agg(F.collect_list(F.struct("first", "windows")).alias("ranges")),
        "substring-ranges",
    )
    discard(named)
    return ranges


def first_windows(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """(doc, firsts): of the windows in the ranges, those that no equal window precedes."""
    windows = docs.join(ranges, "doc").select("doc", "base", "text", "ranges").mapInArrow(
        window_batches, "one long, two int, doc long, place long"
    )
    return materialise(
        windows.groupBy("one", "two").agg(F.min(F.struct("doc", "place")).alias("w"))
        .groupBy(F.col("w.doc").alias("doc")).agg(F.collect_list("w.place").alias("firsts")),
        "substring-firsts",
    )


def with_kept(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The named columns, ``__n_words``, ``__n_removed`` and ``__kept``, what is left of the text."""
    spark = docs.sparkSession
    rows = placed(docs, carry)
    bare = rows.select(F.col("__doc").alias("doc"), F.col("__base").alias("base"), F.col("__text").alias("text"))
    ranges = repeated_ranges(bare)
    release_shuffles(spark)
    firsts = first_windows(bare, ranges)
    release_shuffles(spark)
    found = ranges.join(firsts, "doc", "left").select(
        F.col("doc").alias("__d"), F.col("ranges").alias("__ranges"), F.col("firsts").alias("__firsts")
    )
    fields = [docs.schema[c] for c in carry] + T.StructType.fromDDL("__n_words long, __n_removed long, __kept string").fields
    return rows.join(found, F.col("__doc") == F.col("__d"), "left").drop("__doc", "__d").mapInArrow(
        kept_batches, T.StructType(fields)
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with the words of later windows cut out; texts that lose none stay as they are."""
    rows = with_kept(docs, docs.columns)
    text = F.when(F.col("__n_removed") > 0, F.col("__kept")).otherwise(F.col("text"))
    return rows.select(*(text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS p FROM d)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS copy FROM win) WHERE copy > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM later
), word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS x FROM d
), kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(x, ' ' ORDER BY q) AS t FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op4_substring_dedup", SQL)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_kept(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )
