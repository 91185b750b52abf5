"""Benchmark decontamination by winnowing.

Texts become lower-case words. Of every GUARD consecutive GRAM-word hashes the smallest is kept as a fingerprint (the last
one of equals), on both sides alike, so a span of GRAM + GUARD - 1 = 10 shared words has at least one fingerprint in common.
Documents and benchmark are joined on fingerprints, and each hit is extended word by word to both sides: the run of equal
words around it, at most up to the reach of a ten-word window, is contamination if it holds ten words.
An item of fewer than ten words is one window of its own length; for each such length that occurs, documents are hashed at that
length at every place.

A document's fingerprints leave its task only if they pass a bitmap of the benchmark's fingerprints. The bitmap has a
fixed number of bits (a megabyte) however large the benchmark is; a full bitmap lets more through and loses nothing, because
the join and the word by word comparison decide.

Nulls and odd rows: a null text has no words; an item without words has no window; item ids that repeat count as one item;
a null item id is listed as an empty string; every document row gives one output row; empty tables give
no hits or no rows. Other columns are not looked at, and ``clean_documents`` passes all of them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import words as wd
from hazeline.llm.registry import query, table
from hazeline.llm.stages import materialise

WINDOW = 10
GRAM = 5
GUARD = WINDOW - GRAM + 1
#: Bits of the bitmap of benchmark fingerprints: Spark's bitmap functions use buckets of 32768 bits.
BUCKET_BITS = 32_768
BUCKETS = 256

FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


#: Kind of the fingerprints of whole ten-word windows; short items have their number of words as kind.
LONG = 0


def selected(hashes: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Those of the places ``at`` that winnowing keeps; the text of each has its windows at first..last.

    A place is the choice of some group of GUARD windows if the windows with no smaller hash just before it and those
    with a larger hash just after it make up such a group.
    """
    own, room = hashes[at], np.ones(len(at), np.int64)
    for side in (-1, 1):
        going = np.ones(len(at), bool)
        for step in range(1, GUARD):
            near = at + side * step
            going &= (near >= first) & (near <= last)
            other = hashes[near[going]]
            going[going] = other >= own[going] if side < 0 else other > own[going]
            room += going
    return at[room >= GUARD]


def context(tokens: list[bytes], at: int, kind: int) -> tuple[int, str]:
    """The words a hit can be extended over, and the place of the fingerprint in them."""
    begin, end = (max(0, at - GUARD + 1), at + WINDOW) if kind == LONG else (at, at + kind)
    return at - begin, b" ".join(tokens[begin:end]).decode()


def item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each fingerprint of an item, with the words that a hit is extended over."""
    hasher = wd.Hasher()
    types = (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string())
    for rows, texts in wd.text_chunks(batches):
        out = []
        for item, text in zip(rows.column(0).to_pylist(), texts, strict=True):
            tokens = text_words(text)
            kind = len(tokens) if len(tokens) < WINDOW else LONG
            hashes = hasher.windows(hasher.words(tokens), kind or GRAM) if tokens else np.zeros(0, np.uint64)
            at = np.arange(len(hashes))
            if kind == LONG:
                at = selected(hashes, at, 0 * at, 0 * at + len(hashes) - 1)
            for p in at.tolist():
                out.append((item or "", kind, int(hashes[p].view(np.int64)), *context(tokens, p, kind)))
        columns = list(zip(*out, strict=True)) if out else [()] * len(types)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["item", "kind", "hash", "item_before", "item_words"],
        )


def item_fingerprints(benchmark: DataFrame) -> DataFrame:
    schema = "item string, kind int, hash long, item_before int, item_words string"
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(item_batches, schema)
    return rows.distinct()


def bitmap_of(prints: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The fingerprints as bits, and the kinds that occur; at most a megabyte and ten numbers come to the driver."""
    bit = F.pmod("hash", F.lit(BUCKET_BITS * BUCKETS))
    rows = (
        prints.select(F.floor(bit / BUCKET_BITS).alias("bucket"), F.pmod(bit, F.lit(BUCKET_BITS)).alias("bit"), "kind")
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"), F.collect_set("kind").alias("kinds"))
        .collect()
    )
    bits = np.zeros((BUCKETS, BUCKET_BITS // 8), np.uint8)
    for r in rows:
        bits[r.bucket] = np.frombuffer(bytes(r.bits), np.uint8)
    return bits.reshape(-1), sorted({k for r in rows for k in r.kinds})


def hit_batches(bits: np.ndarray, kinds: list[int]):
    hit_type = pa.list_(pa.struct([
        ("kind", pa.int32()), ("hash", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("words", pa.string()),
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = wd.Hasher()
        for rows, texts in wd.text_chunks(batches, "__text"):
            tokens = [text_words(t) for t in texts]
            every, begin = wd.flat(tokens)
            names, doc = hasher.words(every), wd.owners(begin)
            hits: list[list] = [[] for _ in texts]
            for kind in kinds:
                k = kind or GRAM
                hashes = hasher.windows(names, k)
                bit = (hashes % np.uint64(BUCKET_BITS * BUCKETS)).astype(np.int64)
                passed = (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
                at = np.flatnonzero(passed & (doc[: len(hashes)] == doc[k - 1 :]))
                if kind == LONG:
                    at = selected(hashes, at, begin[doc[at]], begin[doc[at] + 1] - k)
                for p in at.tolist():
                    d = doc[p]
                    place = int(p - begin[d])
                    before, words = context(tokens[d], place, kind)
                    hits[d].append({
                        "kind": kind, "hash": int(hashes[p].view(np.int64)), "at": place, "before": before, "words": words,
                    })
            keep = [n for n in rows.schema.names if n != "__text"]
            columns = [rows.column(rows.schema.get_field_index(n)) for n in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(begin)), pa.array(hits, hit_type)], names=[*keep, "__n_words", "__hits"],
            )

    return run


HITS = "array<struct<kind: int, hash: long, at: long, before: int, words: string>>"


def with_hits(docs: DataFrame, carry: list[str], prints: DataFrame) -> DataFrame:
    """The named columns, ``__row``, ``__n_words`` and the fingerprints that may be the benchmark's; written once."""
    bits, kinds = bitmap_of(prints)
    given = docs.select(
        *(F.col(f"`{c}`") for c in carry), F.col("text").alias("__text"), F.monotonically_increasing_id().alias("__row"),
    )
    schema = T.StructType(
        [docs.schema[c] for c in carry]
        + T.StructType.fromDDL(f"__row long, __n_words long, __hits {HITS}").fields
    )
    return materialise(given.mapInArrow(hit_batches(bits, kinds), schema), "leak-hits")


def extend_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The run of equal words around each hit, if it holds a whole window."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            mine, theirs = r["words"].split(" "), r["item_words"].split(" ")
            shift = r["item_before"] - r["before"]
            least = r["kind"] or WINDOW
            anchor = r["before"]
            low = high = anchor
            while low > 0 and low + shift > 0 and mine[low - 1] == theirs[low + shift - 1]:
                low -= 1
            while high < len(mine) and high + shift < len(theirs) and mine[high] == theirs[high + shift]:
                high += 1
            if high - low >= least:
                begin = r["at"] + low - anchor
                out.append((r["__row"], r["item"], begin, begin + high - low))
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["__row", "item", "begin", "end"],
        )


def contaminated_spans(hits: DataFrame, prints: DataFrame) -> DataFrame:
    """(__row, item, begin, end): word ranges of a document that are windows of an item; ranges may overlap."""
    met = (
        hits.select("__row", F.inline("__hits")).join(prints, ["kind", "hash"])
        .select("__row", "at", "before", "words", "kind", "item", "item_before", "item_words")
    )
    return met.mapInArrow(extend_batches, "__row long, item string, begin long, end long").distinct()


def by_document(spans: DataFrame) -> DataFrame:
    """(__row, __n_hit, __items): words inside any range, and the item ids in order."""
    ranges = F.array_sort(F.collect_set(F.struct("begin", "end")))
    joined = F.aggregate(
        F.col("ranges"),
        F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda acc, r: F.struct(
            F.greatest(acc["upto"], r["end"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), r["end"] - F.greatest(acc["upto"], r["begin"]))).alias("n"),
        ),
    )
    return (
        spans.groupBy("__row")
        .agg(ranges.alias("ranges"), F.array_sort(F.collect_set("item")).alias("__items"))
        .select("__row", joined["n"].alias("__n_hit"), "__items")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a window of the benchmark, with their columns."""
    prints = materialise(item_fingerprints(benchmark), "leak-items")
    hits = with_hits(docs, docs.columns, prints)
    dirty = contaminated_spans(hits, prints).select("__row").distinct()
    return hits.join(dirty, "__row", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS p
        FROM d, (SELECT DISTINCT k FROM iw) ks)
), hit AS (SELECT doc_id, item, p, k FROM dw JOIN iw USING (k, g)
), n AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM hit)) GROUP BY doc_id
), i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query("op3_decontaminate", SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = materialise(item_fingerprints(table(spark, sf_dir, "benchmark")), "leak-items")
    hits = with_hits(table(spark, sf_dir, "documents"), ["doc_id"], prints)
    found = by_document(contaminated_spans(hits, prints))
    n_hit = F.coalesce("__n_hit", F.lit(0).cast("long"))
    items = F.coalesce("__items", F.array().cast("array<string>"))
    return hits.join(found, "__row", "left").select(
        "doc_id", F.col("__n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
