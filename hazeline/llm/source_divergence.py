"""How the sources of a language differ in their words, by iceberg prefix refinement.

Each language keeps the terms that stand in at least MIN_DOCS of its documents. They are found level by level: at a level of L bytes every
document counts once for each distinct L-byte prefix of its terms, and prefixes that fewer documents hold are discarded; no term that
begins with one can be frequent. The next level extends only what is left, to twice as many bytes. A term of at most L bytes is complete at
its level and counted there, by source, with its occurrences. The refinement ends when no longer term is left under a surviving prefix, so the
number of levels grows with the logarithm of the longest frequent prefix. Complete terms below the threshold go last.

Inside a task prefixes are 64-bit hashes of language and bytes, found for all terms of a run of texts at once, and only hashes and numbers are
sent. The prefixes that survive a level reach the tasks of the next one as a bitmap of a fixed size (BUCKETS * 4 KB) whatever their
number, and so do the complete terms that do. A last pass counts the terms of this bitmap by source, now with their bytes, and the threshold is
applied again to the exact counts: a hash that two prefixes share, in the bitmap or before it, lets something through and changes nothing.
Tasks add up their counts before they send them, in memory of a bounded size.

A group, that is a source inside a language, and the language itself give every kept term the smoothed share ``share_of``, in exact decimal
arithmetic. Distances between sources are sums over all kept terms. A block of terms and a tile of sources is one small matrix inside a task,
and a block sends one partial sum for each pair of sources, not a row for each pair and term. Terms that neither of two sources holds are not
in these matrices; each adds the same amount, which is multiplied by their number.

Nulls and odd rows: null text, language and source are read as empty strings; a row is a document, so repeated rows count again, whatever their
doc_id; a group without terms has all its shares at the smoothed zero; a language without kept terms has distances of 0 and no term rows; an
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hazeline.llm import words as wd
from hazeline.llm.registry import query, table
from hazeline.llm.stages import materialise

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTH = 5
#: Bytes of the prefixes of the first level; each further level has twice as many.
FIRST_LEVEL = 6
#: Bits of the bitmap of surviving prefixes: Spark's bitmap functions use buckets of 32768 bits.
BUCKET_BITS = 32_768
BUCKETS = 1024
#: Counters a task holds before it adds them up and sends them.
HELD = 250_000
#: Terms in a block and sources in a tile of the distance matrices.
BLOCK_TERMS = 2048
TILE = 64

#: A-Z to a-z; bytes of letters and of other scripts stay; all else parts terms.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class Terms:
    """The terms of a run of texts: where they begin in ``data``, their bytes and text numbers, and hashes of their prefixes."""

    def __init__(self, texts: list[str | None], hasher: wd.Hasher):
        folded = [(t or "").encode().translate(FOLD) for t in texts]
        self.data = np.frombuffer(b" ".join(folded) + b" ", np.uint8)
        inside = np.concatenate(([False], self.data != 32))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start = edge[::2] if len(edge) % 2 == 0 else edge[: len(edge) - 1 : 2]
        self.size = edge[1::2] - self.start
        begin = np.cumsum([0] + [len(f) + 1 for f in folded])
        self.text = np.searchsorted(begin, self.start, side="right") - 1
        up, self.down = hasher.powers.to(len(self.data) + 1)
        self.total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(hasher.table[self.data] * up[:-1], out=self.total[1:])

    def hashes(self, salt: np.ndarray, pick: np.ndarray, length: int | None = None) -> np.ndarray:
        """Of the first bytes of the picked terms, or of all of them; the text's salt goes in."""
        start, size = self.start[pick], self.size[pick]
        size = size if length is None else np.minimum(size, length)
        value = wd.mix((self.total[start + size] - self.total[start]) * self.down[start] + size.astype(np.uint64))
        return wd.mix(value ^ salt[self.text[pick]])

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.size[i]].tobytes()


def salts(languages: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(lang.encode()) for lang in languages), np.uint64, len(languages))


def bit_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKET_BITS * BUCKETS)).astype(np.int64)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = bit_of(hashes)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def by_hash(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash and text number, and where in it a new pair of them begins; terms come in the order of texts."""
    order = np.argsort(hashes, kind="stable")
    hashes, text = hashes[order], text[order]
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))[: len(hashes)]
    return order, np.flatnonzero(fresh)


def distinct_texts(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash with its number of different texts."""
    order, first = by_hash(hashes, text)
    once = hashes[order[first]]
    change = np.flatnonzero(np.append(True, once[1:] != once[:-1])[: len(once)])
    return once[change], np.diff(np.append(change, len(once)))


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of numbers by hash."""
    hashes, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    found, at = np.unique(hashes, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def level_batches(before: int, length: int, bits: np.ndarray | None):
    """(hash, complete, docs) of one level: prefixes of longer terms, and terms that end on it."""

    def sent(complete: bool, parts: list) -> pa.RecordBatch:
        hashes, docs = added(parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(np.full(len(hashes), complete)), pa.array(docs)],
            names=["hash", "complete", "docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = wd.Hasher()
        held: dict[bool, list] = {False: [], True: []}
        size = 0
        for rows, texts in wd.text_chunks(batches):
            terms, salt = Terms(texts, hasher), salts(rows.column(0).to_pylist())
            alive = np.flatnonzero(terms.size > before)
            if bits is not None:
                alive = alive[in_bitmap(bits, terms.hashes(salt, alive, before))]
            for complete in held:
                own = alive[(terms.size[alive] <= length) == complete]
                held[complete].append(distinct_texts(terms.hashes(salt, own, length), terms.text[own]))
                size += len(held[complete][-1][0])
            if size > HELD:
                for complete, parts in held.items():
                    yield sent(complete, parts)
                held, size = {False: [], True: []}, 0
        for complete, parts in held.items():
            if parts:
                yield sent(complete, parts)

    return run


def use_batches(bits: np.ndarray):
    """(lang, source, term, docs, uses) of the terms in the bitmap."""

    def sent(groups: dict, names: dict, parts: list) -> pa.RecordBatch:
        group, hashes, docs, uses = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((hashes, group))
        group, hashes = group[order], hashes[order]
        first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (hashes[1:] != hashes[:-1]))[: len(group)])
        listed = list(groups)
        totals = [np.add.reduceat(x[order], first) if len(first) else x for x in (docs, uses)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([listed[g][0] for g in group[first].tolist()], pa.string()),
                pa.array([listed[g][1] for g in group[first].tolist()], pa.string()),
                pa.array([names[h] for h in hashes[first].tolist()], pa.binary()), *map(pa.array, totals),
            ],
            names=["lang", "source", "term", "docs", "uses"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = wd.Hasher()
        groups, names, parts, size = {}, {}, [], 0
        for rows, texts in wd.text_chunks(batches):
            languages, sources = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            own = np.array([groups.setdefault(g, len(groups)) for g in zip(languages, sources, strict=True)])
            terms, salt = Terms(texts, hasher), salts(languages)
            pick = np.arange(len(terms.size))
            hashes = terms.hashes(salt, pick)
            kept = in_bitmap(bits, hashes)
            pick, hashes = pick[kept], hashes[kept]
            order, first = by_hash(hashes, terms.text[pick])
            uses = np.diff(np.append(first, len(pick)))
            pick, hashes = pick[order[first]], hashes[order[first]]
            group = own[terms.text[pick]]
            # one row for each term and group of the run
            order = np.lexsort((group, hashes))
            pick, hashes, group, uses = pick[order], hashes[order], group[order], uses[order]
            first = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (group[1:] != group[:-1]))[: len(pick)])
            if len(first):
                docs = np.diff(np.append(first, len(pick)))
                parts.append((group[first], hashes[first], docs, np.add.reduceat(uses, first)))
                for h, i in zip(hashes[first].tolist(), pick[first].tolist(), strict=True):
                    if h not in names:
                        names[h] = terms.bytes_of(i)
                size += len(first)
            if size > HELD:
                yield sent(groups, names, parts)
                groups, names, parts, size = {}, {}, [], 0
        if parts:
            yield sent(groups, names, parts)

    return run


def bitmap_of(hashes: DataFrame) -> np.ndarray | None:
    """The hashes as bits, at most BUCKETS * 4 KB; None if there is none."""
    bit = F.pmod("hash", F.lit(BUCKET_BITS * BUCKETS))
    rows = (
        hashes.select(F.floor(bit / BUCKET_BITS).alias("bucket"), F.pmod(bit, F.lit(BUCKET_BITS)).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    bits = np.zeros((BUCKETS, BUCKET_BITS // 8), np.uint8)
    for r in rows:
        bits[r.bucket] = np.frombuffer(bytes(r.bits), np.uint8)
    return bits.reshape(-1) if rows else None


def named_groups(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, uses): occurrences, by source, of the terms that enough documents of the language hold."""
    given = named_groups(docs)
    kept, before, length, bits = None, 0, FIRST_LEVEL, None
    while True:
        counted = given.select("lang", "text").mapInArrow(
            level_batches(before, length, bits), "hash long, complete boolean, docs long"
        )
        level = materialise(
            counted.groupBy("hash", "complete").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs),
            "divergence-level",
        )
        ended = bitmap_of(level.where("complete"))
        if ended is not None:
            kept = ended if kept is None else kept | ended
        bits = bitmap_of(level.where("NOT complete"))
        if bits is None:
            break
        before, length = length, 2 * length
    schema = "lang string, source string, term binary, docs long, uses long"
    empty = np.zeros(BUCKETS * BUCKET_BITS // 8, np.uint8)
    counted = given.mapInArrow(use_batches(empty if kept is None else kept), schema)
    by_source = materialise(
        counted.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("uses").alias("uses")), "divergence-uses"
    )
    enough = materialise(
        by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term"),
        "divergence-kept",
    )
    return by_source.join(enough, ["lang", "term"]).select("lang", "source", F.decode("term", "UTF-8").alias("term"), "uses")


def share_of(uses: Column | str, total: Column | str, kept: Column | str) -> Column:
    """``1 + floor(SCALE * (uses + SMOOTH) / (total + SMOOTH * kept))`` without rounding, for counts of up to 18 digits.

    In whole numbers of 64 bits where the product fits, in decimals beyond.
    """
    u, n, v = (F.col(x) if isinstance(x, str) else x for x in (uses, total, kept))
    below = n + v * SMOOTH
    plain = F.call_function("div", (u + SMOOTH).cast("long") * F.lit(SCALE), below)
    exact = F.call_function(
        "div", (u + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), below.cast("decimal(20,0)")
    )
    return F.lit(1).cast("long") + F.when(u < (2**63 - 1) // SCALE - SMOOTH, plain).otherwise(exact)


class Shares:
    """The written tables that both parts of the report read."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        self.counts = materialise(kept_counts(docs, min_docs), "divergence-counts")
        by_term = self.counts.groupBy("lang", "term").agg(F.sum("uses").alias("all_uses"))
        self.terms = materialise(by_term, "divergence-by-term")
        size = self.terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_uses").alias("lang_total"))
        total = self.counts.groupBy("lang", "source").agg(F.sum("uses").alias("total"))
        # a source is numbered inside its language; there are as many rows as groups
        groups = (
            named_groups(docs).select("lang", "source").distinct()
            .join(total, ["lang", "source"], "left").join(size, "lang", "left")
            .select(
                "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"),
                F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
            )
            .withColumn("no", F.row_number().over(W.partitionBy("lang").orderBy("source")).cast("long") - 1)
            .withColumn("base", F.when(F.col("kept") > 0, share_of(F.lit(0), "total", "kept")))
        )
        self.groups = materialise(groups, "divergence-groups")


def block_sums(rows: pa.Table) -> pa.Table:
    """Distances of the sources of two tiles over the terms of one block that any of them holds."""
    held = rows["term"].is_valid().to_numpy()
    number, low, high = (rows[c].to_numpy() for c in ("no", "low", "high"))
    order = np.argsort(number[~held])
    no, base = number[~held][order], rows["base"].to_numpy()[~held][order]
    terms = rows.filter(rows["term"].is_valid())
    coded = terms["term"].combine_chunks().dictionary_encode()
    shares = np.repeat(base[:, None], len(coded.dictionary), axis=1)
    shares[np.searchsorted(no, terms["no"].to_numpy()), coded.indices.to_numpy()] = terms["share"].to_numpy()
    first, second, value = [], [], []
    for i in np.flatnonzero(no // TILE == low[0]):
        other = np.flatnonzero((no // TILE == high[0]) & (no > no[i]))
        first.append(np.full(len(other), no[i]))
        second.append(no[other])
        value.append(np.abs(shares[other] - shares[i]).sum(axis=1))
    size = sum(map(len, first))
    return pa.table({
        "lang": pa.array([rows["lang"][0].as_py()] * size, pa.string()),
        "a": np.concatenate(first), "b": np.concatenate(second), "value": np.concatenate(value),
        "terms": np.full(size, len(coded.dictionary)),
    })


def distances(s: Shares) -> DataFrame:
    """(lang, a, b, value): for the source numbers a < b of a language the sum over all kept terms."""
    groups = s.groups.where("kept > 0")
    in_lang = groups.groupBy("lang").agg(F.expr(f"MAX(no) DIV {TILE}").alias("last_tile"))
    groups = groups.join(in_lang, "lang")
    mine, last = F.expr(f"no DIV {TILE}"), F.col("last_tile")
    # the pairs of tiles that a source is part of
    tiles = F.transform(
        F.sequence(F.lit(0).cast("long"), last),
        lambda t: F.struct(F.least(t, mine).alias("low"), F.greatest(t, mine).alias("high")),
    )
    blocks = F.expr(f"(kept + {BLOCK_TERMS - 1}) DIV {BLOCK_TERMS}")
    wanted = ["lang", "no", "block", "low", "high", "base", "term", "share"]
    bases = (
        groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .select("*", F.inline(tiles))
        .withColumns({"term": F.lit(None).cast("string"), "share": F.lit(None).cast("long")})
        .select(wanted)
    )
    used = (
        s.counts.join(groups, ["lang", "source"])
        .withColumns({"block": F.pmod(F.xxhash64("term"), blocks), "share": share_of("uses", "total", "kept")})
        .select("*", F.inline(tiles))
        .select(wanted)
    )
    parts = bases.union(used).groupBy("lang", "block", "low", "high").applyInArrow(
        block_sums, "lang string, a long, b long, value long, terms long"
    )
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))


def pair_rows(s: Shares) -> DataFrame:
    """The distance of each source from each other one of its language."""
    side = {
        x: s.groups.select("lang", F.col("no").alias(x), F.col("source").alias(f"source_{x}"), F.col("base").alias(f"base_{x}"))
        for x in "ab"
    }
    found = (
        distances(s).join(s.groups.select("lang", "kept").distinct(), "lang")
        .join(side["a"], ["lang", "a"]).join(side["b"], ["lang", "b"])
        .select(
            "lang", "source_a", "source_b",
            # terms that neither source holds
            (F.col("value") + (F.col("kept") - F.col("terms")) * F.abs(F.col("base_a") - F.col("base_b"))).alias("value"),
        )
    )
    bare = s.groups.where("kept = 0").select("lang", "source")
    nothing = bare.join(bare.withColumnRenamed("source", "other"), "lang").where("source < other").select(
        "lang", F.col("source").alias("source_a"), F.col("other").alias("source_b"), F.lit(0).cast("long").alias("value")
    )
    both = found.union(nothing)
    return both.select(
        "lang", F.explode(F.array(
            F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
            F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")),
        )).alias("x"), "value",
    ).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")


def term_rows(s: Shares) -> DataFrame:
    """The terms a source holds more often than its language does."""
    own, whole = share_of("uses", "total", "kept"), share_of("all_uses", "lang_total", "kept")
    return (
        s.counts.join(s.groups, ["lang", "source"]).join(s.terms, ["lang", "term"])
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (own - whole).alias("value"))
        .where("value > 0")
    )


def ranked(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): ranked distances to the other sources, and the ``top`` telling terms."""
    s = Shares(docs, min_docs)
    return ranked(pair_rows(s)).union(ranked(term_rows(s)).where(F.col("rank") <= top))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), t AS (SELECT doc, lang, source, unnest(w) AS term FROM d
), kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 30
), c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), g AS (SELECT DISTINCT lang, source FROM d
), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), p AS (
  SELECT lang, source, term, n, 1 + CAST((1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS BIGINT) AS p
  FROM (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
        FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)) JOIN v USING (lang)
), q AS (
  SELECT lang, term, 1 + CAST((1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN v USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 50
"""


@query("op13_source_divergence", SQL)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))
