"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

A source's target is its weighted share of the words to give out, at most CAP times its own words; what is cut off goes to the
other sources by weight. Each document is expected target / size of its source times: the whole part is certain, the
fraction is rounded. Two documents with fractions play: words move from one to the other until one fraction is 0 or 1, with the
odds that keep each expectation. The winner of a block's plays is its residual, and residuals of FAN blocks play in the next
round, so the words of a source are kept up to the last document of the last round, which is rounded by itself.

Blocks hold about FAN documents, dealt by the hash of the document, so a source of any size is spread. All draws
are hashes of the document, the round and a seed, so reruns agree.

Nulls and odd rows: a null text has size 0 and takes 0 words; a null source is a source, last in order; rows of equal doc_id, source and size
are drawn together and get the same number of copies; an empty table gives an empty result. Other columns are not looked at,
and ``mixed_documents`` passes all of them on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hazeline.llm.registry import query, table
from hazeline.llm.stages import materialise

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
CAP = 2
FAN = 64
SEED = 20_240

DOC = ["doc_id", "source", "size"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, size).

    Sources that reach their cap are found in order of cap per weight: each one is capped if the words left, shared by weight
    among it and those after it, would give it more. The two windows run over one row for each source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    weight = F.array(*map(F.lit, weights))
    ranked = sources.withColumn(
        "weight", F.get(weight, (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights))
    ).withColumn("cap", (CAP * F.col("source_size")).cast("double"))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(SHARE_PERCENT / 100)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    filled = ranked.withColumn("level", level)
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level")))
    filled = filled.withColumn("water", open_level.over(everything)["level"])
    target = F.least("cap", F.coalesce(F.col("water") * F.col("weight"), F.col("cap")))
    return filled.select("source", "source_size", "n_docs", target.alias("target"))


def draw(level: int) -> Column:
    """A number in [0, 1) for each document and round."""
    key = F.xxhash64(F.lit(SEED), F.lit(level), *DOC)
    return F.shiftrightunsigned(key, 11).cast("double") / float(1 << 53)


def play(acc: Column, b: Column) -> Column:
    """The residual of acc against b: words move until one of both is whole; that one is done."""
    a = acc["open"]
    room_a, room_b = (1 - a["p"]) * a["words"], (1 - b["p"]) * b["words"]
    held_a, held_b = a["p"] * a["words"], b["p"] * b["words"]
    to_a, to_b = F.least(room_a, held_b), F.least(held_a, room_b)
    a_gains = b["u"] * (to_a + to_b) < to_b
    a_done = F.when(a_gains, room_a <= held_b).otherwise(held_a <= room_b)
    p_a = F.when(a_gains, a["p"] + to_a / a["words"]).otherwise(a["p"] - to_b / a["words"])
    p_b = F.when(a_gains, b["p"] - to_a / b["words"]).otherwise(b["p"] + to_b / b["words"])

    def with_p(doc: Column, p: Column) -> Column:
        p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
        return F.struct(doc["u"].alias("u"), *(doc[c].alias(c) for c in DOC), doc["words"].alias("words"), p.alias("p"))

    def closed(doc: Column) -> Column:
        # whoever gains and is done is taken once more; whoever loses and is done is not
        return F.struct(*(doc[c].alias(c) for c in DOC), (a_done == a_gains).alias("extra"))

    return F.struct(
        F.when(a_done, with_p(b, p_b)).otherwise(with_p(a, p_a)).alias("open"),
        F.concat(acc["done"], F.array(F.when(a_done, closed(a)).otherwise(closed(b)))).alias("done"),
    )


def round_of_plays(players: DataFrame, level: int) -> DataFrame:
    """(block, open, done): a row for each source and block of players (doc, words, p, block)."""
    doc = F.struct(draw(level).alias("u"), *DOC, "words", "p")
    blocks = players.groupBy(F.col("source").alias("of"), "block").agg(F.array_sort(F.collect_list(doc)).alias("docs"))
    nothing = F.expr("CAST(array() AS array<struct<doc_id: bigint, source: string, size: bigint, extra: boolean>>)")
    start = F.struct(F.col("docs")[0].alias("open"), nothing.alias("done"))
    result = F.aggregate(F.slice("docs", 2, F.size("docs")), start, play)
    return blocks.select("of", "block", result.alias("r")).select("of", "block", "r.open", "r.done")


def copies(docs: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, copies): one row for each distinct doc_id, source and size.

    docs: doc_id, source and size. n counts the rows that are alike.
    """
    alike = docs.groupBy(*DOC).agg(F.count("*").alias("n"))
    targets = materialise(source_targets(docs, weights), "mix-targets")
    t = targets.withColumnRenamed("source", "of")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    alike = materialise(
        alike.join(t, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        .withColumn("whole", F.floor(share)).withColumn("p", share - F.floor(share)),
        "mix-documents",
    )
    block = F.pmod(F.xxhash64(F.lit(SEED), *DOC), F.ceil(F.col("n_docs") / FAN))
    players = alike.where("size > 0 AND p > 0").select(
        *DOC, (F.col("size") * F.col("n")).cast("double").alias("words"), "p", block.alias("block")
    )
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    blocks, level, done = -(-largest // FAN), 0, []
    while True:
        played = materialise(round_of_plays(players, level), "mix-round")
        done.append(played.select(F.inline("done")))
        players = played.select(
            "open.*", F.floor(F.col("block") / FAN).alias("block")
        ).select(*DOC, "words", "p", "block")
        level += 1
        if blocks <= 1:
            break
        blocks = -(-blocks // FAN)
    done.append(players.select(*DOC, (draw(level) < F.col("p")).alias("extra")))
    extra = reduce(DataFrame.unionByName, done).select(
        F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"), "extra"
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    taken = F.col("whole") + F.coalesce(F.col("extra").cast("long"), F.lit(0))
    return alike.join(extra, same, "left").select(
        *DOC, "n", "source_size", "target", F.least(taken, F.lit(CAP)).cast("long").alias("copies")
    )


def sized(docs: DataFrame, carry: list[str]) -> DataFrame:
    return docs.select(*(F.col(f"`{c}`") for c in carry), word_count(F.col("text")).alias("__size"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Each row of docs as often as the mix takes it, with the columns of docs."""
    rows = materialise(sized(docs, docs.columns), "mix-rows")
    drawn = copies(rows.select("doc_id", "source", F.col("__size").alias("size")), weights).where("copies > 0").select(
        F.col("doc_id").alias("__d"), F.col("source").alias("__s"), F.col("size").alias("__z"), F.col("copies").alias("__copies")
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("source").eqNullSafe(F.col("__s"))
        & (F.col("__size") == F.col("__z"))
    )
    return rows.join(drawn, same).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))
    ).select(*(F.col(f"`{c}`") for c in docs.columns))


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sized(table(spark, sf_dir, "documents"), ["doc_id", "source"]).withColumnRenamed("__size", "size")
    drawn = copies(materialise(docs, "mix-sizes"))
    return drawn.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )
