"""Spelling variants: words one edit apart, found with bidirectional FM-index search schemes.

One inserted, deleted or replaced code point lies in the left or in the right half of a word, so the other half is there unchanged. Two searches
cover all cases: match the left half exactly and extend to the right over the other half allowing one error, or match the right half exactly
and extend to the left. An index in each direction is needed: one over the words, one over the reversed words. In both a word stands between
delimiters, its search begins at the delimiter, and a state is an interval of suffix ranks; a state ends as a hit when the closing
delimiter leaves its interval non-empty. Because each search begins at an end of the word it never turns, so an interval lives in one direction.

The vocabulary is cut into shards by range, for each direction in the order of its strings, so shards are of equal size whatever the words have in
common. Words with a common half are neighbours there: a word searches only the shards that its exact half reaches, mostly its own. The
shards' first and last strings are all the driver sees, one row for SHARD_WORDS words. A shard that very many words search, because
they share their beginning, is searched in blocks of at most about QUERY_WORDS words, each with its own copy of the shard. Inside a task all
words of a block move through the index in step, as numpy arrays.

A word's form is its near word of the largest count, if that is FORM_RATIO times its own; roots follow forms by doubling the steps until none moves.
Counts grow along forms, so there are no circles and paths have logarithmic length.

Nulls and odd rows: a null text has no words; a null doc_id is read as an empty string; repeated rows count again; an empty table
gives an empty result. Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import words as wd
from hazeline.llm.registry import query, table
from hazeline.llm.stages import materialise

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A run loses a code point where this divides the checksum of its document and itself.
LOSS = 199
MIN_CHARS = 6
MIN_USES = 5
FORM_RATIO = 5
#: Words in a shard of the index, about, and words that search it in one task.
SHARD_WORDS = 16_384
QUERY_WORDS = 65_536
#: Words that move through an index in step.
STEP_WORDS = 4096
#: Distinct words a task counts before it sends them.
HELD = 300_000


def text_words(doc_id: str, text: str | None, min_chars: int = MIN_CHARS) -> Iterator[tuple[str, int]]:
    """The words of a text, of at least min_chars, with their number."""
    # bytes.lower changes A-Z only
    runs = Counter(RUN.findall((text or "").encode().lower().decode()))
    begun = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        if len(run) >= min_chars:
            h = zlib.crc32(run.encode(), begun)
            if h % LOSS == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < min_chars:
                    continue
            yield run, n


def word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sent(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    held: Counter[str] = Counter()
    for rows, texts in wd.text_chunks(batches):
        for doc_id, text in zip(rows.column(0).to_pylist(), texts, strict=True):
            for word, n in text_words(doc_id, text):
                held[word] += n
        if len(held) > HELD:
            yield sent(held)
            held = Counter()
    yield sent(held)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of the corpus with enough occurrences."""
    given = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counts = given.mapInArrow(word_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= MIN_USES)


class RankIndex:
    """FM-index over delimited strings, extended code point by code point away from their beginnings."""

    def __init__(self, strings: list[str]):
        alphabet = sorted(set("".join(strings)))
        self.code = {c: i + 1 for i, c in enumerate(alphabet)}
        self.letters = np.arange(1, len(alphabet) + 1)
        # code 0 is the delimiter; a string is laid down backwards before it, so that a step to the left in rank space reads the next letter
        text = np.array([self.code.get(c, 0) for s in strings for c in s[::-1] + "\0"], np.int64)
        size = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
        self.begin = np.cumsum(size) - size
        self.n = len(text)
        place = self.ranked(text)
        self.before = (place - 1) % self.n
        self.last = text[self.before]
        order = np.argsort(self.last, kind="stable")
        # (letter, rank) of the last column in order: a search in it gives the smaller letters and the equal ones above a rank in one number
        self.keys = self.last[order] * (self.n + 1) + order
        self.place = place

    @staticmethod
    def ranked(text: np.ndarray) -> np.ndarray:
        """Places of the rotations of the text in their order, by doubling the compared length."""
        n, rank, length = len(text), text, 1
        while True:
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -length)
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
            if fresh[-1] == n - 1:
                return order
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            length *= 2

    def codes(self, s: str) -> list[int]:
        """Letters that no string has get a code behind all others, which every interval loses."""
        return [self.code.get(c, len(self.letters) + 1) for c in s]

    def step(self, rank: np.ndarray, code: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, code * (self.n + 1) + rank)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(state, letter, low, high) for each letter that goes on from an interval."""
        size, some = high - low, len(self.letters)
        narrow, wide = np.flatnonzero(size <= some), np.flatnonzero(size > some)
        width = size[narrow]
        within = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        seen = np.unique(np.repeat(narrow, width) * (some + 1) + self.last[np.repeat(low[narrow], width) + within])
        state = np.concatenate((seen // (some + 1), np.repeat(wide, some)))
        letter = np.concatenate((seen % (some + 1), np.tile(self.letters, len(wide))))
        state, letter = state[letter > 0], letter[letter > 0]
        new_low, new_high = self.step(low[state], letter), self.step(high[state], letter)
        alive = new_high > new_low
        return state[alive], letter[alive], new_low[alive], new_high[alive]

    def near(self, words: list[str], exact: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(word, string) numbers of strings one edit from a word, all in its part behind the first ``exact`` code points."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.zeros((len(words), size.max() + 1), np.int64)  # 0 behind the end: the closing delimiter
        for i, w in enumerate(words):
            letters[i, : len(w)] = self.codes(w)
        exact, who = np.asarray(exact), np.arange(len(words))
        low, high = np.zeros(len(words), np.int64), np.full(len(words), len(self.begin))
        for at in range(exact.max()):
            on = at < exact[who]
            low[on], high[on] = self.step(low[on], letters[who[on], at]), self.step(high[on], letters[who[on], at])
            alive = high > low
            who, low, high = who[alive], low[alive], high[alive]
        at, found = exact[who], []
        while len(who):
            state, letter, to_low, to_high = self.branches(low, high)
            wrong = (at[state] < size[who[state]]) & (letter != letters[who[state], at[state]])
            left = at < size[who]
            found.append(self.finished(
                letters, size,
                np.concatenate((who[left], who[state][wrong], who[state])),
                np.concatenate((at[left] + 1, at[state][wrong] + 1, at[state])),
                np.concatenate((low[left], to_low[wrong], to_low)),
                np.concatenate((high[left], to_high[wrong], to_high)),
            ))
            # without an error so far
            who, at, low, high = who[left], at[left], low[left], high[left]
            low, high, at = self.step(low, letters[who, at]), self.step(high, letters[who, at]), at + 1
            alive = high > low
            who, at, low, high = who[alive], at[alive], low[alive], high[alive]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(found), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def finished(self, letters, size, who, at, low, high) -> np.ndarray:
        """Exact extension of states with their one error behind them; the closing delimiter is the last step."""
        out = [np.zeros((0, 2), np.int64)]
        while len(who):
            code = letters[who, at]
            low, high = self.step(low, code), self.step(high, code)
            alive = high > low
            who, at, low, code = who[alive], at[alive], low[alive], code[alive]
            high = high[alive]
            done = at == size[who]
            # the delimiter before the string that is laid down backwards
            begin = (self.place[low[done]] + 1) % self.n
            out.append(np.column_stack((who[done], np.searchsorted(self.begin, begin))))
            who, at, low, high = who[~done], at[~done] + 1, low[~done], high[~done]
        return np.concatenate(out)


def exact_part(side: int, length: int) -> int:
    """Code points matched without error: the left half, and what it leaves in the other direction."""
    return length - length // 2 if side else length // 2


def directed(vocab: DataFrame) -> DataFrame:
    """(side, s, n): the words, and with side 1 the reversed words."""
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("s")),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("s")),
    )
    return vocab.select(F.inline(sides), "n")


def shards(strings: DataFrame, n_words: int) -> DataFrame:
    """Adds ``shard``: ranges of about equal size in the order of (side, s); written, so that the cut is made once."""
    parts = max(1, -(-2 * n_words // SHARD_WORDS))
    dealt = strings.repartitionByRange(parts, "side", "s").withColumn("shard", F.spark_partition_id())
    return materialise(dealt, "spelling-shards")


def route_batches(bounds: dict[int, list[tuple[str, str, int]]]):
    """The shards that the exact part of each string reaches."""
    lasts = {side: [last for _, last, _ in rows] for side, rows in bounds.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for side, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = s[: exact_part(side, len(s))]
                rows = bounds[side]
                for i in range(bisect_left(lasts[side], part), len(rows)):
                    first, _, shard = rows[i]
                    if first[: len(part)] > part:
                        break
                    out.append((side, shard, s))
            columns = list(zip(*out, strict=True)) if out else [()] * 3
            types = (pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["side", "shard", "s"]
            )

    return run


def search_block(strings: pa.Table, queries: pa.Table) -> pa.Table:
    """(word, near, near_n) of one shard and the words that search it."""
    words, found, counts = [], [], []
    if strings.num_rows and queries.num_rows:
        side = queries["side"][0].as_py()
        own, n = strings["s"].to_pylist(), strings["n"].to_pylist()
        asked, index = queries["s"].to_pylist(), RankIndex(own)
        turn = slice(None, None, -1 if side else 1)
        for at in range(0, len(asked), STEP_WORDS):
            part = asked[at : at + STEP_WORDS]
            who, which = index.near(part, [exact_part(side, len(s)) for s in part])
            words += [part[i][turn] for i in who.tolist()]
            found += [own[i][turn] for i in which.tolist()]
            counts += [n[i] for i in which.tolist()]
    return pa.table({
        "word": pa.array(words, pa.string()), "near": pa.array(found, pa.string()), "near_n": pa.array(counts, pa.int64()),
    })


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n): every two words of the vocabulary one edit apart, both ways round."""
    strings = shards(directed(vocab), vocab.count())
    bounds: dict[int, list[tuple[str, str, int]]] = {0: [], 1: []}
    # one row for SHARD_WORDS words
    for r in strings.groupBy("side", "shard").agg(F.min("s").alias("first"), F.max("s").alias("last")).collect():
        bounds[r.side].append((r.first, r.last, r.shard))
    for rows in bounds.values():
        rows.sort()
    routed = materialise(
        strings.select("side", "s").mapInArrow(route_batches(bounds), "side int, shard int, s string"), "spelling-routed"
    )
    blocks = materialise(
        routed.groupBy("side", "shard").agg(F.expr(f"(COUNT(*) + {QUERY_WORDS - 1}) DIV {QUERY_WORDS}").alias("blocks")),
        "spelling-blocks",
    )
    searched = strings.join(blocks, ["side", "shard"]).select(
        "side", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "s", "n"
    )
    asking = routed.join(blocks, ["side", "shard"]).select(
        "side", "shard", F.pmod(F.xxhash64("s"), "blocks").alias("block"), "s"
    )
    key = ["side", "shard", "block"]
    found = searched.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(
        search_block, "word string, near string, near_n long"
    )
    # an edit that can be placed in either half is found from both
    return found.distinct()


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root`` to (word, form, ...): the end of the path of forms."""
    paths = materialise(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-paths")
    while True:
        onward = paths.select(F.col("word").alias("w"), F.col("root").alias("next"))
        moved = paths.join(onward, paths["root"] == onward["w"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = materialise(moved, "spelling-paths")
        paths = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            break
    return forms.join(paths, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the vocabulary."""
    vocab = materialise(vocabulary(docs), "spelling-words")
    best = near_words(vocab).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    top = -F.col("best.n")
    chosen = top >= FORM_RATIO * F.col("n")
    forms = vocab.join(best, "word", "left").select(
        "word", F.when(chosen, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(chosen, top).alias("form_n"),
    )
    return with_roots(materialise(forms, "spelling-forms"))


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
