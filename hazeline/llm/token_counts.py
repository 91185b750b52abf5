"""Token counts with a whole-token shortcut.

The vocabulary is checked once, before the job: each of its strings that the tokenizer encodes alone as that one token is
proved to cost one token wherever the pre-tokenizer cuts it out. In the tasks a text is cut into pre-tokens; those found among
the proved strings count one each, and only the rest go through the tokenizer's merges, each distinct one once per
run of texts, with a memo of bounded size.

Cutting uses a regular expression with this Python's character classes. Texts with characters outside the blocks in
``PLAIN``, where these classes and the tokenizer's were compared character by character, go to the tokenizer whole.

Nulls and odd rows: a null text is empty and has no tokens; every input row gives one output row; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from hazeline.llm import words as wd
from hazeline.llm.registry import query, table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Pre-tokens of which a task remembers the cost, besides the proved ones.
MEMO = 400_000
#: The pre-tokenizer's pattern, and blocks of characters on which both libraries agree.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = r"[^\x00-ԯḀ-⁯₠-⃀←-⯿　-ヿ一-龥가-힣ﬀ-ﬆ\U0001f300-\U0001f64f]"


def proved_tokens(spec: str) -> frozenset[str]:
    """Strings of the vocabulary that the tokenizer encodes alone as exactly one token."""
    tokenizer = Tokenizer.from_str(spec)
    ids = list(tokenizer.get_vocab(with_added_tokens=False).values())
    strings = [tokenizer.decode([i], skip_special_tokens=False) for i in ids]
    alone = tokenizer.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for i, s, e in zip(ids, strings, alone, strict=True) if e.ids == [i])


def special_strings(spec: str) -> list[str]:
    return [t["content"] for t in json.loads(spec)["added_tokens"]]


class Counter:
    """Token numbers of texts; one in each task."""

    def __init__(self, spec: str, proved: frozenset[str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(spec)
        self.proved = proved
        self.cost = dict.fromkeys(proved, 1)
        self.pieces = regex.compile(PATTERN).findall
        self.unusual = regex.compile(PLAIN).search
        special = special_strings(spec)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def counts(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        cut: list[list[str]] = [[] for _ in texts]
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.unusual(text):
                out[i] = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
                continue
            parts = self.special.split(text) if self.special else [text]
            out[i] = len(parts) - 1
            for part in parts:
                cut[i] += self.pieces(part)
        missing = list(set().union(*cut).difference(self.cost))
        if len(self.cost) + len(missing) > len(self.proved) + MEMO:
            self.cost = dict.fromkeys(self.proved, 1)
            missing = list(set().union(*cut).difference(self.cost))
        for piece, coded in zip(missing, self.tokenizer.encode_batch(missing, add_special_tokens=False), strict=True):
            self.cost[piece] = len(coded.ids)
        for i, pieces in enumerate(cut):
            out[i] += sum(map(self.cost.__getitem__, pieces))
        return out


def count_batches(spec: str, proved: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(spec, proved)
        for rows, texts in wd.text_chunks(batches, "__text"):
            keep = [n for n in rows.schema.names if n != "__text"]
            size = np.fromiter((len((t or "").encode()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(rows.schema.get_field_index(n)) for n in keep),
                    pa.array(size), pa.array(counter.counts(texts)),
                ],
                names=[*keep, "__n_bytes", "__n_tokens"],
            )

    return run


def counted(docs: DataFrame, carry: list[str], path: str) -> DataFrame:
    """The named columns, ``__n_bytes`` and ``__n_tokens`` of each text, with the tokenizer file at ``path``."""
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    given = docs.select(*(F.col(f"`{c}`") for c in carry), F.col("text").alias("__text"))
    fields = [docs.schema[c] for c in carry] + T.StructType.fromDDL("__n_bytes long, __n_tokens long").fields
    return given.mapInArrow(count_batches(spec, proved_tokens(spec)), T.StructType(fields))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = counted(table(spark, sf_dir, "documents"), ["doc_id"], public_tokenizers.path(VOCABULARY))
    return rows.select(
        "doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_tokens").alias("n_tokens"),
        (F.col("__n_tokens") > LIMIT).alias("over_limit"),
    )
