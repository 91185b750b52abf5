import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazeline.llm import token_counts as tc
from hazeline.llm.queries import REGISTRY

PATH = public_tokenizers.path(tc.VOCABULARY)
SPEC = open(PATH, encoding="utf-8").read()
TEXTS = [
    "It's we'll I'D don't 'S", "a<|endoftext|>b <|endoftext|> <|endoftext", "<|endoftext|><|endoftext|>", "   three   gaps  \n\n x ",
    "tab\there\x0b\x0c\r\n\x1c\x1d\x85\xa0 　end", "123 4567 ½ ² Ⅷ", "naïve é 你好，世界 こんにちは 한국어 \U0001f600\U0001f1e9\U0001f1ea",
    "՘ \U0002a6df\U00010940 ꟒x ﻿bom", "x" * 5000, "-" * 3000 + " #$%^&", "ſ ς Σ İ", "", None, "\x00\x01", "‍  ",
]


def brute(texts):
    lib = Tokenizer.from_file(PATH)
    return [len(lib.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_as_the_library_counts():
    counter = tc.Counter(SPEC, tc.proved_tokens(SPEC))
    assert counter.counts(TEXTS).tolist() == brute(TEXTS)


def test_every_character_of_the_plain_blocks():
    """Cutting must agree with the tokenizer on each character that does not send its text to it."""
    counter = tc.Counter(SPEC, tc.proved_tokens(SPEC))
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not counter.unusual(chr(c))]
    texts = [f"a{c}b 1{c}{c}2 {c}" for c in chars]
    cut = counter.tokenizer.pre_tokenizer
    assert len(texts) > 30_000
    for t in texts:
        assert counter.pieces(t) == [t[b:e] for _, (b, e) in cut.pre_tokenize_str(t)]


def test_bounded_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(tc, "MEMO", 3)
    counter = tc.Counter(SPEC, tc.proved_tokens(SPEC))
    for _ in range(2):
        for t in TEXTS:
            assert counter.counts([t]).tolist() == brute([t])


def test_query(spark, odd_docs, make_docs, as_table):
    lib = Tokenizer.from_file(PATH)
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)]
    docs = odd_docs.union(make_docs(rows)).withColumn("__n_bytes2", F.lit(1))
    want = sorted(
        ((r.doc_id, len((r.text or "").encode()), n := len(lib.encode(r.text or "").ids), n > 1024) for r in docs.collect()), key=str
    )
    got = REGISTRY["op6_token_counts"](spark, as_table(documents=docs)).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert REGISTRY["op6_token_counts"](spark, as_table(documents=odd_docs.limit(0))).count() == 0
