import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazeline.llm import token_shards as ts
from hazeline.llm.queries import REGISTRY

PATH = public_tokenizers.path(ts.VOCABULARY)
SPEC = open(PATH, encoding="utf-8").read()
TEXTS = [
    "It's we'll I'D don't, don't. 'S x'sy", "a<|endoftext|>b <|startoftext|> <|endoftext", "  gaps\n\n\x0b\x0c\r\x1c \x85 \xa0 　 é e",
    "Straße ÀÉÎ; naïve... µª º ÷×x Σας ΣΑΣ İstanbul", "12 3456a7 ½", "你好，世界 こ \U0001f600 한국어", "The,The the. THE!?",
    "word###, a###b x--- É&&& #$% &a *b* a_b (c) a<|end x|", "a., b", "x×y. z, ÷", "plain words, only. Ünd ßa ÿ ÞÐ.",
    "", None, "\u0301x ﬁ A\u030a",
]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def brute(lib, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for d, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_words_in_a_row_are_the_text(lib, monkeypatch):
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    texts = TEXTS + [f"{a}b{a}, x{a}. {a}! {a}, .{a},{a} b.{a}c" for a in letters]
    for memo in (ts.MEMO, 5):
        monkeypatch.setattr(ts, "MEMO", memo)
        encoder = ts.Encoder(SPEC)
        for t in texts:
            got = np.frombuffer(encoder.encode([t])[0], '<u2').tolist()
            assert got == lib.encode(t or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 5000])
def test_index_is_minimal_and_perfect(n):
    rng = random.Random(n)
    keys = sorted({rng.randrange(-(1 << 62), 1 << 62) for _ in range(n)})
    data = ts.pack(0, 0, 2, keys, [b"\1\0"] * n)
    shard = ts.Shard.of(data)
    begin, count = shard.find(shard.key, shard.null)
    assert begin.tolist() == list(range(n)) and (count == 1).all() and len(shard.index) == n
    other = np.array([k + 1 for k in keys], np.int64)
    _, none = shard.find(other, np.zeros(n, bool))
    assert not none[~np.isin(other, shard.key)].any()


def test_query_and_lookup(spark, lib, make_docs, as_table, monkeypatch):
    monkeypatch.setattr(ts, "SHARD_BYTES", 400)
    rng = random.Random(3)
    rows = [(i * 7 - 50, " ".join(rng.choice(["alpha", "Beta,", "γ", "x1"]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows += [(10_000 + i, t) for i, t in enumerate(TEXTS)]
    docs = make_docs(rows).withColumn("data", F.lit("clash"))
    got = REGISTRY["op8_token_shards"](spark, as_table(documents=docs))
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(lib, rows))
    folder = ts.new_path(spark, "token-shards")
    ts.write_shards(docs, folder, PATH)
    found = {r.doc_id: r.ids for r in ts.lookup(spark, folder, [-50, 10_000, 10_008, 5]).collect()}
    texts = dict(rows)
    assert found == {d: lib.encode(texts[d] or "", add_special_tokens=False).ids + [1] for d in (-50, 10_000, 10_008)}


def test_odd_rows_and_empty(spark, lib, odd_docs, as_table):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = REGISTRY["op8_token_shards"](spark, as_table(documents=odd_docs))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(brute(lib, rows), key=str)
    assert REGISTRY["op8_token_shards"](spark, as_table(documents=odd_docs.limit(0))).count() == 0
