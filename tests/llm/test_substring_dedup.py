import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.llm import substring_dedup as sd
from hazeline.llm import words as wd
from hazeline.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """{(doc_id, text): (words, removed, kept)} with a set of every window seen so far, in the order of documents."""
    tie = lambda t: 0 if t is None else 1  # noqa: E731  (different texts under one id are tested by properties)
    docs = sorted({(d, t) for d, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, tie(r[1])))
    seen, out = set(), {}
    for d, t in docs:
        words = WORD.findall(t or "")
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        out[d, t] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def check(spark, folder, rows):
    want = brute(rows)
    expect = sorted(((d, *want[d, t][:2], hashlib.sha256(want[d, t][2].encode()).hexdigest()) for d, t in rows), key=str)
    assert sorted((tuple(r) for r in REGISTRY["op4_substring_dedup"](spark, folder).collect()), key=str) == expect


def passages(rng, n):
    words = [f"w{i}" for i in range(50)]
    text = lambda k, from_=words: [rng.choice(from_) for _ in range(k)]
    shared = [text(k) for k in (18, 19, 20, 21, 35, 60, 200)]
    few = [text(30, ["a", "b"]), ["x"] * 45, ["x"] * 25 + ["y"] * 30]
    rows = []
    for i in range(n):
        parts = text(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared + few)
            begin = rng.randint(0, max(0, len(p) - 20))
            parts += p[begin : begin + rng.randint(15, len(p))] + text(rng.randint(0, 12))
        rows.append((rng.randint(-(10**12), 10**12), rng.choice([" ", "\n", "\t "]).join(parts)))
    return rows


def test_every_window(spark, make_docs, as_table):
    rows = passages(random.Random(11), 150) + [(5, " ".join(["a", "b"] * 40)), (6, "\x0b".join(["b", "a"] * 60)), (7, "q " * 19)]
    check(spark, as_table(documents=make_docs(rows).withColumn("name", F.lit("clash")).withColumn("place", F.lit(0))), rows)


def test_odd_rows_and_empty(spark, odd_docs, as_table):
    check(spark, as_table(documents=odd_docs), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert REGISTRY["op4_substring_dedup"](spark, as_table(documents=odd_docs.limit(0))).count() == 0


def test_texts_that_share_an_id(spark, make_docs):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(3, "a " + passage), (3, "b " + passage), (None, "c " + passage), ((1 << 63) - 1, "d " + passage)]
    got = {r["__kept"]: r["__n_removed"] for r in sd.with_kept(make_docs(rows), []).collect()}
    assert sorted(got.values()) == [0, 40, 40, 40]
    kept = [k for k, n in got.items() if n == 0]
    assert kept[0].split()[0] in "ab"


@pytest.mark.parametrize("letters", [2, 3, 50])
def test_equal_windows_have_equal_representatives(letters):
    rng = np.random.default_rng(letters)
    hasher = wd.Hasher()
    names = hasher.words([f"x{i}".encode() for i in rng.integers(0, letters, 4000)])
    name, first, count = sd.representatives(hasher, names)
    assert count.sum() == len(names) - sd.WINDOW + 1
    of = np.repeat(name, count)
    window = hasher.windows(names, sd.WINDOW)
    by = {}
    for w, r in zip(window.tolist(), of.tolist()):
        assert by.setdefault(w, r) == r
    if letters == 50:
        assert len(first) < len(names) / 5  # far fewer representatives than windows


def test_documents_keep_their_columns(spark, make_docs):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = make_docs([(1, passage), (2, f"new\n\n{passage} end"), (3, "left  as it\nis"), (4, None)]).withColumn("ranges", F.lit(1))
    got = sd.deduplicated(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: passage, 2: "new end", 3: "left  as it\nis", 4: None}
