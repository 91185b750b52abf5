import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hazeline.llm import source_divergence as sd


def brute(rows, min_docs, top):
    docs = [(l or "", s or "", Counter(
        "".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")
    )) for _, t, l, s in rows]
    held, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, c in docs:
        held[lang].update(c.keys())
        groups[lang, source].update(c)
    kept = {lang: sorted(t for t, n in c.items() if n >= min_docs) for lang, c in held.items()}

    def shares(lang, counts):
        terms = kept.get(lang, [])
        total = sum(counts[t] for t in terms)
        return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(terms)) for t in terms}

    p = {g: shares(g[0], c) for g, c in groups.items()}
    out = []
    for lang, source in groups:
        whole = sum((c for g, c in groups.items() if g[0] == lang), Counter())
        q = shares(lang, whole)
        mine = p[lang, source]
        pairs = [(o, sum(abs(mine[t] - p[lang, o][t]) for t in mine)) for lg, o in groups if lg == lang and o != source]
        terms = [(t, mine[t] - q[t]) for t in mine if groups[lang, source][t] and mine[t] > q[t]]
        for part, items, n in (("pair", pairs, None), ("term", terms, top)):
            items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:n]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(items)]
    return sorted(out)


def corpus(rng, n):
    words = [f"{a}{b}{c}" for a in ("re", "un", "über", "inter") for b in ("mark", "marks", "mar", "x" * 40) for c in ("", "ing", "é", "y" * 30)]
    sources = [None, "a", "b", "c", "ü"]
    rows = [
        (i, ", ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, [k % 7 + 1 for k in range(len(words))], k=rng.randint(1, 30))),
         rng.choice(["en", "de", None]), rng.choice(sources))
        for i in range(n)
    ]
    return rows + [(9001, "12 34 -", "en", "none"), (9002, "lonely word", "fr", "a"), (9003, None, "fr", "b"), (9004, "", "fr", None)]


@pytest.mark.parametrize("tile, block, held", [(64, 2048, 200_000), (2, 5, 10)])
def test_against_plain_counts(spark, make_docs, monkeypatch, tile, block, held):
    monkeypatch.setattr(sd, "TILE", tile)
    monkeypatch.setattr(sd, "BLOCK_TERMS", block)
    monkeypatch.setattr(sd, "HELD", held)
    rows = corpus(random.Random(3), 300)
    got = sd.divergence(make_docs(rows).withColumn("term", F.lit("clash")), min_docs=12, top=7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 12, 7)


def test_full_bitmap_changes_nothing(spark, make_docs, monkeypatch):
    rows = corpus(random.Random(4), 120)
    monkeypatch.setattr(sd, "in_bitmap", lambda bits, hashes: hashes == hashes)
    got = sd.divergence(make_docs(rows), min_docs=8, top=50)
    assert sorted(map(tuple, got.collect())) == brute(rows, 8, 50)


def test_levels_end_and_prune(spark, make_docs):
    rows = [(i, "z" * 500 + " " + "z" * 300 + f" rare{'abcdefghij'[i]}x", "en", "s") for i in range(10)]
    got = {(r.term, r.uses) for r in sd.kept_counts(make_docs(rows), 10).collect()}
    assert got == {("z" * 500, 10), ("z" * 300, 10)}


def test_shares_are_exact_for_large_counts(spark):
    big = 10**15 + 7
    df = spark.createDataFrame([(big, 3 * big + 1, 12_345_678)], "u long, n long, v long")
    assert df.select(sd.share_of("u", "n", "v")).first()[0] == 1 + 10**9 * (big + 5) // (3 * big + 1 + 5 * 12_345_678)


def test_odd_rows_and_empty(spark, odd_docs):
    rows = [tuple(r)[:4] for r in odd_docs.collect()]
    assert sorted(map(tuple, sd.divergence(odd_docs, 2, 5).collect())) == brute(rows, 2, 5)
    assert sd.divergence(odd_docs.limit(0)).count() == 0
