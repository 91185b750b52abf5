import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hazeline.llm import spelling_variants as sv
from hazeline.llm.queries import REGISTRY


def plain_words(rows):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(vocab):
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w in vocab:
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        if best is not None and vocab[best] >= 5 * vocab[w]:
            form[w] = best
    out = []
    for w in vocab:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, vocab[w], len(near[w]), vocab[f] if f else None))
    return sorted(out, key=str)


def corpus(rng, n_docs=60):
    """Words with variants, among them chains of forms, repeated letters, accents and a much shared beginning."""
    base = ["language", "measured", "aaaaaaa", "Überschuß", "façades", "station", "bookkeeper", "common" + "a" * 30]
    base += ["common" + "".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(40)]
    base += ["".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(120)]
    pool = ["mountain"] * 400 + ["mountaim"] * 60 + ["moumtaim"] * 8
    for i, w in enumerate(base):
        pool += [w] * (60 // (i % 5 + 1))
        for _ in range(3):
            v = w
            for _ in range(rng.randint(1, 2)):
                p = rng.randrange(len(v))
                v = rng.choice([v[:p] + v[p + 1 :], v[:p] + rng.choice("abxé") + v[p + 1 :], v[:p] + rng.choice("abxé") + v[p:]])
            pool += [v.upper() if rng.random() < 0.3 else v] * rng.choice([1, 5, 7, 30])
    rng.shuffle(pool)
    step = len(pool) // n_docs + 1
    return [(i, " 3, ".join(pool[i * step : (i + 1) * step])) for i in range(n_docs)]


@pytest.mark.parametrize("shard, block, step", [(16_384, 65_536, 4096), (40, 30, 7)])
def test_query_against_every_pair(spark, make_docs, as_table, monkeypatch, shard, block, step):
    monkeypatch.setattr(sv, "SHARD_WORDS", shard)
    monkeypatch.setattr(sv, "QUERY_WORDS", block)
    monkeypatch.setattr(sv, "STEP_WORDS", step)
    rows = corpus(random.Random(5))
    got = REGISTRY["op11_spelling_variants"](spark, as_table(documents=make_docs(rows)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(plain_words(rows))
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(r[1] != r[2] for r in want if r[1])  # a path of two forms and more


@pytest.mark.parametrize("seed", range(4))
def test_index_against_every_string(seed):
    rng = random.Random(seed)
    strings = sorted({"".join(rng.choices("abc" if seed else "ab", k=rng.randint(1, 9))) for _ in range(300)})
    words = strings + ["zzz", "abz", "azb", "a" * 12]
    exact = [len(w) // 2 for w in words]
    who, which = sv.RankIndex(strings).near(words, exact)
    want = {
        (i, j) for i, w in enumerate(words) for j, s in enumerate(strings)
        if one_edit(w, s) and w[: exact[i]] == s[: exact[i]]
    }
    assert set(zip(who.tolist(), which.tolist())) == want


def test_index_of_one_string():
    who, which = sv.RankIndex(["planet"]).near(["planet", "planets", "plane", "plant", "xlanet"], [3, 3, 2, 2, 3])
    assert who.tolist() == [1, 2, 3] and set(which.tolist()) == {0}


def test_long_path_of_forms(spark):
    rows = [(f"w{i}", f"w{i + 1}" if i < 40 else None) for i in range(41)]
    got = sv.with_roots(spark.createDataFrame(rows, "word string, form string"))
    assert {(r.word, r.root) for r in got.collect()} == {(f"w{i}", "w40") for i in range(41)}


def test_odd_rows_and_empty(spark, odd_docs, make_docs, as_table):
    more = make_docs([(None, "nullable " * 7), (30, "nullables " * 6), (31, "Nullable " * 40)])
    docs = odd_docs.union(more).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = REGISTRY["op11_spelling_variants"](spark, as_table(documents=docs))
    assert sorted(map(tuple, got.collect()), key=str) == brute(plain_words(rows))
    assert REGISTRY["op11_spelling_variants"](spark, as_table(documents=docs.limit(0))).count() == 0
