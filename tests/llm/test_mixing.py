import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hazeline.llm import mixing as mx
from hazeline.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Fill by weight, cut what is above twice the size, share it again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / whole > 2 * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / whole for s in open_}
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def check(got, rows):
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=str) == sorted(
        ((d, s, len(WORD.findall(t or ""))) for d, t, _, s in rows), key=str
    )
    sizes, taken, largest = Counter(), Counter(), Counter()
    for d, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    target = brute_targets(sizes)
    repeats = Counter((d, s, len(WORD.findall(t or ""))) for d, t, _, s in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r.size, 2 * r.size) and r.taken <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size * repeats[r.doc_id, r.source, r.size])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6


def make_rows(rng, n, sources):
    return [
        (i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), "en", rng.choices(sources, [8, 4, 2, 1, 1][: len(sources)])[0])
        for i in range(n)
    ]


def test_words_come_near_targets(spark, make_docs, as_table):
    rows = make_rows(random.Random(2), 3000, ["b", "a", None, "ä", "c"])
    folder = as_table(documents=make_docs(rows).withColumn("words", F.lit(1)))
    got = REGISTRY["op2_mixing"](spark, folder).collect()
    check(got, rows)
    again = REGISTRY["op2_mixing"](spark, folder)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again.collect()), key=str)


def test_partitions_do_not_matter(spark, make_docs, as_table):
    rows = make_rows(random.Random(4), 400, ["x", "y"])
    one = REGISTRY["op2_mixing"](spark, as_table(documents=make_docs(rows, 1))).collect()
    many = REGISTRY["op2_mixing"](spark, as_table(documents=make_docs(rows, 7))).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_every_document_keeps_its_expectation(spark, make_docs, monkeypatch):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", "abc"[i % 3]) for i in range(60)]
    docs = mx.sized(make_docs(rows), ["doc_id", "source"]).withColumnRenamed("__size", "size")
    seen, runs = defaultdict(int), 8
    for seed in range(runs):
        monkeypatch.setattr(mx, "SEED", seed)
        for r in mx.copies(docs).collect():
            seen[r.source] += r.copies - r.target / r.source_size
    assert all(abs(total) / runs < 2.0 for total in seen.values())


def test_odd_rows_and_empty(spark, odd_docs, make_docs, as_table):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in odd_docs.collect()]
    check(REGISTRY["op2_mixing"](spark, as_table(documents=odd_docs)).collect(), rows)
    assert REGISTRY["op2_mixing"](spark, as_table(documents=odd_docs.limit(0))).count() == 0
    nothing = make_docs([(1, None), (2, "")])
    assert [r.taken for r in REGISTRY["op2_mixing"](spark, as_table(documents=nothing)).collect()] == [0, 0]


def test_mixed_rows_repeat_as_drawn(spark, make_docs):
    rows = make_rows(random.Random(9), 200, ["b", "a", None])
    docs = make_docs(rows).withColumn("size", F.lit("clash")).withColumn("copies", F.lit(0))
    mixed = mx.mixed_documents(docs)
    assert mixed.columns == docs.columns
    sized = mx.sized(docs, ["doc_id", "source"]).withColumnRenamed("__size", "size")
    want = {r.doc_id: r.copies for r in mx.copies(sized).collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.collect()) == want


def test_plan_is_native(spark, make_docs):
    plan = mx.mixed_documents(make_docs([(1, "a b"), (2, "c")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
