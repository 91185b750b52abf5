import hashlib
import random

import pytest
from pyspark.sql import functions as F

from hazeline.llm import line_dedup as ld
from hazeline.llm.queries import REGISTRY


def full_lines(text):
    return [(i, x) for i, x in enumerate(text.split("\n")) if x.strip(" \t\n\x0b\x0c\r")]


def plain_lengths(rows):
    """{(doc_id, text): for each line with a word the most lines from it on that also start earlier}."""
    docs = sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for d, t in docs:
        lines = [x for _, x in full_lines(t)]
        out[d, t] = []
        for i in range(len(lines)):
            n = 0
            while i + n < len(lines) and tuple(lines[i : i + n + 1]) in seen:
                n += 1
            out[d, t].append(n)
            seen.update(tuple(lines[i : j + 1]) for j in range(i, len(lines)))
    return out


def brute(rows, words):
    """{(doc_id, text): (lines, deleted lines, kept text)} from every later copy of enough words."""
    out = {}
    for (d, t), lengths in plain_lengths(rows).items():
        full, gone = full_lines(t), set()
        for i, n in enumerate(lengths):
            run = full[i : i + n]
            if sum(len(x.split()) for _, x in run) >= words:
                gone.update(p for p, _ in run)
        out[d, t] = (len(full), len(gone), "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))
    return out


def rows_of(rng, n):
    line = lambda: rng.choice(["alpha one", "beta", "gamma  x", "", " ", "delta\t", "eps"])
    return [(i * 3 % 101, "\n".join(line() for _ in range(rng.randint(0, 14)))) for i in range(n)]


def long_copies(rng):
    """Documents that share stretches of up to forty lines, with single lines changed."""
    base = [f"line {rng.randint(0, 30)}" for _ in range(60)]
    rows = []
    for i in range(12):
        a = rng.randint(0, 30)
        part = base[a : a + rng.randint(5, 40)]
        for _ in range(rng.randint(0, 2)):
            part[rng.randrange(len(part))] = f"other {i}"
        rows.append((50 - i, "\n".join(part)))
    return rows + [(60, "\n".join(["same line"] * 25)), (61, "\n".join(["same line"] * 9))]


@pytest.mark.parametrize("words", [1, 3, 5, 12])
def test_every_run(spark, make_docs, words):
    rows = rows_of(random.Random(words), 60)
    want = brute(rows, words)
    docs = make_docs(rows).withColumn("no", F.lit(1)).withColumn("at", F.lit("clash"))
    got = ld.deduplicated(docs, words)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted((d, want[d, t][2]) for d, t in rows)


def test_lengths_over_many_rounds(spark, make_docs):
    rows = long_copies(random.Random(8))
    lines = ld.placed(ld.line_rows(make_docs(rows)))
    assert len(ld.levels(lines)) >= 5
    docs = {r.doc: r.doc_id for r in lines.collect()}
    got = {(docs[r.doc], r.pos - r.doc): r.length for r in ld.earlier_lengths(lines).collect()}
    want = {(d, i): n for (d, _), lengths in plain_lengths(rows).items() for i, n in enumerate(lengths) if n}
    assert got == want and max(want.values()) > 20


def test_query_with_odd_rows_and_empty(spark, odd_docs, make_docs, as_table):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    ten = "a single line of exactly ten words stands in here"
    more = [
        (-1, "first line of five words\nsecond line of five words\n\nthird"), (20, "x\nfirst line of five words\n \nsecond line of five words"),
        (21, "second line of five words\nfirst line of five words"), (22, "a\na\na\na"), (23, ten), (24, f"before\n{ten}\nafter"), (25, ten),
        (None, ten + "\nelse"), (26, ten.removeprefix("a ")), (27, ten.removeprefix("a ")),
    ]
    want = brute(rows + more, 10)
    folder = as_table(documents=odd_docs.union(make_docs(more)))
    got = sorted((tuple(r) for r in REGISTRY["op9_line_dedup"](spark, folder).collect()), key=str)
    blank = (0, 0, "")
    full = [(d, *want.get((d, t), blank)) for d, t in rows + more]
    assert got == sorted(((d, n, m, hashlib.sha256(x.encode()).hexdigest()) for d, n, m, x in full), key=str)
    assert {d: m for d, _, m, _ in full if d in (23, 24, 25, 26, 27)} == {23: 0, 24: 1, 25: 1, 26: 0, 27: 0}
    assert REGISTRY["op9_line_dedup"](spark, as_table(documents=odd_docs.limit(0))).count() == 0
