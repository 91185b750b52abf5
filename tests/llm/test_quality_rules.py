from pyspark.sql import functions as F

from hazeline.llm import quality_rules as qr
from hazeline.llm.queries import REGISTRY


def plain_counts(text):
    ws = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in (text or "") + " ":
        if c in ws:
            words, word = words + [word] if word else words, ""
        else:
            word += c
    lines = [x for x in (text or "").split("\n") if x.strip(ws)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {q for i, w in enumerate(windows) if windows.count(w) > 1 for q in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)
    )


def test_counts_by_hand(spark, odd_docs, make_docs, as_table):
    rows = [
        (1, "a b c d e f a b c d e\n\na b\na b\n \n"), (2, "Ä ö|ü #x 你好 世\x1cz\n x"), (3, "# \n#\n#"),
        (4, " ".join(["x"] * 12)), (5, None), (6, "a\x0bb\x0cc\rd"),
    ]
    got = {r.doc_id: r for r in REGISTRY["op7_quality_rules"](spark, as_table(documents=make_docs(rows))).collect()}
    for doc, text in rows:
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def test_thresholds_follow_the_group(spark, make_docs):
    plain = " ".join(f"word{i}" for i in range(40))
    coded = " ".join(f"word{i}#" for i in range(40))
    rows = [(i, plain.replace("word", f"w{i}d"), "en", "prose") for i in range(60)]
    rows += [(100 + i, coded.replace("word", f"w{i}d"), "en", "code") for i in range(60)]
    rows += [(200, coded, "en", "prose"), (201, coded, "en", "code"), (202, plain, "en", "tiny")]
    kept = {r.doc_id for r in qr.kept_documents(make_docs(rows)).collect()}
    assert kept == {r[0] for r in rows} - {200}


def test_sketches_merge_exactly(spark, make_docs):
    rows = [(i, " ".join(f"{'x' * (i % 9)}{j}" for j in range(12)), "en", f"s{i % 3}") for i in range(90)]
    docs = make_docs(rows)
    whole = qr.quantile_sketches(qr.measured(docs, ["lang", "source"]))
    parts = [qr.quantile_sketches(qr.measured(docs.where(f"doc_id % 2 = {k}"), ["lang", "source"])) for k in (0, 1)]
    merged = parts[0].union(parts[1]).groupBy("lang", "source", "measure", "edge").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))


def test_odd_rows_and_empty(spark, odd_docs, as_table):
    got = REGISTRY["op7_quality_rules"](spark, as_table(documents=odd_docs.withColumn("measure", F.lit("clash"))))
    assert got.count() == odd_docs.count()
    assert {r.doc_id for r in got.where("base_failed").collect()} >= {1, 2, 3, 8}
    assert REGISTRY["op7_quality_rules"](spark, as_table(documents=odd_docs.limit(0))).count() == 0
    docs = odd_docs.withColumn("low", F.lit(1)).withColumn("lang2", F.lit("x"))
    assert qr.kept_documents(docs).columns == docs.columns
