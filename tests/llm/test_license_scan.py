import pytest
from pyspark.sql import functions as F

from hazeline.llm import license_scan as ls
from hazeline.llm.queries import REGISTRY

PLAIN = "thing onre the of an erst heed\nmore of the same here and there\nno end of it yet"


@pytest.fixture(scope="module")
def model(spark, make_docs):
    return ls.train(spark, make_docs([(i, PLAIN.replace("the", f"w{i}")) for i in range(40)]))


def families(docs, model):
    found = ls.scanned(docs, model).select("doc_id", F.transform("__licences", lambda x: x["family"]).alias("f"))
    return {r.doc_id: r.f for r in found.collect()}


def test_held_out_accuracy(spark, make_docs, model):
    rows = ls.training_rows(spark, make_docs([(i, PLAIN) for i in range(5)])).where("held_out").collect()
    docs = make_docs([(i, " ".join(r.words)) for i, r in enumerate(rows)])
    got = families(docs, model)
    right = sum((got[i] or [ls.UNKNOWN])[0] == r.family for i, r in enumerate(rows))
    wrong = sum(bool(got[i]) and got[i][0] != r.family for i, r in enumerate(rows))
    # variants that lost many words find no template to confirm them
    assert right >= 0.8 * len(rows) and wrong <= 0.01 * len(rows)


def test_notices_and_plain_text(make_docs, model):
    docs = make_docs(
        [
            (1, f"{PLAIN}\nThis file: Released under the MIT License.\n{PLAIN}"),
            (2, "Licensed under CC BY-NC 4.0.\n\nLicensed under the Apache License, Version 2.0 (the \"License\");"),
            (3, "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3."),
            (4, "She renewed her driving license in the public office.\nLicensed under the Zebra Terms, version 9."),
            (5, PLAIN), (6, None), (7, ""), (8, "x " * 40_000 + "\nReleased under the BSD 3-Clause License"),
        ]
    ).withColumn("pairs", F.lit("clash"))
    got = families(docs, model)
    assert got == {1: ["MIT"], 2: ["CC-BY-NC", "Apache-2.0"], 3: ["GPL"], 4: [], 5: [], 6: None, 7: [], 8: ["BSD"]}


def test_query_odd_rows_and_empty(spark, odd_docs, as_table):
    got = REGISTRY["op1_license_scan"](spark, as_table(documents=odd_docs)).collect()
    assert len(got) == odd_docs.count() and all(r.n_licences == 0 and r.families == "" for r in got)
    assert {r.doc_id: r.n_paragraphs for r in got}[1] == 0
    assert REGISTRY["op1_license_scan"](spark, as_table(documents=odd_docs.limit(0))).count() == 0


def test_plan_is_native(make_docs, model):
    plan = ls.scanned(make_docs([(1, "a")]), model)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_no_confirmed_line_is_without_a_telling_word():
    ordinary = {"the", "under", "of", "and", "this", "to", "in", "released", "license", "cc", "by", "4", "0", "mit"}
    telling = set(ls.telling_words(ordinary))
    for texts in ls.TEMPLATES.values():
        for t in texts:
            words = ls.plain_words(t)
            pairs = set(zip(words, words[1:]))
            assert sum(bool(telling & set(p)) for p in pairs) > (1 - ls.CONFIRM) * len(pairs)
