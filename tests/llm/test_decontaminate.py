import hashlib
import random
import re

from pyspark.sql import functions as F

from hazeline.llm import decontaminate as dc
from hazeline.llm.queries import REGISTRY

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for d, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for item, other in items:
            theirs = plain_words(other)
            k = min(10, len(theirs))
            windows = {tuple(theirs[i : i + k]) for i in range(len(theirs) - k + 1)} if k else set()
            for p in range(len(words) - k + 1) if k else ():
                if tuple(words[p : p + k]) in windows:
                    hit.update(range(p, p + k))
                    found.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def check(spark, folder, docs, items):
    got = REGISTRY["op3_decontaminate"](spark, folder)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_every_window_is_found(spark, make_docs, as_table):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(6)]  # few words: repeats, ties and overlaps everywhere
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 3, 4, 5, 5, 9, 10, 11, 25, 40])] + [(7, text(12)), (None, text(10))]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    for i in range(60, 120):  # passages cut out of items, of just under and over the window
        words_of = items[rng.randrange(6, len(items))][1].split()
        begin = rng.randrange(len(words_of))
        docs.append((i, f"{text(3)} Zz {' '.join(words_of[begin:begin + rng.randint(8, 14)]).upper()}, zz {text(2)}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    check(spark, as_table(documents=make_docs(docs), benchmark=bench), docs, items)


def test_odd_rows_and_empty_tables(spark, odd_docs, as_table):
    items = [(1, None), (2, ""), (3, "lone ROW"), (3, "ça va 你好 世界"), (None, "same text")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit("clash"))
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(spark, as_table(documents=odd_docs.withColumn("__items2", F.lit(0)), benchmark=bench), docs, items)
    check(spark, as_table(documents=odd_docs, benchmark=bench.limit(0)), docs, [])
    check(spark, as_table(documents=odd_docs.limit(0), benchmark=bench), [], items)


def test_full_bitmap_changes_nothing(spark, make_docs, as_table, monkeypatch):
    import numpy as np

    full = lambda prints: (np.full(dc.BUCKETS * dc.BUCKET_BITS // 8, 255, np.uint8), [0, 3])
    monkeypatch.setattr(dc, "bitmap_of", full)
    docs = [(1, " ".join(f"a{i}" for i in range(30))), (2, "x y z"), (3, "y z x")]
    items = [(1, " ".join(f"a{i}" for i in range(12, 24))), (2, "x y z")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    check(spark, as_table(documents=make_docs(docs), benchmark=bench), docs, items)


def test_clean_documents_stay(spark, make_docs):
    docs = make_docs([(1, "a b c d e"), (2, "z z z"), (3, None)]).withColumn("kind", F.lit(4)).withColumn("item", F.lit("i"))
    bench = spark.createDataFrame([(1, "C D")], "item_id long, text string")
    kept = dc.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
