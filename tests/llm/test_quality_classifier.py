import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.llm import quality_classifier as qc
from hazeline.llm.queries import REGISTRY

SF = "/root/testdata/sf0.1"


def network(seed=0):
    rng = np.random.default_rng(seed)
    net = qc.Network.fresh(rng)
    net.bias += rng.normal(0, 0.2, net.bias.shape).astype(np.float32)
    net.offset = 0.3
    return net


def plain_logit(net, text):
    """Window by window and chunk by chunk."""
    blocks = max(1, -(-len(text) // qc.BLOCK))
    data = text + bytes(blocks * qc.BLOCK + qc.WIDTH - len(text))
    answers = [sum(net.filters[j][data[i + j]] for j in range(qc.WIDTH)) + net.bias for i in range(blocks * qc.BLOCK)]
    says = []
    for start in sorted({*range(0, max(0, blocks - qc.SPAN), qc.STRIDE), max(0, blocks - qc.SPAN)}):
        inside = answers[start * qc.BLOCK : min(blocks, start + qc.SPAN) * qc.BLOCK]
        pooled = np.maximum(np.max(inside, axis=0), 0)
        given = np.append(pooled, min(len(text) - start * qc.BLOCK, qc.CHUNK) / qc.CHUNK)
        says.append(float(np.maximum(given @ net.hidden + net.hidden_bias, 0) @ net.out + net.out_bias[0]))
    return net.offset - (np.mean(says) + max(says)) / 2


def test_logits_window_by_window():
    net, rng = network(), np.random.default_rng(2)
    texts = [b"", b"a", bytes(rng.integers(0, 256, 63)), *(bytes(rng.integers(97, 123, n)) for n in (64, 65, 256, 257, 700, 5000))]
    np.testing.assert_allclose(net.logits(texts), [plain_logit(net, t) for t in texts], rtol=2e-4, atol=2e-4)


def test_gradients_by_difference():
    net, rng = network(3), np.random.default_rng(4)
    size = np.array([256, 200, 256, 30, 0])
    chunks = rng.integers(97, 123, (5, qc.CHUNK + qc.WIDTH - 1)).astype(np.uint8)
    for c, n in zip(chunks, size):
        c[n if n < qc.CHUNK else len(c) :] = 0
    first, low = np.array([0, 3, 4, 5]), np.array([1, 0, 1], np.float32)

    def loss():
        texts_logit = []
        for d in range(3):
            says = []
            for c in range(first[d], first[d + 1]):
                shown = max(1, -(-size[c] // qc.BLOCK)) * qc.BLOCK
                answers = [sum(net.filters[j][chunks[c, i + j]] for j in range(qc.WIDTH)) + net.bias for i in range(shown)]
                given = np.append(np.maximum(np.max(answers, axis=0), 0), size[c] / qc.CHUNK)
                says.append(float(np.maximum(given @ net.hidden + net.hidden_bias, 0) @ net.out + net.out_bias[0]))
            texts_logit.append((np.mean(says) + max(says)) / 2)
        p = 1 / (1 + np.exp(-np.array(texts_logit)))
        return -np.mean(low * np.log(p) + (1 - low) * np.log(1 - p))

    for layer in net.layers():  # steps of 1e-5 need double precision
        assert layer.dtype == np.float32
    net.filters, net.bias, net.hidden, net.hidden_bias, net.out, net.out_bias = (x.astype(np.float64) for x in net.layers())
    found = qc.gradients(net, chunks, size, first, low)
    for layer, grad in zip(net.layers(), found):
        for cell in np.argsort(-np.abs(grad), axis=None)[:3]:
            flat = layer.reshape(-1)
            before, step = flat[cell], 1e-5
            flat[cell] = before + step
            up = loss()
            flat[cell] = before - step
            down = loss()
            flat[cell] = before
            assert (up - down) / (2 * step) == pytest.approx(grad.reshape(-1)[cell], rel=0.02, abs=1e-5)


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, qc.fitted(docs, labels)


def test_held_out_accuracy(fitted):
    docs, labels, net = fitted
    rows = qc.scored(docs.join(labels, "doc_id").where(qc.held_out()), ["doc_id", "quality"], net).collect()
    scores = {q: np.array([r["__score"] for r in rows if r.quality == q]) for q in (0, 1)}
    assert len(scores[0]) > 100 and len(scores[1]) > 600
    above = (scores[1][:, None] > scores[0]).mean() + (scores[1][:, None] == scores[0]).mean() / 2
    assert above > 0.97
    assert (scores[1] >= qc.THRESHOLD).mean() > 0.98 and (scores[0] < qc.THRESHOLD).mean() > 0.85


def test_end_of_a_long_text_counts(spark, fitted):
    docs, _, net = fitted
    clean = docs.where("lang = 'en' AND n_chars BETWEEN 3000 AND 8000").orderBy("doc_id").limit(200)
    texts = [r.text.encode() for r in clean.collect()]
    good = [t for t, s in zip(texts, net.scores(texts)) if s > 0.95][:40]
    junk = b" ".join(b"whing### theon$$$ stand%%% ofthe&&&".split() * 60)
    assert len(good) == 40
    assert (net.scores([t + b"\n" + junk for t in good]) < net.scores(good)).all()


def test_only_training_rows_are_read(spark, make_docs):
    rows = [(i, f"text number {i} " * 9) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    sample, odds = qc.training_sample(make_docs(rows), labels)
    kept = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert len(sample.low) == len(kept) and sample.low.sum() == sum(i % 2 == 0 for i in kept)
    assert odds == pytest.approx(np.log(sum(i % 2 for i in kept) / sum(i % 2 == 0 for i in kept)))


def test_query_with_odd_rows_and_without_labels(spark, odd_docs, as_table):
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 0), (6, None, 0), (7, 0, 1), (None, 1, 0), (8, 1, 0), (9, 1, 1)], schema)
    docs = odd_docs.withColumn("score", F.lit("clash")).withColumn("quality", F.lit(3))
    got = REGISTRY["op12_quality_classifier"](spark, as_table(documents=docs, labels=labels)).collect()
    assert sorted((str(r.doc_id) for r in got)) == sorted(str(r.doc_id) for r in odd_docs.collect())
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
    none = REGISTRY["op12_quality_classifier"](spark, as_table(documents=docs, labels=labels.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    one = REGISTRY["op12_quality_classifier"](spark, as_table(documents=docs, labels=labels.where("quality = 1"))).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.7
    assert REGISTRY["op12_quality_classifier"](spark, as_table(documents=docs.limit(0), labels=labels)).count() == 0
