"""Quality score of a text by a small convolutional network over its bytes.

Every byte of the whole text is the beginning of a window of WIDTH bytes, and FILTERS learned filters look at each window. Their answers are
max-pooled over chunks of CHUNK bytes that overlap by half; the last chunk ends with the text. A hidden layer turns the pooled answers of a chunk,
and the part of the chunk that the text fills, into the chunk's evidence, and the mean and the largest evidence of all chunks make one logit.
A filter's weights are a table by place and byte, so no multiplication is needed: a window's answer is the sum of WIDTH table rows.

The network is trained with Adam on the driver, in numpy, on a bounded sample: at most SAMPLE_DOCS documents of each label, those with the smallest
hash of their id, and at most TRAIN_CHUNKS chunks of each, evenly spread; chunks are cut in the tasks, so no whole text reaches the driver. Only
labels whose document has a checksum remainder other than HELD_OUT are read. The sample holds both labels alike; the shares of the labels among
all training labels enter as an offset afterwards, so scores are probabilities for the corpus. Texts are scored whole, in runs of a few megabytes.

Nulls and odd rows: a null text is empty; an empty text is one chunk without bytes and has a score; a null doc_id has the checksum of an empty
string and no label; null labels are not used, of repeated ones each counts; without labels of both kinds every text has the same score, that of
half a label of each kind more; an empty table gives an empty result. Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import words as wd
from hazeline.llm.registry import query, table

WIDTH = 5
FILTERS = 24
HIDDEN = 16
#: Bytes pooled at a time, and blocks in a chunk; a chunk begins every second block.
BLOCK = 64
SPAN = 4
STRIDE = 2
CHUNK = BLOCK * SPAN
#: Bounds of the training sample.
SAMPLE_DOCS = 800
TRAIN_CHUNKS = 8
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
EPOCHS = 16
BATCH = 32
RATE = 0.004
#: Windows whose answers are held at a time; a whole number of blocks.
HELD = 64 * BLOCK


def chunk_starts(blocks: int) -> np.ndarray:
    """First blocks of the chunks of a text: every STRIDE blocks, and the last one flush with the end."""
    last = max(0, blocks - SPAN)
    return np.append(np.arange(0, last, STRIDE), last)


@dataclass
class Network:
    """filters: (WIDTH, 256, FILTERS); the rest are the layers behind the pooling; offset is added to the logit of label 1."""

    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    offset: float = 0.0

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        def draw(scale: float, *shape: int) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return Network(
            draw(0.3, WIDTH, 256, FILTERS), np.zeros(FILTERS, np.float32), draw(0.3, FILTERS + 1, HIDDEN),
            np.zeros(HIDDEN, np.float32), draw(0.3, HIDDEN), np.zeros(1, np.float32),
        )

    def layers(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def evidence(self, pooled: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What chunks say, with the inputs and outputs of the hidden layer."""
        given = np.concatenate((pooled, filled[:, None]), axis=1).astype(np.float32)
        inner = np.maximum(given @ self.hidden + self.hidden_bias, 0)
        return inner @ self.out + self.out_bias, given, inner

    def pooled_blocks(self, data: np.ndarray) -> np.ndarray:
        """The largest answers inside each block of a run of bytes, WIDTH - 1 more bytes than blocks fill."""
        n = len(data) - WIDTH + 1
        out = np.empty((n // BLOCK, FILTERS), np.float32)
        row = np.empty((HELD, FILTERS), np.float32)
        for at in range(0, n, HELD):
            end = min(n, at + HELD)
            total = self.filters[0].take(data[at:end], axis=0)
            for j in range(1, WIDTH):
                total += self.filters[j].take(data[at + j : end + j], axis=0, out=row[: end - at], mode="clip")
            out[at // BLOCK : end // BLOCK] = total.reshape(-1, BLOCK, FILTERS).max(axis=1)
        return np.maximum(out + self.bias, 0)

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """For each whole text the logit of label 1."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        blocks = np.maximum(1, -(-size // BLOCK))
        begin = np.cumsum(blocks) - blocks
        # windows may look into the next text's first bytes, so each text has a block's worth of zeros behind it
        room = begin + np.arange(len(texts))
        data = np.zeros((blocks.sum() + len(texts)) * BLOCK + WIDTH - 1, np.uint8)
        for text, at in zip(texts, (room * BLOCK).tolist(), strict=True):
            data[at : at + len(text)] = np.frombuffer(text, np.uint8)
        pooled = self.pooled_blocks(data)
        starts = [chunk_starts(b) for b in blocks.tolist()]
        first = np.cumsum([0] + [len(s) for s in starts])
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        start = np.concatenate(starts)
        best = np.zeros((len(start), FILTERS), np.float32)
        for k in range(SPAN):
            np.maximum(best, pooled[room[owner] + np.minimum(start + k, blocks[owner] - 1)], out=best)
        says, _, _ = self.evidence(best, np.minimum(size[owner] - start * BLOCK, CHUNK) / CHUNK)
        mean = np.add.reduceat(says, first[:-1]) / np.diff(first)
        return (mean + np.maximum.reduceat(says, first[:-1])) / 2 * -1 + self.offset

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts).astype(np.float64), -60, 60)))


@dataclass
class Sample:
    """Chunks of documents as bytes, filled up with zeros; first: where each document's chunks begin, and their end; low: 1 for label 0."""

    chunks: np.ndarray
    size: np.ndarray
    first: np.ndarray
    low: np.ndarray


def gradients(net: Network, chunks: np.ndarray, size: np.ndarray, first: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy over the documents, in the order of ``layers``."""
    answers = net.filters[0].take(chunks[:, :CHUNK], axis=0)
    for j in range(1, WIDTH):
        answers += net.filters[j].take(chunks[:, j : j + CHUNK], axis=0)
    # windows that begin behind the last block of a short text do not count
    outside = np.arange(CHUNK) >= np.maximum(BLOCK, -(-size // BLOCK) * BLOCK)[:, None]
    answers[outside] = -np.inf
    at = answers.argmax(axis=1)
    raw = np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0] + net.bias
    says, given, inner = net.evidence(np.maximum(raw, 0), size / CHUNK)
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    most = np.maximum.reduceat(says, first[:-1])
    logit = (np.add.reduceat(says, first[:-1]) / count + most) / 2
    off = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - low) / len(count)
    is_most = says == most[owner]
    ties = np.add.reduceat(is_most.astype(np.float32), first[:-1])
    to_chunk = (off[owner] * (1 / count[owner] + is_most / ties[owner]) / 2).astype(np.float32)
    to_inner = to_chunk[:, None] * net.out * (inner > 0)
    to_raw = (to_inner @ net.hidden.T)[:, :FILTERS] * (raw > 0)
    to_filters = np.empty_like(net.filters)
    number, row = np.arange(FILTERS), np.arange(len(chunks))[:, None]
    for j in range(WIDTH):
        cell = chunks[row, at + j].astype(np.int64) * FILTERS + number
        to_filters[j] = np.bincount(cell.ravel(), to_raw.ravel(), 256 * FILTERS).reshape(256, FILTERS)
    return [
        to_filters, to_raw.sum(axis=0), given.T @ to_inner, to_inner.sum(axis=0), inner.T @ to_chunk,
        to_chunk.sum(keepdims=True),
    ]


def trained(sample: Sample, offset: float, epochs: int = EPOCHS) -> Network:
    rng = np.random.default_rng(1)
    net = Network.fresh(rng)
    moment = [(np.zeros_like(x), np.zeros_like(x)) for x in net.layers()]
    turn, n = 0, len(sample.low)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(n)
        for begin in range(0, n, BATCH):
            part = order[begin : begin + BATCH]
            rows = np.concatenate([np.arange(sample.first[d], sample.first[d + 1]) for d in part])
            first = np.cumsum([0] + [sample.first[d + 1] - sample.first[d] for d in part])
            turn += 1
            found = gradients(net, sample.chunks[rows], sample.size[rows], first, sample.low[part])
            for layer, grad, (m, v) in zip(net.layers(), found, moment, strict=True):
                m += (1 - 0.9) * (grad - m)
                v += (1 - 0.99) * (grad * grad - v)
                layer -= (rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)).astype(np.float32)
    net.offset = offset
    return net


def checksum() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))


def held_out() -> Column:
    return checksum() % FOLDS == HELD_OUT


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most TRAIN_CHUNKS chunks of each text, one behind the other, with WIDTH - 1 bytes more, and their sizes."""
    for rows, texts in wd.text_chunks(batches):
        data, sizes = [], []
        for text in texts:
            raw = (text or "").encode()
            starts = chunk_starts(max(1, -(-len(raw) // BLOCK)))
            picked = starts[np.unique(np.linspace(0, len(starts) - 1, min(TRAIN_CHUNKS, len(starts))).round().astype(int))] * BLOCK
            data.append(b"".join(raw[s : s + CHUNK + WIDTH - 1].ljust(CHUNK + WIDTH - 1, b"\0") for s in picked.tolist()))
            sizes.append(np.minimum(len(raw) - picked, CHUNK).tolist())
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(data, pa.binary()), pa.array(sizes, pa.list_(pa.int64()))],
            names=["doc_id", "quality", "data", "sizes"],
        )


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[Sample | None, float]:
    """The sample, None unless both labels occur, and the log odds of label 1 among all training labels."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out()).select("doc_id", "quality")
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    high, low = counts.get(1, 0), counts.get(0, 0)
    spare = 0 if high and low else 0.5
    odds = float(np.log((high + spare) / (low + spare)))
    if spare:
        return None, odds
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    chosen = [known.where(F.col("quality") == q).orderBy(*by_hash).limit(SAMPLE_DOCS) for q in (0, 1)]
    # at most 2 * SAMPLE_DOCS rows
    picked = F.broadcast(chosen[0].union(chosen[1]))
    rows = (
        docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "quality", "text")
        .mapInArrow(cut_batches, "doc_id long, quality int, data binary, sizes array<long>").collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.quality, r.data))
    if len({r.quality for r in rows}) < 2:
        return None, odds
    first = np.cumsum([0] + [len(r.sizes) for r in rows])
    chunks = np.frombuffer(b"".join(bytes(r.data) for r in rows), np.uint8).reshape(-1, CHUNK + WIDTH - 1)
    is_low = np.array([1 - r.quality for r in rows], np.float32)
    return Sample(chunks, np.array([n for r in rows for n in r.sizes]), first, is_low), odds


def fitted(docs: DataFrame, labels: DataFrame) -> Network:
    """The network for documents (doc_id, text) and labels (doc_id, quality)."""
    sample, odds = training_sample(docs, labels)
    if sample is None:
        net = Network.fresh(np.random.default_rng(1))
        net.out[:] = 0
        net.offset = odds
        return net
    in_sample = float(np.log((1 - sample.low).sum() / sample.low.sum()))
    return trained(sample, odds - in_sample)


def score_batches(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in wd.text_chunks(batches, "__text"):
            keep = [n for n in rows.schema.names if n != "__text"]
            scores = net.scores([(t or "").encode() for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(rows.schema.get_field_index(n)) for n in keep), pa.array(scores)], names=[*keep, "__score"]
            )

    return run


def scored(docs: DataFrame, carry: list[str], net: Network) -> DataFrame:
    """The named columns and ``__score``, the probability of label 1."""
    given = docs.select(*(F.col(f"`{c}`") for c in carry), F.col("text").alias("__text"))
    fields = [docs.schema[c] for c in carry] + [T.StructField("__score", T.DoubleType())]
    return given.mapInArrow(score_batches(net), T.StructType(fields))


@query("op12_quality_classifier")
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fitted(docs, table(spark, sf_dir, "labels"))
    return scored(docs, ["doc_id"], net).select(
        "doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )
