"""Token ids as binary shards with keyed access.

Documents are range-partitioned and sorted by key, encoded, and packed into shards of bounded size, one file each, written by
Spark to any store it can write to. A shard is, little-endian:

    magic, id width (2 or 4), partition, number in partition, documents, keys, ids, hash seed, buckets
    displacement of each bucket            4 bytes each
    fingerprint, first document, documents 12 bytes for each slot of the index
    first id of each document, and the end 8 bytes each
    key of each document                   8 bytes, and a byte that is 1 for a null key
    ids

The index is a minimal perfect hash by hash and displace: a key's bucket gives a displacement, which added to the key's second hash gives
its slot; there are as many slots as distinct keys. The fingerprint in the slot tells a key that is not there. A lookup
so touches one displacement, one slot and two offsets, whatever the shard's size.

Nulls and odd rows: a null text is empty; each document ends with END_ID, so an empty one is that alone; null keys come first;
rows with one key stay together in order of their texts' hashes and share a slot, so all are found; an empty table
gives no shards. Other columns are not looked at.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer

from hazeline.llm import words as wd
from hazeline.llm.registry import query, table
from hazeline.llm.stages import materialise, new_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
MAGIC = b"IDSHARD1"
HEADER = "<8sIIIIIQQI"
#: Payload bytes and documents after which a shard is closed.
SHARD_BYTES = 8_000_000
SHARD_DOCS = 50_000
#: Keys to a bucket of the index, on average.
BUCKET_KEYS = 3
#: Words of which a task remembers the ids.
MEMO = 500_000
#: In UTF-8 the letters from U+00C0 to U+00FF are the byte C3 and one from 80 to BF; two of those are no letters.
TIMES, OVER = "\u00d7".encode(), "\u00f7".encode()
LETTERS = bytes(range(ord("a"), ord("z") + 1))
SMALL = LETTERS + bytes(range(0x80, 0xC0)) + b"\xc3"
PLAIN = SMALL + LETTERS.upper() + b" \t\n\r\x0b\x0c.,"
APART = (TIMES, OVER, b"..", b",,", b".,", b",.")
#: Marks that only ever make up one pre-token behind letters: no apostrophe, and nothing a special token holds.
MARKS = b"!\"#$%&()*+,-./:;=?@[]^_`{}~"
#: Capital letters of both kinds to small ones; the second byte of a small one is 20 higher.
LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))


def byte_chars() -> dict[int, int]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}


BYTE_CHARS = byte_chars()


class Encoder(dict):
    """Ids of texts as bytes; one in each task. As a dictionary it remembers those of single words.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words in a row. A word of
    Latin letters, lowered, is one pre-token and needs no other normalisation, so it goes to the model at once, which skips
    most of the tokenizer's work on it; closing marks are a pre-token of their own. A text of Latin letters, full stops and commas without two marks in a row is lowered
    first and its marks are set apart, which leaves fewer different words.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.end = self.packed([END_ID])
        self.width = len(self.end)
        self.of_id = [self.packed([i]) for i in range(self.tokenizer.get_vocab_size())]

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.kind}", *ids)

    def __missing__(self, word: bytes) -> bytes:
        letters = word.rstrip(MARKS).translate(LOWER)
        if letters.isascii() and letters.isalpha():
            found = self.model.tokenize(letters.decode())
        elif not letters or letters.translate(None, SMALL) or TIMES in letters or OVER in letters:
            found = None
        else:
            found = self.model.tokenize(letters.decode("latin-1").translate(BYTE_CHARS))
        if found is None:
            out = self.packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
        else:
            out = b"".join([self.of_id[t.id] for t in found])
            if len(letters) < len(word):
                out += self[word[len(letters):]]
        self[word] = out
        return out

    def words(self, text: str) -> list[bytes]:
        data = text.encode()
        if data.translate(None, PLAIN) or any(pair in data for pair in APART):
            return data.split()
        return data.translate(LOWER).replace(b".", b" . ").replace(b",", b" , ").split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self) > MEMO:
            self.clear()
        return [b"".join(map(self.__getitem__, self.words(t or ""))) + self.end for t in texts]


def key_hashes(keys: np.ndarray, null: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each key: for the bucket and for the slot."""
    start = np.where(null, np.uint64(0x5851F42D4C957F2D), keys.view(np.uint64))
    first = wd.mix(start + np.uint64(seed * wd.ROOT % wd.MODULUS))
    return first, wd.mix(first ^ np.uint64(0x14057B7EF767814F))


def fingerprints(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    return (key_hashes(keys, null, 1 << 20)[1] >> np.uint64(32)).astype("<u4")


def displacements(keys: np.ndarray, null: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacement of each bucket, slot of each key) of a minimal perfect hash of distinct keys."""
    n = len(keys)
    buckets = max(1, n // BUCKET_KEYS)
    for seed in range(1 << 20):
        first, second = key_hashes(keys, null, seed)
        bucket = (first % np.uint64(buckets)).astype(np.int64)
        home = (second % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        begin = np.searchsorted(bucket[order], np.arange(buckets + 1))
        size = np.diff(begin)
        shift = np.zeros(buckets, np.int64)
        slot = np.full(n, -1)
        taken = np.zeros(n, bool)
        free = None
        for b in np.argsort(-size, kind="stable").tolist():
            if not size[b]:
                break
            members = order[begin[b] : begin[b + 1]]
            if size[b] == 1:
                if free is None:
                    free = np.flatnonzero(~taken).tolist()
                d = (free.pop() - int(home[members[0]])) % n
            elif len(np.unique(home[members])) < size[b]:
                break
            else:
                d = first_fit(taken, home[members])
                if d < 0:
                    break
            shift[b] = d
            slot[members] = (home[members] + d) % n
            taken[slot[members]] = True
        if taken.all():
            return seed, shift.astype("<u4"), slot
    raise ValueError("no perfect hash found")


def first_fit(taken: np.ndarray, home: np.ndarray) -> int:
    n = len(taken)
    for at in range(0, n, 256):
        tries = np.arange(at, min(n, at + 256))
        fits = ~taken[(home[:, None] + tries) % n].any(axis=0)
        if fits.any():
            return at + int(fits.argmax())
    return -1


def pack(partition: int, number: int, width: int, keys: list[int | None], payloads: list[bytes]) -> bytes:
    null = np.array([k is None for k in keys])
    key = np.array([k or 0 for k in keys], np.int64)
    opens = np.ones(len(key), bool)
    opens[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
    first = np.flatnonzero(opens)
    seed, shift, slot = displacements(key[first], null[first])
    index = np.zeros((len(first), 3), "<u4")
    index[slot, 0] = fingerprints(key[first], null[first])
    index[slot, 1] = first
    index[slot, 2] = np.diff(np.append(first, len(key)))
    offset = np.zeros(len(key) + 1, "<u8")
    np.cumsum([len(p) // width for p in payloads], out=offset[1:])
    head = struct.pack(HEADER, MAGIC, width, partition, number, len(key), len(first), int(offset[-1]), seed, len(shift))
    return b"".join(
        [head, shift.tobytes(), index.tobytes(), offset.tobytes(), key.astype("<i8").tobytes(), null.astype("u1").tobytes(), *payloads]
    )


@dataclass
class Shard:
    """A shard over the bytes of its file; the arrays are views."""

    partition: int
    number: int
    seed: int
    shift: np.ndarray
    index: np.ndarray
    offset: np.ndarray
    key: np.ndarray
    null: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, data: bytes) -> Shard:
        magic, width, partition, number, docs, keys, ids, seed, buckets = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at, parts = struct.calcsize(HEADER), []
        for kind, count in (("<u4", buckets), ("<u4", 3 * keys), ("<u8", docs + 1), ("<i8", docs), ("u1", docs), (f"<u{width}", ids)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        shift, index, offset, key, null, tokens = parts
        return cls(
            partition, number, seed, shift, index.reshape(-1, 3), offset.astype(np.int64), key.astype(np.int64), null.astype(bool), tokens
        )

    def find(self, keys: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of each key; number 0 where it is not there."""
        n = len(self.index)
        first, second = key_hashes(keys, null, self.seed)
        bucket = (first % np.uint64(len(self.shift))).astype(np.int64)
        slot = ((second % np.uint64(n)).astype(np.int64) + self.shift[bucket]) % n
        row = self.index[slot]
        begin, count = row[:, 1].astype(np.int64), row[:, 2].astype(np.int64)
        same = (row[:, 0] == fingerprints(keys, null)) & (self.null[begin] == null) & (null | (self.key[begin] == keys))
        return begin, np.where(same, count, 0)

    def document(self, number: int) -> np.ndarray:
        return self.ids[self.offset[number] : self.offset[number + 1]]


def shard_batches(spec: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(spec)
        partition = TaskContext.get().partitionId()
        keys: list[int | None] = []
        payloads: list[bytes] = []
        size = number = 0

        def closed() -> pa.RecordBatch:
            data = pack(partition, number, encoder.width, keys, payloads)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        for rows, texts in wd.text_chunks(batches):
            for key, ids in zip(rows.column(0).to_pylist(), encoder.encode(texts), strict=True):
                if keys and (size + len(ids) > SHARD_BYTES or len(keys) >= SHARD_DOCS):
                    yield closed()
                    keys, payloads, size, number = [], [], 0, number + 1
                keys.append(key)
                payloads.append(ids)
                size += len(ids)
        if keys:
            yield closed()

    return run


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str) -> None:
    """Shards of docs (doc_id, text) in a new folder, in ascending order of doc_id over (partition, number)."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    order = ("doc_id", "tie")
    placed = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    )
    # the text writer puts out the bytes of a string as they are and a line feed after each; one row to a file
    (
        placed.mapInArrow(shard_batches(spec), "data binary").select(F.col("data").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1).text(folder)
    )


def document_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of each file, its ids taken through the index under its key."""
    for batch in batches:
        for data in batch.column(0):
            if not len(data.as_buffer()):
                continue
            shard = Shard.of(data.as_buffer())
            begin, count = shard.find(shard.key, shard.null)
            docs = np.arange(len(shard.key))
            if not ((begin <= docs) & (docs < begin + count)).all():
                raise ValueError("an index slot does not lead to its key")
            own = [shard.document(d) for d in docs.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(docs), shard.partition, np.int32)), pa.array(np.full(len(docs), shard.number, np.int32)),
                    pa.array(shard.key, mask=shard.null), pa.array(shard.offset[:-1]), pa.array(np.diff(shard.offset)),
                    pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in own], pa.int64()),
                ],
                names=["partition", "number", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards of a folder."""
    content = spark.read.format("binaryFile").load(folder).select("content")
    schema = "partition int, number int, doc_id long, within long, n_tokens long, ids_crc32 long"
    rows = materialise(content.mapInArrow(document_batches, schema), "shard-documents")
    sizes = rows.groupBy("partition", "number").agg(F.sum("n_tokens").alias("size"))
    # a row for each file, so this window is over a list of files
    before = W.orderBy("partition", "number").rowsBetween(W.unboundedPreceding, -1)
    begins = sizes.select("partition", "number", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    return rows.join(begins, ["partition", "number"]).select(
        "doc_id", (F.col("begin") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            if not len(data.as_buffer()):
                continue
            shard = Shard.of(data.as_buffer())
            null = np.array([k is None for k in wanted])
            key = np.array([k or 0 for k in wanted], np.int64)
            begin, count = shard.find(key, null)
            keys, ids = [], []
            for k, b, c in zip(wanted, begin.tolist(), count.tolist(), strict=True):
                for d in range(b, b + c):
                    keys.append(k)
                    ids.append(shard.document(d).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])


def lookup(spark: SparkSession, folder: str, keys: list[int | None]) -> DataFrame:
    """(doc_id, ids) of the documents with the given keys, a list of the caller's own size."""
    wanted = F.array(*(F.lit(k).cast("long") for k in keys))
    content = spark.read.format("binaryFile").load(folder).select("content", wanted.alias("wanted"))
    return content.mapInArrow(lookup_batches, "doc_id long, ids array<long>")


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    import public_tokenizers

    folder = new_path(spark, "token-shards")
    write_shards(docs, folder, public_tokenizers.path(VOCABULARY))
    return read_documents(spark, folder)


@query("op8_token_shards")
def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, table(spark, sf_dir, "documents"))
