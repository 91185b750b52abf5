"""Words of many texts at once: hashing and windows over numpy arrays inside a task.

Texts come in Arrow batches; ``text_chunks`` cuts those into runs of at most a few megabytes, so a task holds
one run of texts and its arrays, or a single longer text, whatever the batch size is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000
ROOT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
MODULUS = 1 << 64


class Powers:
    """Powers of ROOT and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            step = np.full(size, ROOT, np.uint64)
            step[0] = 1
            self.up = np.multiply.accumulate(step)
            step = np.full(size, pow(ROOT, -1, MODULUS), np.uint64)
            step[0] = 1
            self.down = np.multiply.accumulate(step)
        return self.up[:n], self.down[:n]


def byte_table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Content hashes of words and of word windows: equal content, equal number, on every executor."""

    def __init__(self):
        self.powers = Powers()
        self.table = byte_table()

    def words(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        data = np.frombuffer(b" ".join(words), np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        up, down = self.powers.to(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * up[:-1], out=total[1:])
        start = end - size
        return mix((total[end] - total[start]) * down[start] + size.astype(np.uint64))

    def windows(self, names: np.ndarray, k: int) -> np.ndarray:
        """Hash of every k names in a row; empty if there are fewer."""
        if len(names) < k:
            return np.zeros(0, np.uint64)
        up, down = self.powers.to(len(names) + 1)
        total = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(names * up[:-1], out=total[1:])
        return mix((total[k:] - total[:-k]) * down[: len(names) - k + 1] + np.uint64(k))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """(rows, their texts as str or None), in runs of bounded size."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        size = texts.nbytes // max(1, len(texts)) + 1
        step = max(1, CHUNK_BYTES // (4 * size))
        for at in range(0, batch.num_rows, step):
            part, values = batch.slice(at, step), texts.slice(at, step).to_pylist()
            begin = total = 0
            for i, value in enumerate(values):
                if total and total + len(value or "") > CHUNK_BYTES:
                    yield part.slice(begin, i - begin), values[begin:i]
                    begin, total = i, 0
                total += len(value or "")
            if begin < len(values):
                yield part.slice(begin), values[begin:]


def flat(lists: list[list]) -> tuple[list, np.ndarray]:
    """All items in a row, and the place where each list begins (one more at the end)."""
    begin = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)), out=begin[1:])
    return [x for items in lists for x in items], begin


def owners(begin: np.ndarray) -> np.ndarray:
    """For each item the number of its list."""
    return np.repeat(np.arange(len(begin) - 1), np.diff(begin))
