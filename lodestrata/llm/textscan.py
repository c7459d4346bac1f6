"""Words of whole texts as 64-bit keys, many texts at once, in numpy.

Texts arrive as the UTF-8 buffer of an Arrow column. A word is a run of bytes of
one class; classes are decided byte by byte, which is exact for the two word
definitions here because every byte of a non-ASCII character is >= 0x80. A-Z are
lower-cased. A word's key is a 64-bit mix of its bytes; two different words get
one key with a chance of about 2**-64 a pair.

Null texts count as empty. Nothing is cut: a text of any length is scanned whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of one Arrow batch, so that a batch of long texts fits a Python worker.
BATCH_ROWS = 512
#: Bytes of text scanned at once, besides single texts that are longer.
SLICE_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Runs between the ASCII white space 09-0D and 20.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: Runs of ASCII letters and digits and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_LONG = 64


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to BATCH_ROWS, if it is higher.

    Also names this package's folder to Python workers that start from now on, for
    drivers that have it on their path only by `sys.path`.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _K2
    h = (h ^ (h >> np.uint64(27))) * _K1
    return h ^ (h >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 bounds of its values."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of texts 0 .. n-1: `first[i]:first[i + 1]` are those of text i."""

    key: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def word_keys(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(
        padded[:8].view(np.uint64), shape=(len(low) + 1,), strides=(1,)
    )
    length = end - start
    h = length.astype(np.uint64) * _K1 + _K2
    at = np.arange(len(start))
    for k in range(0, _LONG, 8):
        at = at[length[at] > k]
        if not len(at):
            break
        part = eight[start[at] + k] & _KEEP[np.minimum(length[at] - k, 8)]
        h[at] = mix(h[at] ^ (part * _K1))
    for i in np.flatnonzero(length > _LONG):
        digest = hashlib.blake2b(low[start[i] : end[i]].tobytes(), digest_size=8).digest()
        h[i] = np.frombuffer(digest, np.uint64)[0]
    return h


def scan(buf: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> Words:
    low = _LOWER[buf]
    inside = np.zeros(len(low) + 2, dtype=bool)
    inside[1:-1] = letters[low]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    filled = bounds[:-1] < bounds[1:]
    heads, tails = bounds[:-1][filled], bounds[1:][filled] - 1
    begins[heads] = inside[heads + 1]
    ends[tails] = inside[tails + 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return Words(word_keys(low, start, end), start, end, np.searchsorted(start, bounds))


def slices(bounds: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of at most `size` bytes, or of one text."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = int(np.searchsorted(bounds, bounds[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def scan_column(
    column: pa.Array, letters: np.ndarray, size: int = SLICE_BYTES
) -> Iterator[tuple[int, int, Words]]:
    buf, bounds = text_buffer(column)
    for lo, hi in slices(bounds, size):
        own = bounds[lo : hi + 1]
        yield lo, hi, scan(buf[own[0] : own[-1]], own - own[0], letters)


def word_key(word: str) -> int:
    """Key of one word, as `scan` gives it."""
    raw = np.frombuffer(word.encode(), np.uint8)
    every = np.ones(256, dtype=bool)
    return int(scan(raw, np.array([0, len(raw)]), every).key[0])


def window_keys(key: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of `n` words within one text, and each run's first word.

    A text of fewer words, but not none, gives its whole sequence as one run.
    """
    count = np.diff(first)
    h = np.zeros(max(len(key) - n + 1, 0), np.uint64)
    for k in range(n):
        h = mix(h + key[k : len(key) - n + 1 + k] * _K1) if len(h) else h
    at = np.arange(len(h))
    if len(h):
        owner = np.searchsorted(first, at, side="right") - 1
        whole = at + n <= first[owner + 1]
        at, h = at[whole], h[whole]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.full(len(short), n, np.uint64)
        for k in range(n - 1):
            has = count[short] > k
            extra[has] = mix(extra[has] + key[first[short[has]] + k] * _K1)
        extra = mix(extra ^ count[short].astype(np.uint64))
        at, h = np.concatenate([at, first[short]]), np.concatenate([h, extra])
        order = np.argsort(at, kind="stable")
        at, h = at[order], h[order]
    return h, at
