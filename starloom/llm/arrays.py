"""Whole Arrow batches of text as flat numpy arrays: words, their hashes and where they lie.

A batch is looked at as one run of UTF-8 bytes, so the cost per document is a few slices and
not a Python loop over words. Work is cut at document borders into runs of a few MB, which
bounds the memory by the longest document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

RUN_BYTES = 1 << 20
#: Bytes of an Arrow batch; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
DEFAULT_BATCH = "67108864b"

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z to a-z; other code points stay

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_PRIME = 0x9E3779B97F4A7C15 | 1
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def power(n: int, sign: int = 1) -> np.ndarray:
    """The first ``n`` powers (``sign=-1``: of the inverse) of an odd number modulo 2**64."""
    known = _powers[sign]
    if len(known) < n:
        base = _PRIME if sign == 1 else pow(_PRIME, -1, 1 << 64)
        grown = np.full(max(n, 2 * len(known), RUN_BYTES), base, np.uint64)
        grown[0] = 1
        known = _powers[sign] = np.multiply.accumulate(grown)
    return known[:n]


def quick_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of all words at once. They are sums of letters times powers modulo 2**64, so there
    are words built to collide; good for features, not for telling texts apart."""
    n = len(data)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * power(n), out=sums[1:])
    value = (sums[end] - sums[start]) * power(n, -1)[start]
    return mix(value + (end - start).astype(np.uint64))


def sound_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of all words at once, as sums of letters times a random number of their place in
    the word: there is no relation between places that words could be built on."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    change = np.zeros(len(data) + 1, np.int8)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    letters = data[np.cumsum(change[:-1], dtype=np.int8) > 0]
    last = np.cumsum(length)
    first = last - length
    place = np.arange(last[-1]) - np.repeat(first, length)
    factor = mix(np.arange(1, int(length.max()) + 1, dtype=np.uint64) * np.uint64(_PRIME)) | np.uint64(1)
    sums = np.zeros(last[-1] + 1, np.uint64)
    np.cumsum(_BYTE[letters] * factor[place], out=sums[1:])
    return mix(sums[last] - sums[first] + length.astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold at most ``BATCH_BYTES``. By default 64 MB of text
    lie in a batch, several times over on both sides of the pipe to Python."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    # A size that the user chose stays.
    if spark.conf.get(name) == DEFAULT_BATCH:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, ends, data = column.buffers()
    if len(column) == 0 or ends is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes, one document at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


@dataclass
class Words:
    """Words in text order: byte range in the run, document in the run, hash; per document
    ``at[d]:at[d + 1]`` are its words."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    at: np.ndarray


def words(
    data: np.ndarray,
    offsets: np.ndarray,
    separators: np.ndarray = WHITE,
    hashes: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] = quick_hashes,
) -> Words:
    """The runs of bytes that are no separators; a document's border ends a word."""
    n, docs = len(data), len(offsets) - 1
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(np.uint64), np.zeros(docs + 1, np.int64))
    inside = ~separators[data]
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    begins = inside & (~before | first)
    last = np.empty(n, bool)  # of its word
    last[-1], last[:-1] = True, ~inside[1:] | first[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(inside & last) + 1
    at = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(docs), np.diff(at))
    return Words(start, end, doc, hashes(data, start, end), at)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``size`` words, ``at`` per document); a document of fewer words,
    but not none, has one: all its words."""
    docs, n = len(w.at) - 1, np.diff(w.at)
    salt = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    total = len(w.hash)
    if total == 0:
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    value = np.zeros(total, np.uint64)
    for k in range(min(size, total)):
        part = w.hash[k:] * salt[k]
        same = w.doc[k:] == w.doc[: total - k]
        value[: total - k] += np.where(same, part, np.uint64(0))
    left = w.at[1:][w.doc] - np.arange(total)  # words from here to the document's end
    whole = (left >= size) | ((n[w.doc] < size) & (left == n[w.doc]))
    value = mix(value + np.minimum(left, size).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    at = np.concatenate([[0], np.cumsum(np.bincount(w.doc[whole], minlength=docs))])
    return value[whole], at
