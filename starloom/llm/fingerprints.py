"""Order MinHash: fingerprints that follow edit distance.

A text's k-mers are numbered by occurrence, so that repetition counts. Each coordinate of the
fingerprint has a hash function of its own over (k-mer, occurrence): the ``PICKED`` smallest
are selected, put back into text order, and their k-mers are hashed as a tuple. Two texts
agree in a coordinate if they share these k-mers in the same order, so moved passages count as
edits, which a plain MinHash cannot see.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrays import bound_batches, mix
from starloom.llm.ranges import spread

#: Code points of a k-mer, coordinates, k-mers selected for each.
K, COORDINATES, PICKED = 8, 64, 2
#: Elements expected under the first threshold of a coordinate; where fewer than PICKED turn
#: up, the threshold is raised.
EXPECTED = 12

_rng = np.random.Generator(np.random.PCG64(7))
_XOR = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)[:, None]
_TIMES = (_rng.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * 2 + 1)[:, None]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = 2048


def _kmers(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of K code points; a shorter text, but not an empty one, is
    one run."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.uint64)
    size = min(K, n)
    value = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        value = value * _BASE + points[k : n - size + 1 + k]
    return mix(value + np.uint64(size))


def _occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value stands before its place."""
    n = len(values)
    bits = max(1, (n - 1).bit_length())
    # Values and places in one number sort faster than an argsort; the value keeps 64 - bits.
    packed = np.sort((values >> np.uint64(bits) << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
    group = packed >> np.uint64(bits)
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    number = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
    out = np.empty(n, np.uint64)
    out[(packed & np.uint64((1 << bits) - 1)).astype(np.int64)] = number
    return out


def _below(base: np.ndarray, first: int, limit: int, bits: int) -> np.ndarray:
    """Elements from place ``first`` on whose hash is at most ``limit``, as one number each of
    coordinate (6 bits), hash and place (``bits``)."""
    found = []
    for a in range(first, len(base), _STEP):
        value = base[None, a : a + _STEP] ^ _XOR
        value *= _TIMES
        at = np.flatnonzero(value <= np.uint32(limit))
        row, place = np.divmod(at, value.shape[1])
        hashes = value.ravel()[at].astype(np.uint64) >> np.uint64(bits - 26) << np.uint64(bits)
        found.append(row.astype(np.uint64) << np.uint64(58) | hashes | (place + a).astype(np.uint64))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


@dataclass
class Sketch:
    """The coordinates of a text, and what a text with the same beginning can share."""

    coordinates: np.ndarray
    limit: int
    bits: int
    candidates: np.ndarray


_EMPTY = Sketch(np.zeros(COORDINATES, np.uint32), 0, 0, np.zeros(0, np.uint64))


def sketch(text: str | None, like: Sketch = _EMPTY, same: int = 0) -> Sketch:
    """The sketch of a text; null counts as empty. The first ``same`` code points are those of
    the text that ``like`` was made of: their k-mers are not hashed again."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    values = _kmers(points.astype(np.uint64))
    n = len(values)
    if n == 0:
        return _EMPTY
    bits = max(26, n.bit_length())
    places = np.uint64((1 << bits) - 1)
    numbered = mix(values + _occurrences(values) * np.uint64(0xD1B54A32D192ED03))
    base = (numbered ^ (numbered >> np.uint64(32))).astype(np.uint32)
    picked, limit, known = min(PICKED, n), min(0xFFFFFFFF, (EXPECTED << 32) // n), like.candidates
    shared = max(0, same - K + 1)
    if shared and like.bits == bits:
        limit = like.limit
        known = known[(known & places) < np.uint64(shared)]
    else:
        shared, known = 0, known[:0]
    while True:
        found = np.concatenate([known, _below(base, shared, limit, bits)])
        counts = np.bincount((found >> np.uint64(58)).astype(np.int64), minlength=COORDINATES)
        if limit == 0xFFFFFFFF or counts.min() >= picked:
            break
        limit, shared, known = min(0xFFFFFFFF, limit * 8), 0, known[:0]
    # Smallest hash first, ties by place; the first ``picked`` of each coordinate.
    order = np.sort(found)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    chosen = order[first[:, None] + np.arange(picked)] & places
    chosen = np.sort(chosen.astype(np.int64), axis=1)
    out = np.arange(1, COORDINATES + 1, dtype=np.uint64)
    for k in range(picked):
        out = mix(out * _BASE + values[chosen[:, k]])
    return Sketch((out >> np.uint64(32)).astype(np.uint32), limit, bits, found)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal coordinates, 0 to 1."""
    return float(np.count_nonzero(a == b)) / COORDINATES


def written(coordinates: np.ndarray) -> str:
    """A fingerprint as text: eight hex digits per coordinate."""
    return coordinates.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text whose last quarter is replaced by the beginning of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_ROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, id, ahead, text) in order: each own row with the row behind it.

    Holds one document back, whatever the size of the partition.
    """
    held = None
    for batch in batches:
        out = []
        for part, doc, ahead, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            now = (part, doc, ahead, text, sketch(text))
            if held is not None and held[0] == part and not held[2]:
                out.append(_row(held, now))
            held = now
        yield pa.RecordBatch.from_pylist(out, _ROW)


def _row(own: tuple, following: tuple) -> dict:
    changed = edited(own[3], following[3])
    mine = own[4].coordinates
    marks = sketch(changed, own[4], len(own[3]) - len(own[3]) // 4).coordinates
    return {
        "doc_id": own[1],
        "n_chars": len(own[3]),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": written(mine),
        "edited_fingerprint": written(marks),
        "near_edited": likeness(mine, marks),
        "near_next": likeness(mine, following[4].coordinates),
    }


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus ``fingerprint``, the Order MinHash of its text, as a column.

    Null and empty texts have the same fingerprint, a text shorter than a k-mer has the one of
    its single run. A column named ``fingerprint`` is replaced; others pass through.
    """

    @F.arrow_udf("string")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([written(sketch(t).coordinates) for t in batch.to_pylist()], pa.string())

    bound_batches(docs.sparkSession)
    return docs.withColumn("fingerprint", fingerprint(text))


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how alike they and
    the next document's are (see the module).

    The next document is the one with the next larger ``doc_id``; after the last comes the
    first. Null ids come first; rows with equal ids follow each other by their text. A single
    document is its own next one. An empty table gives no rows.

    Documents are dealt to ranges of ids with fixed borders, those of an id on very many rows
    (NULL too) to ranges of their texts, and each range also gets the first document of the
    next one to look ahead to. A range is sorted by Spark and streamed through one task, which
    holds two documents.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size >> 25)
    ranged = spread(rows, "doc_id", ["text"], min(ranges, max(1, count)), "range", "place")
    # Two rows per range at most, as a hot id is cut into ranges of the usual size.
    firsts = ranged.groupBy("range").agg(
        F.min("doc_id"), F.count_if(F.col("doc_id").isNull()), F.min("place")
    )
    found = [
        (r, at, None if nulls else smallest, place)
        for at, (r, smallest, nulls, place) in enumerate(sorted(firsts.collect(), key=lambda r: r[0]))
    ]
    listed = docs.sparkSession.createDataFrame(found, "f_range long, f_at int, f_id long, f_place long")
    known = ranged.join(F.broadcast(listed), F.col("range") == F.col("f_range"))
    # The first document of a range goes to the end of the range before as well, that of the
    # first range to the end of the last.
    first = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("place") == F.col("f_place"))
    parts = max(1, len(found))
    here = F.struct(F.col("f_at").alias("part"), F.lit(False).alias("ahead"))
    before = F.struct(F.pmod(F.col("f_at") - 1, F.lit(parts)).alias("part"), F.lit(True).alias("ahead"))
    places = F.when(first, F.array(here, before)).otherwise(F.array(here))
    own = known.withColumn("_at", F.explode(places)).select("_at.part", "doc_id", "_at.ahead", "text")
    dealt = own.repartitionByRange(parts, "part")
    ordered = dealt.sortWithinPartitions("part", "ahead", F.asc_nulls_first("doc_id"), "text")
    return ordered.mapInArrow(_compared, SCHEMA)
