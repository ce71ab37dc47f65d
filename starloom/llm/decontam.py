"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are lower-cased and cut into words; each run of ``window`` words is a pattern (an
item of fewer words is one pattern). The patterns of all items go into one automaton, which
walks each document's normalised text once. The text is normalised byte by byte - every
separator becomes a blank, A-Z become a-z - so lengths do not change, and an offset in it is
the offset in the original UTF-8 text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrays import FOLD, bound_batches
from starloom.sinks.scratch import pin

WINDOW = 10

#: Bytes of patterns in one automaton, which takes about 50 times as much memory. More are
#: dealt to several automata by hash, each with a pass of its own over the stored texts.
AUTOMATON_BYTES = 4 << 20

_letters = np.r_[0x30:0x3A, 0x41:0x5B, 0x61:0x7B, 0x80:0x100]  # digits, letters, beyond ASCII
_BLANK = np.full(256, 0x20, np.uint8)
_BLANK[_letters] = FOLD[_letters]
TABLE = _BLANK.tobytes()


def normalised(text: str | None) -> bytes:
    """The text with blanks for separators and small letters; as long as its UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE)


def windows(text: str | None, size: int) -> set[bytes]:
    """The patterns of one item."""
    words = normalised(text).split()
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


@dataclass
class Hits:
    """What a document shares with the items: its words, the hit ones (indices), where the hit
    runs lie in the UTF-8 text, and the numbers of the windows that occur."""

    n_words: int
    hit_words: list[int]
    spans: list[tuple[int, int]]
    windows: list[int]


def hit_spans(flat: bytes, hit_words: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of hit words lie in a normalised text."""
    if not len(hit_words):
        return []
    raw = np.frombuffer(flat, np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate([[False], raw, [False]]).astype(np.int8)))
    begin, stop = edge[::2], edge[1::2]
    runs = np.split(hit_words, np.flatnonzero(np.diff(hit_words) > 1) + 1)
    return [(int(begin[run[0]]), int(stop[run[-1]])) for run in runs]


class Finder:
    """The automaton over patterns of (words, number)."""

    _known: dict[str, Finder] = {}

    def __init__(self, patterns: list[tuple[bytes, int]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for pattern, number in patterns:
            key = f" {pattern.decode('latin-1')} "
            self.automaton.add_word(key, (len(key), number))
        if patterns:
            self.automaton.make_automaton()
        self.empty = not patterns

    @classmethod
    def of(cls, shared: Broadcast, name: str) -> Finder:
        """The one of this worker process; built again for another broadcast."""
        if name not in cls._known:
            cls._known.clear()
            cls._known[name] = cls(shared.value)
        return cls._known[name]

    def search(self, text: str | None) -> Hits:
        """Walk one text. Runs of blanks are joined for the walk and told apart afterwards,
        for documents with a hit only."""
        flat = normalised(text)
        words = flat.split()
        if not words or self.empty:
            return Hits(len(words), [], [], [])
        walked = f" {b' '.join(words).decode('latin-1')} "
        found = [(end, *value) for end, value in self.automaton.iter(walked)]
        if not found:
            return Hits(len(words), [], [], [])
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[1], np.cumsum(lengths + 1)[:-1] + 1])
        hit = np.zeros(len(words) + 1, np.int64)
        for end, size, _ in found:
            first = np.searchsorted(starts, end - size + 2)
            last = np.searchsorted(starts, end)  # first word after the pattern
            hit[first] += 1
            hit[last] -= 1
        inside = np.flatnonzero(np.cumsum(hit[:-1]) > 0)
        numbers = sorted({number for _, _, number in found})
        return Hits(len(words), inside.tolist(), hit_spans(flat, inside), numbers)


def _windows(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Stored (number, window) of the distinct windows, and (_number, item): the items that hold
    a window, a row each, however many they are. Items are known by their ids as texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (item, w)
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for w in windows(text, window)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in found], pa.string()), pa.array([w for _, w in found], pa.binary())],
                ["item", "window"],
            )

    rows = benchmark.select(F.col("item_id").cast("string"), "text")
    held = pin(rows.mapInArrow(cut, "item string, window binary").distinct(), "held")
    numbered = pin(
        held.select("window").distinct().withColumn("number", F.monotonically_increasing_id()), "windows"
    )
    known = numbered.select(F.col("number").alias("_number"), F.col("window").alias("_window"))
    named = held.filter("item IS NOT NULL")
    members = named.join(known, F.col("window") == F.col("_window")).select("_number", "item")
    return numbered, members


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
RESULT = (
    "struct<n_words: long, hit_words: array<long>, "
    "spans: array<struct<start: long, end: long>>, windows: array<long>>"
)


def _listed(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in spans]


def _scan(shared: Broadcast):
    """A column function: text to what the automaton finds in it."""
    name = uuid.uuid4().hex

    @F.arrow_udf(RESULT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = Finder.of(shared, name)
        kind = pa.struct(
            [
                ("n_words", pa.int64()),
                ("hit_words", pa.list_(pa.int64())),
                ("spans", _SPANS),
                ("windows", pa.list_(pa.int64())),
            ]
        )
        for batch in batches:
            found = [finder.search(text) for text in batch.to_pylist()]
            rows = [{**vars(h), "spans": _listed(h.spans)} for h in found]
            yield pa.array(rows, kind)

    return scan


def _spans_of(text: Column, hit_words: Column) -> Column:
    """Spans of the hit words that several automata found together."""

    @F.arrow_udf("array<struct<start: long, end: long>>")
    def spans(texts: pa.Array, words: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), words.to_pylist())
        found = [hit_spans(normalised(t), np.array(w or [], np.int64)) for t, w in pairs]
        return pa.array([_listed(f) for f in found], _SPANS)

    return spans(text, hit_words)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    name: str = "_hits",
) -> DataFrame:
    """Add ``name`` to ``docs``: a struct of ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``hit_words`` (their indices), ``spans`` (byte ranges of the hit
    runs in the UTF-8 text) and ``windows`` (numbers of the windows that occur).

    The result does not depend on how many automata the patterns need. Null and empty texts
    have no words and no hits; items without words have no windows; a repeated item counts once;
    an empty benchmark hits nothing. Other columns pass through, one called ``name`` is
    replaced.
    """
    return _found(docs, _windows(benchmark, window)[0], text, name)


def _found(docs: DataFrame, patterns: DataFrame, text: str, name: str) -> DataFrame:
    spark = docs.sparkSession
    bound_batches(spark)
    size = patterns.agg(F.coalesce(F.sum(F.octet_length("window") + 2), F.lit(0))).first()[0]
    passes = max(1, -(-size // AUTOMATON_BYTES))
    # The document's own columns travel as one, so that their names cannot clash.
    kept = [c for c in docs.columns if c != name]
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_own"))
    whole = F.col(f"_own.`{text}`")
    for k in range(passes):
        mine = patterns.filter(F.pmod(F.xxhash64("window"), F.lit(passes)) == k)
        # At most about AUTOMATON_BYTES of patterns, and a number for each.
        shared = spark.sparkContext.broadcast([(bytes(r["window"]), r["number"]) for r in mine.collect()])
        out = out.withColumn(f"_hits{k}", _scan(shared)(whole))
        if k < passes - 1:  # else one task would hold several automata
            out = pin(out, "scanned")
    parts = [F.col(f"_hits{k}") for k in range(passes)]
    if passes > 1:
        # Spans of several automata may touch or overlap: they are taken from all hit words.
        merged = {c: F.array_sort(F.array_distinct(F.concat(*[p[c] for p in parts]))) for c in ("hit_words", "windows")}
        out = out.withColumns({f"_{c}": v for c, v in merged.items()})
        text_of_hits = F.when(F.size("_hit_words") > 0, whole)
        columns = [F.col("_hit_words"), _spans_of(text_of_hits, F.col("_hit_words")), F.col("_windows")]
    else:
        columns = [parts[0][c] for c in ("hit_words", "spans", "windows")]
    hits = [c.alias(n) for c, n in zip(columns, ("hit_words", "spans", "windows"))]
    n_hit = F.size(columns[0]).cast("bigint").alias("n_hit")
    return out.select("_own.*", F.struct(parts[0]["n_words"].alias("n_words"), n_hit, *hits).alias(name))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: what it shares with the benchmark, see :func:`find_benchmark`.

    Items are listed by id, sorted as texts; ids of any type are compared as texts, and an item
    without an id counts for the hits but is not listed. Items are looked up once per distinct
    set of windows, after the scan, so a window that very many items share is not carried along.
    """
    patterns, members = _windows(benchmark, window)
    hits = _found(docs.select("doc_id", "text"), patterns, "text", "_hits").select("doc_id", "_hits.*")
    found = pin(hits.drop("hit_words"), "hits")
    sets = found.filter(F.size("windows") > 0).select("windows").distinct()
    each = sets.select(F.col("windows").alias("_set"), F.explode("windows").alias("number"))
    named = each.join(members, F.col("number") == F.col("_number"))
    listed = F.array_sort(F.collect_set("item"))
    # Stored, so that the join has plain shuffles and the documents of a hot set may be split.
    items = pin(
        named.groupBy("_set").agg(
            F.size(listed).cast("bigint").alias("_items"), F.sha2(F.array_join(listed, ","), 256).alias("_sha")
        ),
        "items",
    )
    return found.join(items, F.col("windows") == F.col("_set"), "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce("_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("_sha", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )


def digest(items: list[int]) -> str:
    """SHA-256 of the items sorted as strings, as :func:`contamination` reports it."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
