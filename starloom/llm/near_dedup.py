"""Near-duplicates by circulant MinHash, banding and exact Jaccard similarity.

Circulant MinHash needs two permutations: the first scatters a document's shingles over all
32-bit positions, the second, shifted by k, gives the k-th coordinate of the signature.

1. Documents with the same words in the same order form a class, named by its smallest id;
   only one document per class goes on, so exact copies cost one row each.
2. Signatures are cut into bands. Classes that agree in a band share a bucket, and a bucket is
   led by its smallest class. Leaders come from a grouping with map-side minima, members from
   a join, so no bucket is ever one task's work.
3. All pairs that share a bucket share its leader. The members of a leader are dealt to
   blocks of bounded size. One block is compared pair by pair in a task; if there are more, each
   is compared with the leader: a large family of copies of one text is linked by that, at a
   cost that grows with its size. Only members that are not like their leader are then compared
   with all members, a pair of blocks in a task. A task computes
   shingles and signatures from the whole texts, drops pairs whose signatures are far apart, and
   confirms the others, likeliest first, skipping pairs that are connected by then: first on
   the sets of shingle hashes, and what passes on the shingles themselves, word for word. It
   returns the links as stars, one row per text at most.
4. Connected components of these links, spread to all documents by class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrays import FOLD, bound_batches, runs, shingles, sound_hashes, utf8, words
from starloom.llm.components import components
from starloom.llm.maps import mark
from starloom.sinks.scratch import pin

WORDS = 5
#: Similarity of linked documents: 100 * intersection >= PERCENT * union.
PERCENT = 75

#: A pair at the threshold misses all of 40 bands of 4 coordinates with probability 2e-7.
BANDS, ROWS = 40, 4
COORDINATES = BANDS * ROWS
#: Share of equal coordinates below which a pair is not confirmed: a pair at the threshold falls
#: under it (fewer than 88 of 160) with probability 1e-8, less than the bands miss.
LEAST_SHARE = 0.55

#: Bounds of a block: documents, and shingles in it.
BLOCK_DOCUMENTS, BLOCK_SHINGLES = 512, 1_000_000

_SHIFTS = np.arange(1, COORDINATES + 1, dtype=np.uint32)[:, None]


def _permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    other = x >> np.uint32(16)
    x ^= other
    x *= np.uint32(a)
    np.right_shift(x, 15, out=other)
    x ^= other
    x *= np.uint32(b)
    np.right_shift(x, 16, out=other)
    x ^= other
    return x


def signature(found: np.ndarray) -> np.ndarray:
    """The coordinates of a set of 64-bit shingle hashes."""
    first = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    first = _permute(first, 0x7FEB352D, 0x846CA68B)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(first), 1024):
        shifted = first[None, k : k + 1024] + _SHIFTS
        np.minimum(least, _permute(shifted, 0x21F0AAAD, 0xD35A2D97).min(axis=1), out=least)
    return least


def sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for own, _ in _texts(column):
        yield own


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, bytes]]:
    """The same, and the folded bytes of each text."""
    data, offsets = utf8(column)
    for a, b in runs(offsets):
        part = offsets[a : b + 1] - offsets[a]
        folded = FOLD[data[offsets[a] : offsets[b]]]
        values, at = shingles(words(folded, part, hashes=sound_hashes), WORDS)
        for d in range(b - a):
            own = np.sort(values[at[d] : at[d + 1]])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own
            yield own, folded[part[d] : part[d + 1]].tobytes()


def shingle_set(folded: bytes) -> set[tuple[bytes, ...]]:
    """The shingles of a folded text themselves."""
    found = folded.split()  # at the six ASCII separators
    if not found:
        return set()
    return set(zip(*[found[k:] for k in range(WORDS)])) if len(found) >= WORDS else {tuple(found)}


def alike(a: set, b: set) -> bool:
    """Similar enough to be linked."""
    both = len(a & b)
    return both > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, n_shingles, digest of the words, one hash per band)."""
    salt = (np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    turn = np.array([1, 0x100000001B3, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
    for batch in batches:
        count, digests, bands = [], [], []
        for own, folded in _texts(batch.column(1)):
            count.append(len(own))
            if not len(own):
                digests.append(None)
                bands.append(None)
                continue
            digests.append(hashlib.blake2b(b" ".join(folded.split()), digest_size=16).digest())
            rows = signature(own).reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
            mixed = ((rows + salt) * turn[None, :ROWS]).sum(axis=1, dtype=np.uint64)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + salt[:, 0]
            bands.append((mixed ^ (mixed >> np.uint64(32))).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(count, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "digest", "bands"],
        )


class _Forest:
    """Union-find over the documents of a task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


#: Where a text stands in a task: it may stand on both sides.
LEFT, RIGHT = 1, 2


def _confirm(pdf: pd.DataFrame) -> pd.DataFrame:
    """The links between the texts on the left of a task and those on its right, as stars around
    the smallest id."""
    pdf = pdf.drop_duplicates(["_id", "text", "_side"]).sort_values(["_id", "text"])
    ids, sides = pdf["_id"].to_numpy(), pdf["_side"].to_numpy()
    left, right = np.flatnonzero(sides & LEFT), np.flatnonzero(sides & RIGHT)
    if not len(left) or not len(right):
        return pd.DataFrame({"u": ids[:0], "v": ids[:0]})
    own, folded = map(list, zip(*_texts(pa.array(pdf["text"], pa.string()))))
    marks = np.stack([signature(s) for s in own]).astype(np.uint32)
    sizes = np.array([len(s) for s in own])
    beside, beside_sizes = marks[right], sizes[right]
    shares, lefts, rights = [], [], []
    for a in range(0, len(left), 64):
        some = left[a : a + 64]
        same = np.zeros((len(some), len(right)), np.uint16)
        for k in range(COORDINATES):
            same += marks[some, k, None] == beside[None, :, k]
        x, y = np.nonzero(same >= LEAST_SHARE * COORDINATES)
        small = np.minimum(sizes[some[x]], beside_sizes[y])
        near = 100 * small >= PERCENT * np.maximum(sizes[some[x]], beside_sizes[y])
        near &= ids[some[x]] != ids[right[y]]
        # A pair that stands on both sides is met twice.
        near &= (sides[some[x]] + sides[right[y]] < 2 * (LEFT + RIGHT)) | (some[x] < right[y])
        x, y = x[near], y[near]
        shares.append(same[x, y])
        lefts.append(some[x])
        rights.append(right[y])
    order = np.argsort(-np.concatenate(shares).astype(np.int64), kind="stable")
    lefts, rights = np.concatenate(lefts)[order], np.concatenate(rights)[order]
    # Texts on both sides are one node.
    node = np.searchsorted(np.unique(ids), ids).tolist()
    forest = _Forest(len(ids))
    last: tuple[int, set] = (-1, set())  # a text is often confirmed against several
    for x, y in zip(lefts.tolist(), rights.tolist()):
        rx, ry = forest.root(node[x]), forest.root(node[y])
        if rx == ry:
            continue
        both = len(np.intersect1d(own[x], own[y], assume_unique=True))
        if 100 * both < PERCENT * (sizes[x] + sizes[y] - both):
            continue
        if last[0] != x:
            last = x, shingle_set(folded[x])
        if alike(last[1], shingle_set(folded[y])):
            forest.up[max(rx, ry)] = min(rx, ry)
    distinct = np.unique(ids)
    roots = np.array([forest.root(k) for k in range(len(distinct))])
    linked = roots != np.arange(len(distinct))
    return pd.DataFrame({"u": distinct[linked], "v": distinct[roots[linked]]})


def _blocks(grouped: DataFrame, name: str) -> DataFrame:
    """(_leader, name): blocks of bounded size for rows (leader, class, n_shingles). Stored, so
    that joins with it have plain shuffles and a large leader's members may be split."""
    count = F.greatest(
        F.ceil(F.count("*") / BLOCK_DOCUMENTS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
    )
    return pin(grouped.groupBy(F.col("leader").alias("_leader")).agg(count.cast("int").alias(name)), name)


def _in_block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("class"), F.col(blocks)).cast("int")


def _compared(texts: DataFrame, work: DataFrame, keys: list[str]) -> DataFrame:
    """The links of tasks named by ``keys``, each of rows (_id, _side)."""
    # A merge join at every size: texts are long, and Spark may split hot ids.
    rows = texts.join(work.hint("merge"), F.col("doc_id") == F.col("_id"))
    return rows.select(*keys, "_side", "_id", "text").groupBy(*keys).applyInPandas(_confirm, "u long, v long")


def _links(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(u, v): the links among the members of each leader, stored."""
    on = F.col("leader") == F.col("_leader")
    others = members.filter("class <> leader")
    dealt = pin(
        others.join(_blocks(others, "_blocks"), on)
        .withColumn("_block", _in_block("_blocks"))
        .select("leader", "class", "n_shingles", "_block", "_blocks"),
        "dealt",
    )

    def side(where: int, rows: DataFrame, of: str, *keys: str) -> DataFrame:
        return rows.select(*keys, F.col(of).alias("_id"), F.lit(where).alias("_side"))

    large = F.col("_blocks") > 1
    keys = ["leader", "_block"]
    lead, few = dealt.select(*keys, "_blocks").distinct(), dealt.filter(~large)
    first = [
        side(LEFT + RIGHT, lead.filter(~large), "leader", *keys),
        side(LEFT + RIGHT, few, "class", *keys),
        # Every member of a large family with its leader.
        side(LEFT, lead.filter(large), "leader", *keys),
        side(RIGHT, dealt.filter(large), "class", *keys),
    ]
    stars = pin(_compared(texts, reduce(DataFrame.union, first), keys), "stars")
    # Those that are not like it with all members.
    known = stars.select(F.col("u").alias("_u"), F.col("v").alias("_v"))
    alone = dealt.filter(large).join(known, (F.col("class") == F.col("_u")) & (F.col("leader") == F.col("_v")), "left_anti")
    alone = pin(alone, "alone")
    counted = _blocks(alone, "_strips")
    strips = alone.join(counted, on).withColumn("_strip", _in_block("_strips"))
    block = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block")
    strip = F.explode(F.sequence(F.lit(0), F.col("_strips") - 1)).alias("_strip")
    lefts = strips.select("leader", "class", "_strip", block)
    rights = dealt.join(counted, on).select("leader", "class", "_block", strip)
    keys = ["leader", "_block", "_strip"]
    second = side(LEFT, lefts, "class", *keys).union(side(RIGHT, rights, "class", *keys))
    return stars.union(pin(_compared(texts, second, keys), "others"))


def _several(signed: DataFrame) -> DataFrame:
    """(_several, _first, _last, _blank) of ids with several texts: the smallest and the largest
    set digest, and whether there is a text without shingles beside. Hardly any ids, as a rule."""
    groups = signed.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_several"))
    found = groups.agg(
        F.min("digest").alias("_first"),
        F.max("digest").alias("_last"),
        (F.count("*") > F.count("digest")).alias("_blank"),
    )
    # Stored, so that rows of other ids are not shuffled.
    return pin(found.filter("_first < _last OR _first IS NOT NULL AND _blank"), "several")


def _same_id(known: DataFrame, several: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v): links of ids that have several texts to the classes of these texts."""
    ids = several.filter("_first < _last").select("_several")
    texts = mark(known.select("doc_id", "digest"), "doc_id", ids, "_again").filter("_again")
    texts = texts.join(ids, F.col("doc_id") == F.col("_several"))
    named = classes.select(F.col("digest").alias("_digest"), "class")
    return texts.join(named, F.col("digest") == F.col("_digest")).select(
        F.col("doc_id").alias("u"), F.col("class").alias("v")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` (smallest id reachable
    over links, its own included) and ``kept`` (it is that smallest id).

    Words are separated by ASCII white space, A-Z count as a-z. Null, empty and blank texts
    have no shingles and no links; a text of fewer words than a shingle has one shingle. Rows
    with the same id and text come out alike, with the same id and different texts they are
    one node. A row without an id is linked with nothing, has no component, and is kept. An
    empty table gives no rows; other columns are not returned.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = pin(
        rows.mapInArrow(_signed, "doc_id long, n_shingles long, digest binary, bands array<long>"),
        "signatures",
    )
    known = signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = pin(
        known.groupBy("digest").agg(
            F.min("doc_id").alias("class"),
            F.first("n_shingles").alias("n_shingles"),
            F.min_by("bands", "doc_id").alias("bands"),
        ),
        "classes",
    )
    banded = classes.select(F.explode("bands").alias("bucket"), "class", "n_shingles")
    leaders = (
        banded.groupBy(F.col("bucket").alias("_bucket"))
        .agg(F.min("class").alias("leader"), F.max("class").alias("_last"))
        .filter("leader < _last")
        .drop("_last")
    )
    members = pin(
        banded.join(leaders, F.col("bucket") == F.col("_bucket"))
        .groupBy("leader", "class")
        .agg(F.first("n_shingles").alias("n_shingles")),
        "members",
    )
    # Texts without a near copy in sight are not shuffled.
    texts = mark(rows, "doc_id", members.select("class"), "_wanted").filter("_wanted")
    links = _links(texts, members)
    several = _several(signed)
    found = components(links.union(_same_id(known, several, classes)))
    # Documents of a class are links as well.
    joined = classes.select("digest", "class").join(
        found.select(F.col("node").alias("class"), F.col("component")), "class", "left"
    )
    named = joined.select(
        F.col("digest").alias("_digest"), F.coalesce("component", "class").alias("_component")
    )
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce(F.col("_component"), F.col("doc_id"))
    )
    # A text without shingles goes with the other texts of its id.
    lent = several.filter("_blank").select("_several", "_first")
    blank = signed.filter("digest IS NULL AND doc_id IS NOT NULL")
    blank = blank.join(lent, F.col("doc_id") == F.col("_several"), "left")
    every = signed.filter("digest IS NOT NULL OR doc_id IS NULL").select("doc_id", "n_shingles", "digest")
    every = every.union(blank.select("doc_id", "n_shingles", "_first"))
    return every.join(named, F.col("digest") == F.col("_digest"), "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
