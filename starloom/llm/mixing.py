"""Mixing sources to target weights by Pfair scheduling.

The documents of a source stand in a fixed order and are cut into blocks of equal bytes. Block
i of a source with weight w is released at slot floor(i / w) and due at slot ceil((i + 1) / w).
In each slot the released block with the earliest deadline runs. Since the weights add up to
one, every block meets its window, so at any time each source is less than one block away
from its share.

Weights are ratios of whole numbers, exactly those that were given: nothing is rounded, so
the distance does not grow with the number of slots or of sources. A slot depends on all those
before it, so one task deals them in their order. It holds a block per source and a few rows,
and passes on a row of numbers per block; these rows are stored and joined to the documents'
blocks. Blocks grow with the documents, so that this task deals about ``MOST_BLOCKS`` slots and
a lost one costs a minute, however many documents there are.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.ranges import running_totals
from starloom.operators.numbering import row_number_per_key
from starloom.sinks.scratch import pin

#: Least bytes of a block, and blocks into which all documents are cut at most.
BLOCK_BYTES, MOST_BLOCKS = 64 * 1024, 1 << 24
#: Default weights: shares of the bytes to this power, which moves weight to small sources. Bytes
#: count in whole blocks, as a slot is one: a source of a few bytes would otherwise be due once in
#: so many slots that the others had to repeat for it without end.
TEMPER = 0.9
#: Rows of a source in one part of its order, more once there would be over MOST_PARTS.
PART_ROWS, MOST_PARTS = 2_000, 100_000
#: A part of so many times its share of the rows holds a hot key and is cut further.
HOT_PART = 8
#: Slots that are passed on together, and the last slot a column can hold.
SLOT_ROWS, LAST_SLOT = 10_000, (1 << 63) - 1
#: Columns that the mixture adds.
ADDED = ("mix_slot", "mix_offset", "mix_block", "mix_epoch", "mix_release", "mix_deadline")


def ratios(weights: Mapping[str, float]) -> dict[str, int]:
    """Positive weights as whole numbers in exactly the same ratios."""
    exact = {s: Fraction(w) for s, w in weights.items() if w > 0}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {s: x.numerator * (scale // x.denominator) for s, x in exact.items()}
    common = math.gcd(*whole.values()) or 1
    return {s: n // common for s, n in whole.items()}


def schedule(shares: Mapping[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of all slots, earliest deadline first."""
    total = sum(shares.values())
    waiting = [(0, s, 0) for s in sorted(shares)]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []  # by deadline
    slot = 0
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            release, s, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * total // shares[s]), s, block, release))
        due, s, block, release = heapq.heappop(ready)
        yield s, block, release, due, slot
        heapq.heappush(waiting, ((block + 1) * total // shares[s], s, block + 1))
        slot += 1


SLOTS = "p_of int, p_block long, p_epoch long, p_release long, p_due long, p_slot long"
SLOT_FIELDS = pa.schema(
    [("p_of", pa.int32())]
    + [(name, pa.int64()) for name in ("p_block", "p_epoch", "p_release", "p_due", "p_slot")]
)


def slots_until_done(
    shares: Mapping[str, int], blocks: Mapping[str, int], number: Mapping[str, int]
) -> Iterator[pa.RecordBatch]:
    """The schedule up to the slot in which the last source has run all its ``blocks`` once;
    a block's number goes on from epoch to epoch. Sources go by their ``number``."""
    left, rows = len(blocks), []

    def batch() -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, SLOT_FIELDS)], schema=SLOT_FIELDS
        )

    for s, block, release, due, slot in schedule(shares):
        epoch, own = divmod(block, blocks[s])
        rows.append((number[s], own, epoch, release, min(due, LAST_SLOT), slot))
        left -= block + 1 == blocks[s]
        if not left:
            break
        if len(rows) == SLOT_ROWS:
            yield batch()
            rows = []
    if rows:
        yield batch()


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes plus one; null counts as empty."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def _source(source: str) -> Column:
    """A name for NULL that no source has."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("NULL"))


def _cut_hot_parts(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``_cut``, numbers of ranges in the order of ``_bin`` and then ``order``.

    Parts are cut by a hash of the key, so only rows of a hot key make a part much larger than
    others. The rows of such parts, found by a count that combines map-side, are numbered,
    copies of whole rows too, and cut into ranges of the usual size.
    """
    counted = rows.groupBy("_of", "_bin").agg(
        F.count("*").alias("_rows"), F.first("s_usual").alias("_usual")
    )
    many = counted.filter(F.col("_rows") > F.col("_usual") * HOT_PART)
    hot = pin(many.select(F.col("_of").alias("h_of"), F.col("_bin").alias("h_bin")), "hot-parts")
    if hot.isEmpty():
        return rows.withColumn("_cut", F.col("_bin"))
    among = (F.col("_of") == F.col("h_of")) & (F.col("_bin") == F.col("h_bin"))
    by = [(c, "asc", "first") for c in order]
    numbered = row_number_per_key(rows.join(hot, among, "left_semi"), ["_of", "_bin"], by, "_place")
    # No part has more ranges than its source has parts, but for one.
    width = F.col("s_parts") + 2
    inside = F.call_function("div", F.col("_place") - 1, F.col("s_usual"))
    return numbered.withColumn("_cut", F.col("_bin") * width + inside).drop("_place").unionByName(
        rows.join(hot, among, "left_anti").withColumn("_cut", F.col("_bin") * width)
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    source: str = "source",
    key: str = "doc_id",
    size: Column | None = None,
    block_bytes: int | None = None,
) -> DataFrame:
    """``docs`` in the order of a mixture: adds ``mix_slot``, ``mix_offset`` (order within the
    slot), ``mix_block`` (in the source), ``mix_epoch``, ``mix_release`` and ``mix_deadline``.

    Every document comes at least once. The mixture ends when the last source has been used
    up, for a source of small weight after its blocks / weight slots; sources used up before
    begin again, so their documents come once more with the next epoch. ``weights``
    (default: tempered shares of the bytes, in whole blocks) must name every source that is to
    be used; rows of others, or of weight 0, are left out. NULL is a source of its own.
    Weights are kept exactly. ``block_bytes`` is ``BLOCK_BYTES`` by default, and from a TB on
    as much more as keeps all documents within ``MOST_BLOCKS`` blocks.

    A document takes ``size`` (positive; default the UTF-8 bytes of its ``text`` plus one); it
    belongs to the block where it begins, so a long one leaves the blocks that it covers
    empty. Rows of a source stand in the order of a hash of ``key``, then ``key`` and a hash
    of the row; repeated rows follow each other. Rows of one key, or without one, lie together
    and are spread over as many tasks as others. Null and empty texts take one byte. An empty
    table gives no rows. All columns pass through, those with the names above are replaced.
    """
    docs = docs.drop(*ADDED)
    own = [F.col(f"`{c}`") for c in docs.columns]
    shuffled = F.xxhash64(F.col(key).cast("string"), F.lit("mix"))
    # The document's own columns travel as one, so that their names cannot clash.
    rows = docs.select(
        F.struct(*own).alias("_row"),
        _source(source).alias("_of"),
        (text_size() if size is None else size).alias("_size"),
        shuffled.alias("_turn"),
        F.col(key).alias("_id"),
        F.xxhash64(*own).alias("_tie"),
    )
    # One row per source, as many as there are weights.
    totals = {
        r["_of"]: (r["bytes"], r["rows"])
        for r in rows.groupBy("_of").agg(F.sum("_size").alias("bytes"), F.count("*").alias("rows")).collect()
    }
    if block_bytes is None:
        block_bytes = max(BLOCK_BYTES, -(-sum(b for b, _ in totals.values()) // MOST_BLOCKS))
    if weights is None:
        named = {s: float(-(-b // block_bytes) * block_bytes) ** TEMPER for s, (b, _) in totals.items()}
    else:
        named = {"NULL" if s is None else f"={s}": w for s, w in weights.items()}
        named = {s: w for s, w in named.items() if s in totals}
    shares = ratios(named)
    blocks = {s: -(-totals[s][0] // block_bytes) for s in shares}
    number = {s: k for k, s in enumerate(sorted(shares))}
    spark = docs.sparkSession

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield from slots_until_done(shares, blocks, number)

    # A row per block, in the order of slots, which one after the other depend on those before.
    one = spark.range(0, 1 if shares else 0, 1, 1)
    places = pin(one.mapInArrow(deal, SLOTS), "slots")
    parts = {s: max(1, min(MOST_PARTS, totals[s][1] // PART_ROWS)) for s in shares}
    sources = spark.createDataFrame(
        [(s, number[s], parts[s], -(-totals[s][1] // parts[s])) for s in shares],
        "s_of string, s_number int, s_parts long, s_usual long",
    )
    known = rows.join(F.broadcast(sources), F.col("_of") == F.col("s_of")).withColumn(
        "_bin", F.pmod(F.shiftrightunsigned("_turn", 20), F.col("s_parts"))
    )
    order = ["_turn", "_id", "_tie"]
    cut = _cut_hot_parts(known, order)
    placed = running_totals(cut, ["_of"], "_cut", order, {"_size": "mix_offset"})
    placed = placed.withColumn("mix_block", F.call_function("div", "mix_offset", F.lit(block_bytes)))
    # A block has one slot in each epoch in which it runs.
    looked = placed.join(
        places, (F.col("s_number") == F.col("p_of")) & (F.col("mix_block") == F.col("p_block"))
    )
    return looked.withColumns(
        {
            "mix_slot": F.col("p_slot"),
            "mix_epoch": F.col("p_epoch"),
            "mix_release": F.col("p_release"),
            "mix_deadline": F.col("p_due"),
        }
    ).select("_row.*", *ADDED)
