"""Merkle manifest of a dataset by bitmap-rank indexing.

Every row is a leaf. The leaves of a group ascend by id, and pairs of nodes are hashed level by
level to the group's subroot; the subroots, in the order of the groups, give the root.

1. Ids become bits: rows of one (group, word of 64 ids) are or-ed map-side, and the words that
   hold a bit are put together to containers of ``CONTAINER`` ids. A container is a compressed
   bitmap (words without a bit are left out) with a popcount directory (bits before each word);
   its start is the number of rows in the containers before it.
2. The coordinate of a leaf is a rank query: start of its container, directory, and the bits
   below its own. No leaf is sorted.
3. Nodes go to slot arrays, keyed by their coordinate, of ``2 ** BITS`` slots. A task reduces an
   array by up to ``BITS`` levels to one node of the next round, so 100 billion leaves take four
   rounds, each a thousandth of the one before.
4. Paths come back down the rounds; siblings above an array are shared by all its slots, so
   no path of a leaf is ever stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrays import bound_batches
from starloom.llm.ranges import borders, range_of, running_totals
from starloom.operators.numbering import row_number_per_key, surrogate_key
from starloom.sinks.scratch import pin

#: Ids of a container, as a power of two; 16 words of 64 bits.
CONTAINER_BITS = 10
CONTAINER = 1 << CONTAINER_BITS
#: Container of rows without an id; ids are 64-bit, so no id has it.
NO_ID = -(1 << (63 - CONTAINER_BITS)) - 1
#: Slots of an array, as a power of two.
BITS = 10
#: Containers whose rows before them are summed in one task.
PART = 8192

#: Sides of a path's entries: no sibling, sibling to the left, to the right.
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"
_STEP = 33

_SLOT = pa.struct(
    [("slot", pa.int32()), ("node", pa.binary()), ("id", pa.int64()), ("claim", pa.binary())]
)


def field(value: Column) -> Column:
    """How a value enters a leaf: ``-`` for NULL, else UTF-8 bytes, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row, in 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def parent(*nodes: bytes) -> bytes:
    """SHA-256 of the nodes' hex texts, one after the other."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def height(n: int) -> int:
    """Levels that reduce ``n`` nodes to one."""
    return max(0, n - 1).bit_length()


def levels(nodes: list[bytes], rounds: int) -> list[list[bytes]]:
    """The nodes and the levels above them; a last node without a sibling is hashed alone."""
    out = [nodes]
    for _ in range(rounds):
        below = out[-1]
        out.append([parent(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def path_of(slot: int, tree: list[list[bytes]]) -> bytes:
    """Side and sibling of a slot on each level of an array."""
    out = []
    for level in tree[:-1]:
        beside = slot ^ 1
        if beside >= len(level):
            out.append(ALONE + bytes(_STEP - 1))
        else:
            out.append((LEFT if beside < slot else RIGHT) + level[beside])
        slot >>= 1
    return b"".join(out)


def steps(path: bytes) -> list[tuple[bytes, bytes]]:
    """(side, sibling) of each level of a path."""
    return [(path[i : i + 1], path[i + 1 : i + _STEP]) for i in range(0, len(path), _STEP)]


def fold(node: bytes, path: Sequence[tuple[bytes, bytes]]) -> bytes:
    """The root that a node and the siblings on its path give."""
    for side, beside in path:
        if side == RIGHT:
            node = parent(node, beside)
        elif side == LEFT:
            node = parent(beside, node)
        else:
            node = parent(node)
    return node


def _container(key: Column) -> Column:
    return F.coalesce(F.shiftright(key, CONTAINER_BITS), F.lit(NO_ID))


def _bit(key: Column) -> Column:
    return F.coalesce(key.bitwiseAND(F.lit(CONTAINER - 1)).cast("int"), F.lit(0))


def bitmaps(rows: DataFrame) -> DataFrame:
    """(g, c, words, n): the compressed bitmap of each container of rows (g, id), its words as
    structs of word, bits and the bits before it, and its number of rows."""
    b = _bit(F.col("id"))
    words = rows.groupBy(
        "g", _container(F.col("id")).alias("c"), F.shiftright(b, 6).alias("word")
    ).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), b.bitwiseAND(F.lit(63)))).alias("bits"),
        F.count("*").alias("n"),
    )
    # At most 16 words.
    merged = words.groupBy("g", "c").agg(
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("found"), F.sum("n").alias("n")
    )

    def before(i: Column) -> Column:
        ones = F.transform(F.slice("found", F.lit(1), i), lambda w: F.bit_count(w["bits"]))
        return F.aggregate(ones, F.lit(0), lambda a, x: a + x)

    directory = F.transform(
        "found", lambda w, i: F.struct(w["word"].alias("word"), w["bits"].alias("bits"), before(i).alias("before"))
    )
    return merged.select("g", "c", directory.alias("words"), "n")


def _ones(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda a, w: a + F.bit_count(w["bits"]))


def rank_in(words: Column, bit: Column) -> Column:
    """The bits of a container below ``bit``."""
    own = F.element_at(F.filter(words, lambda w: w["word"] == F.shiftright(bit, 6)), 1)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)))
    below = F.when(bit.bitwiseAND(F.lit(63)) == 63, F.lit((1 << 63) - 1)).otherwise(one - 1)
    return own["before"] + F.bit_count(own["bits"].bitwiseAND(below))


def ranked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (g, id, node, claim) with their coordinate ``index`` within ``g`` and the
    group's size ``n``, and (g, n). Rows of one id follow each other by node and claim."""
    found = pin(bitmaps(rows), "bitmaps")
    b = _bit(F.col("id"))
    # Only containers with more rows than bits hold an id twice: none, as a rule.
    full = found.filter(F.col("n") > _ones(F.col("words"))).select(
        F.col("g").alias("_g"), F.col("c").alias("_c")
    )
    inside = (F.col("g") == F.col("_g")) & (_container(F.col("id")) == F.col("_c"))
    again = pin(
        rows.join(full, inside, "left_semi")
        .groupBy("g", _container(F.col("id")).alias("c"), b.alias("bit"))
        .agg((F.count("*") - 1).alias("more"))
        .filter("more > 0"),
        "repeated",
    )
    if again.isEmpty():
        rows = rows.withColumn("_tie", F.lit(0).cast("bigint"))
        found = found.withColumn("again", F.lit(None).cast("array<struct<bit: int, more: bigint>>"))
    else:
        listed = again.select(*[F.col(k).alias(f"_{k}") for k in ("g", "c", "bit")])
        same = inside & (b == F.col("_bit"))
        several = row_number_per_key(
            rows.join(listed, same, "left_semi"),
            ["g", "id"],
            [("node", "asc", "first"), ("claim", "asc", "first")],
            "_tie",
        )
        once = rows.join(listed, same, "left_anti").withColumn("_tie", F.lit(1).cast("bigint"))
        rows = once.unionByName(several).withColumn("_tie", F.col("_tie") - 1)
        lists = again.groupBy(F.col("g").alias("_g"), F.col("c").alias("_c")).agg(
            F.collect_list(F.struct("bit", "more")).alias("again")
        )
        here = (F.col("g") == F.col("_g")) & (F.col("c") == F.col("_c"))
        found = found.join(lists, here, "left").drop("_g", "_c")
    cuts = borders(found, "c", found.count() // PART + 1)
    started = running_totals(
        found.withColumn("_part", range_of(F.col("c"), cuts)), ["g"], "_part", ["c"], {"n": "start"}
    )
    groups = pin(found.groupBy(F.col("g").alias("_g")).agg(F.sum("n").alias("_n")), "groups")
    directory = started.join(groups, F.col("g") == F.col("_g")).select(
        "_g", F.col("c").alias("_c"), "_n", "start", "words", "again"
    )
    directory = pin(directory, "directory")
    more = F.aggregate(
        F.filter("again", lambda a: a["bit"] < b), F.lit(0).cast("bigint"), lambda s, a: s + a["more"]
    )
    index = F.col("start") + rank_in(F.col("words"), b) + F.coalesce(more, F.lit(0)) + F.col("_tie")
    placed = rows.join(directory, inside).select(
        "g", F.col("_n").alias("n"), index.alias("index"), "node", "id", "claim"
    )
    return placed, groups.select(F.col("_g").alias("g"), F.col("_n").alias("n"))


def _arrays(nodes: DataFrame) -> DataFrame:
    """Slot arrays of nodes (g, n, index, node, id, claim), each with its top node."""
    size = (1 << BITS) - 1
    slot = F.col("index").bitwiseAND(F.lit(size)).cast("int")
    dealt = nodes.groupBy("g", "n", F.shiftright("index", BITS).alias("block")).agg(
        F.collect_list(F.struct(slot.alias("slot"), "node", "id", "claim")).alias("slots")
    )

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [
                levels(_in_slots(slots)[0], min(BITS, height(n)))[-1][0]
                for n, slots in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tops, pa.binary())], names)

    names = ["g", "n", "block", "slots", "top"]
    kinds = "g string, n long, block long, slots array<struct<slot: int, node: binary, id: long, claim: binary>>"
    return pin(dealt.mapInArrow(reduce, f"{kinds}, top binary"), "slots")


def _in_slots(slots: list[dict]) -> tuple[list[bytes], list[dict]]:
    """The nodes of an array in their places, and the entries they come from."""
    entries: list[dict] = [{}] * len(slots)
    for s in slots:
        entries[s["slot"]] = s
    return [s["node"] for s in entries], entries


def _reduced(nodes: DataFrame, sizes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(g, top) of each group, and the slot arrays of all rounds."""
    most = sizes.agg(F.max("n")).first()[0] or 0
    rounds = [_arrays(nodes)]
    while most > 1 << BITS:
        most = -(-most >> BITS)
        up = (F.shiftright(F.col("n") - 1, BITS) + 1).alias("n")
        none = [F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("claim")]
        above = rounds[-1].select("g", up, F.col("block").alias("index"), F.col("top").alias("node"), *none)
        rounds.append(_arrays(above))
    return rounds[-1].select("g", F.col("top")), rounds


def _under(arrays: DataFrame, paths: DataFrame) -> DataFrame:
    """Slot arrays with the path from their top to the root."""
    on = (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_block"))
    return arrays.join(paths, on).select("g", "n", "block", "slots", "above", "subroot")


def _paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(_g, _block, above, subroot) of each slot of the lowest of ``rounds``: the path from it
    to the root. ``above`` (_g, above, subroot) has it for the tops of the groups."""

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            for g, n, block, slots, path, subroot in zip(*[c.to_pylist() for c in batch.columns]):
                nodes, _ = _in_slots(slots)
                tree = levels(nodes, min(BITS, height(n)))
                out = [
                    (g, (block << BITS) + slot, path_of(slot, tree) + path, subroot)
                    for slot in range(len(nodes))
                ]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["_g", "_block", "above", "subroot"])

    paths = above.withColumn("_block", F.lit(0).cast("bigint"))
    for arrays in reversed(rounds):
        kinds = "_g string, _block long, above binary, subroot binary"
        paths = pin(_under(arrays, paths).mapInArrow(down, kinds), "paths")
    return paths


def manifest(
    docs: DataFrame,
    values: Sequence[Column],
    key: str = "doc_id",
    group: str = "lang",
    claimed: Sequence[Column] | None = None,
    paths: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``
    (SHA-256 of the siblings' hex texts from the leaf to the root, left to right on each level),
    ``folded_root`` and ``verified``, all digests in hex. With ``paths`` also ``path``: the
    siblings themselves, as structs of side and digest.

    ``values`` make the leaf. ``claimed`` are the values whose leaf is folded up the stored
    siblings; ``verified`` tells if they give the root. By default they are the row's own.

    Ids are whole numbers; rows without one come first, rows of the same id follow each other
    by leaf. A NULL group is one of its own and comes first. Repeated rows are leaves of their
    own with equal digests. NULL values and empty texts have different leaves. An empty table
    has no rows. Other columns, whatever their names, are not looked at.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    own, claim = leaf(values), leaf(claimed or values)
    # Groups as texts that sort bytewise with NULL first.
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    rows = docs.select(name.alias("g"), F.col(f"`{key}`").cast("bigint").alias("id"), own.alias("node"), claim.alias("_c"))
    rows = pin(
        rows.select("g", "id", "node", F.when(F.col("_c") != F.col("node"), F.col("_c")).alias("claim")), "leaves"
    )
    placed, sizes = ranked(rows)
    tops, rounds = _reduced(placed, sizes)
    numbered = pin(surrogate_key(tops, [("g", "asc", "first")], "index", start=0), "subroots")
    none = [F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("claim")]
    upper = numbered.select(F.lit("").alias("g"), F.lit(numbered.count()).cast("bigint").alias("n"), "index", F.col("top").alias("node"), *none)
    crown, upper_rounds = _reduced(upper, upper)
    found = crown.first()  # a single digest
    root = bytes(found["top"]) if found else b""
    over = spark.createDataFrame([("", b"", b"")], "_g string, above binary, subroot binary")
    opened = _paths(upper_rounds, over).select(F.col("_block").alias("_index"), "above")
    named = numbered.join(opened, F.col("index") == F.col("_index")).select(
        F.col("g").alias("_g"), "above", F.col("top").alias("subroot")
    )
    kinds = [(c, pa.string()) for c in ("leaf", "subroot", "proof_sha256", "folded_root")]
    listed = pa.list_(pa.struct([("side", pa.string()), ("digest", pa.string())]))

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = {LEFT: "left", RIGHT: "right"}
        for batch in batches:
            for n, slots, above, subroot in zip(*[c.to_pylist() for c in batch.columns]):
                nodes, entries = _in_slots(slots)
                tree, upper = levels(nodes, min(BITS, height(n))), steps(above)
                out: list[tuple] = []
                for slot, entry in enumerate(entries):
                    path = steps(path_of(slot, tree)) + upper
                    beside = b"".join([d for s, d in path if s != ALONE])
                    folded = fold(entry["claim"] or entry["node"], path)
                    row = (entry["node"].hex(), subroot.hex(), hashlib.sha256(beside.hex().encode()).hexdigest(), folded.hex())
                    listing = [{"side": sides[s], "digest": d.hex()} for s, d in path if s != ALONE]
                    out.append((entry["id"], *row, *([listing] if paths else [])))
                types = [pa.int64(), *[k for _, k in kinds], *([listed] if paths else [])]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*out), types)]
                names = [key, *[c for c, _ in kinds], *(["path"] if paths else [])]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"`{key}` long, " + ", ".join(f"{c} string" for c, _ in kinds)
    schema += ", path array<struct<side: string, digest: string>>" if paths else ""
    below = _under(rounds[0], _paths(rounds[1:], named))
    proved = below.select("n", "slots", "above", "subroot").mapInArrow(prove, schema)
    whole = F.lit(root.hex())
    shown = [F.col(f"`{key}`"), "leaf", "subroot", whole.alias("root"), "proof_sha256", "folded_root"]
    return proved.select(*shown, (F.col("folded_root") == whole).alias("verified"), *(["path"] if paths else []))
