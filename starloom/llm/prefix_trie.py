"""Trie of conversation prefixes with subtree totals by time-forward processing.

Conversations are rebuilt from their turns (the first few come from the conversation at the head
of their group), and every distinct sequence of first turns is a node.

1. A turn is the digest of its role and text. A prefix is named by the sums, over its turns, of
   eight 32-bit lanes of a digest of (depth, turn): sums are taken by windows over parts of a
   conversation, so a conversation of any length spreads over tasks. Together they have 256 bits
   and are compared as one digest.
2. Nodes come from one grouping of the rows with map-side sums: members, smallest member, and
   the weight, which is the number of members' turns at or below the node.
3. The tree is cut where the weight passes a multiple of ``BOUND``: shards are whole subtrees of
   less weight, or runs of a heavy path, and hold at most about four times ``BOUND`` nodes. Their
   roots form the tree of the next round, which is cut at multiples of ``BOUND`` squared, and so
   on until a round has one shard; that is three rounds for 10 billion turns.
4. Time-forward processing: a task gets its shards' nodes sorted (by Spark, spilling) in reverse
   level order, and passes each node's totals to its parent through a priority queue that
   spills. Shard roots pass theirs to the nodes of the next round by a grouping with map-side
   sums. Shards on heavy paths wait for what is below them: they are swept on the way down, from
   the last round to the first, so each node is swept once.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.arrays import bound_batches
from starloom.llm.ranges import running_totals
from starloom.operators.numbering import row_number_per_key
from starloom.sinks.scratch import pin

#: Conversations of a group, the turns that may be shared, and what counts as a word.
GROUP, SHARED = 20, 4
WORD = r"[^\x20\x09-\x0D]+"

#: Weight at whose multiples the tree is cut into shards.
BOUND = 4096
#: Turns of a conversation that one task sums, and conversation ids written out as one text.
PART_BITS, ENDS_BITS = 13, 12
#: Entries of a priority queue in memory; more are spilled as sorted runs.
QUEUE = 100_000

LANES = 8


class SpillingQueue:
    """A priority queue of tuples that keeps at most ``limit`` entries in memory.

    Spilled runs lie in unnamed files of the task's own, like those of Spark's sorts: a task
    that runs again makes them anew, and nobody else reads them.
    """

    def __init__(self, limit: int = QUEUE) -> None:
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []
        self.heads: list[tuple[tuple, int]] = []

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        file = tempfile.TemporaryFile()
        for k in range(0, len(self.heap), 1000):
            pickle.dump(self.heap[k : k + 1000], file)
        file.seek(0)
        self.heap = []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is not None:
            heapq.heappush(self.heads, (entry, run))

    def least(self) -> tuple | None:
        """The smallest entry, which stays."""
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            entry, run = heapq.heappop(self.heads)
            self._advance(run)
            return entry
        return heapq.heappop(self.heap)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, above, depth, above_depth, leaves, saved), deepest first and by id within a depth,
    to (id, leaves, saved) of the subtrees. A node without ``above`` tops its shard."""
    queue = SpillingQueue()
    for batch in batches:
        ids, out = batch.column(0), []
        columns = [batch.column(k).to_pylist() for k in range(6)]
        for node, above, depth, above_depth, leaves, saved in zip(*columns):
            here = (-depth, node)
            while (least := queue.least()) is not None and least[:2] == here:
                _, _, more_leaves, more_saved = queue.pop()
                leaves, saved = leaves + more_leaves, saved + more_saved
            if above is not None:
                queue.push((-above_depth, above, leaves, saved))
            out.append((leaves, saved))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())],
            ["id", "leaves", "saved"],
        )


def _swept(nodes: DataFrame, r: int, most: int) -> DataFrame:
    """Subtree totals of the nodes of whole shards of round ``r``."""
    up = F.col("ups")[r]
    tops = F.col("level") > r
    shard = F.when(tops, F.col("id")).otherwise(F.col("ups")[min(r + 1, most)]["id"])
    dealt = nodes.select(
        "id",
        F.when(~tops, up["id"]).alias("above"),
        "depth",
        F.when(~tops, up["depth"]).alias("above_depth"),
        "leaves",
        "saved",
        shard.alias("shard"),
    )
    sorted_ = dealt.repartition("shard").sortWithinPartitions(F.desc("depth"), "id").drop("shard")
    return sorted_.mapInArrow(_sweep, "id binary, leaves long, saved long")


def _added(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """The nodes with the sums of the messages (to, leaves, saved) added to their totals."""
    # Stored, so that the join has plain shuffles.
    sums = pin(
        messages.groupBy(F.col("to").alias("_to")).agg(
            F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved")
        ),
        "messages",
    )
    joined = nodes.join(sums, F.col("id") == F.col("_to"), "left")
    more = {c: F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0)) for c in ("leaves", "saved")}
    return joined.withColumns(more).drop("_to", "_leaves", "_saved")


def subtree_totals(nodes: DataFrame, rounds: int) -> DataFrame:
    """(id, leaves, saved) summed over the subtree of each of the stored ``nodes``.

    Nodes have id, depth, weight, ``level`` (rounds in which the node tops a shard), ``ups``
    (depth and id of the parent, then of the nearest ancestor of level 1, 2, ...), and the
    ``leaves`` and ``saved`` of their own. At ``rounds`` the whole tree is one shard.
    """
    finished: list[DataFrame] = []
    heavy: list[DataFrame] = []
    state = nodes
    for r in range(rounds):
        limit = BOUND ** (r + 1)
        light = pin(_swept(state.filter(F.col("weight") < limit), r, rounds), "swept")
        finished.append(light)
        if r == rounds - 1:
            break
        roots = state.filter((F.col("level") > r) & (F.col("weight") < limit)).select(
            F.col("id").alias("_id"), F.col("ups")[r]["id"].alias("to")
        )
        messages = light.join(roots, F.col("id") == F.col("_id")).select("to", "leaves", "saved")
        heavy.append(pin(_added(state.filter(F.col("weight") >= limit), messages), "heavy"))
        top = F.when(F.col("level") > r, F.col("id")).otherwise(F.col("ups")[r + 1]["id"])
        sums = heavy[r].groupBy(top.alias("_top")).agg(
            F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved")
        )
        state = pin(
            heavy[r].filter(F.col("level") > r).join(sums, F.col("id") == F.col("_top")).select(
                *[c for c in nodes.columns if c not in ("leaves", "saved")],
                F.col("_leaves").alias("leaves"),
                F.col("_saved").alias("saved"),
            ),
            "roots",
        )
    below = finished[-1]
    for r in reversed(range(rounds - 1)):
        roots = heavy[r].filter((F.col("level") > r) & (F.col("depth") > 0)).select(
            F.col("id").alias("_id"), F.col("ups")[r]["id"].alias("to")
        )
        messages = below.join(roots, F.col("id") == F.col("_id")).select("to", "leaves", "saved")
        below = pin(_swept(_added(heavy[r], messages), r, rounds), "swept").union(finished[r])
    return below


def _running_last(rows: DataFrame, marks: dict[str, Column]) -> DataFrame:
    """Add each of ``marks``: its last value that is not NULL in the rows of the conversation
    before, by parts, with the last values of the parts before brought in by a join."""
    within = Window.partitionBy("c", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    marked = rows.withColumns({f"_{n}": v for n, v in marks.items()})
    lasts = marked.groupBy("c", "part").agg(*[F.max(f"_{n}").alias(f"_{n}") for n in marks])
    brought = lasts.select(
        F.col("c").alias("_c"),
        F.col("part").alias("_part"),
        *[F.last(f"_{n}", ignorenulls=True).over(earlier).alias(f"_b_{n}") for n in marks],
    )
    here = marked.withColumns({n: F.last(f"_{n}", ignorenulls=True).over(within) for n in marks})
    joined = here.join(brought, (F.col("c") == F.col("_c")) & (F.col("part") == F.col("_part")))
    own = [F.coalesce(n, f"_b_{n}").alias(n) for n in marks]
    return joined.select(*rows.columns, *own)


def _written(digests: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws(":", *digests), 256))


def rebuilt(turns: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """(c, depth, turn, words, rest) of every rebuilt conversation, a row of depth 0 included;
    ``rest`` counts its rows from there on.

    ``turns`` are conv_id, turn, role, text. A conversation c takes the first h turns of
    conversation c - c % group, and its own turns after its first h; h is the CRC-32 of c in
    decimals modulo ``shared``.
    """
    size = [F.octet_length(c) for c in ("role", "text")]
    told = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("c"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    told = told.select(
        "c",
        F.col("turn").alias("place"),
        F.unhex(F.sha2(F.concat_ws(":", size[0], "role", size[1], "text"), 256)).alias("turn"),
        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"),
    )
    told = pin(told, "turns")
    order = [("place", "asc", "first"), ("turn", "asc", "first")]
    placed = pin(row_number_per_key(told, ["c"], order, "pos").drop("place"), "placed")
    sizes = pin(placed.groupBy("c").agg(F.count("*").alias("n")), "sizes")
    named = sizes.withColumn("t", F.col("c") - F.col("c") % group)
    named = named.withColumn("h", F.crc32(F.col("c").cast("string")) % shared)
    heads = sizes.select(F.col("c").alias("_t"), F.col("n").alias("_n"))
    taken = F.least("h", F.coalesce("_n", F.lit(0).cast("bigint")))
    conversations = pin(
        named.join(heads, F.col("t") == F.col("_t"), "left").select(
            F.col("c").alias("_c"), "t", "h", taken.alias("k"),
            (taken + F.greatest(F.lit(0).cast("bigint"), F.col("n") - F.col("h"))).alias("total"),
        ),
        "conversations",
    )
    first = placed.filter(F.col("pos") < shared).withColumnsRenamed({"c": "_head"})
    lent = conversations.join(first, (F.col("t") == F.col("_head")) & (F.col("pos") <= F.col("k"))).select(
        F.col("_c").alias("c"), F.col("pos").alias("depth"), "turn", "words", "total"
    )
    own = placed.join(conversations, (F.col("c") == F.col("_c")) & (F.col("pos") > F.col("h"))).select(
        "c", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), "turn", "words", "total"
    )
    start = conversations.select(
        F.col("_c").alias("c"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("bigint").alias("words"), "total",
    )
    every = lent.union(own).union(start)
    return every.withColumn("rest", F.col("total") - F.col("depth") + 1).drop("total")


def _prefixes(rows: DataFrame) -> DataFrame:
    """Rows of rebuilt conversations with ``id``, the prefix that ends there, and ``above``, the
    one a turn shorter."""
    digest = F.sha2(F.concat_ws(":", "depth", F.hex("turn")), 256)
    cut = rows.withColumn("_digest", F.when(F.col("depth") > 0, digest))
    lanes = {
        f"_l{k}": F.coalesce(F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("bigint"), F.lit(0))
        for k in range(LANES)
    }
    cut = cut.withColumns({"part": F.shiftright("depth", PART_BITS), **lanes}).drop("_digest", "turn")
    summed = running_totals(cut, ["c"], "part", ["depth"], {f"_l{k}": f"_b{k}" for k in range(LANES)})
    own = [F.col(f"_b{k}") + F.col(f"_l{k}") for k in range(LANES)]
    before = [F.col(f"_b{k}") for k in range(LANES)]
    return summed.select(
        "c", "part", "depth", "words", "rest",
        _written([F.col("depth"), *own]).alias("id"),
        F.when(F.col("depth") > 0, _written([F.col("depth") - 1, *before])).alias("above"),
    )


def _ends(rows: DataFrame) -> DataFrame:
    """(_ended, ends): SHA-256 of the ids of the conversations that end at a node, ascending
    and comma-joined. Ids are written out by ranges of ids, and a task that hashes a node's
    texts streams over them, whatever their number; SHA-256 itself has no parallel form."""
    texts = rows.filter("rest = 1").groupBy("id", F.shiftright("c", ENDS_BITS).alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for here, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if here == node:
                    state.update(f",{ids}".encode())
                    continue
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = here, hashlib.sha256(ids.encode())
            yield _pairs(out)
        if node is not None:
            yield _pairs([(node, state.hexdigest())])

    streamed = texts.repartition("id").sortWithinPartitions("id", "range").select("id", "ids")
    return pin(streamed.mapInArrow(hashed, "_ended binary, ends string"), "ends")


def _pairs(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["_ended", "ends"])


def prefix_trie(turns: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """One row per node: ``node`` and ``parent`` (digests that name prefixes), ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.

    ``turns`` are conv_id, turn, role, text; a NULL turn comes first, and turns of the same
    number are ordered by the digest of role and text. A NULL role or text is empty. A repeated
    row is a turn of its own. Rows without conv_id belong to no conversation. A conversation
    left without turns ends at the root. An empty table has no nodes, not even a root. Other
    columns, whatever their names, are not looked at.
    """
    bound_batches(turns.sparkSession)
    rows = pin(_prefixes(rebuilt(turns.select("conv_id", "turn", "role", "text"), group, shared)), "prefixes")
    # Depth, parent and words follow from the id.
    nodes = pin(
        rows.groupBy("id", "above", "depth", "words").agg(
            F.min("c").alias("conv"), F.count("*").alias("n_convs"), F.sum("rest").alias("weight")
        ),
        "nodes",
    )
    children = pin(nodes.groupBy(F.col("above").alias("_above")).agg(F.count("*").alias("_children")), "children")
    parents = nodes.select(
        F.col("id").alias("_id"), F.col("conv").alias("parent_conv"), F.col("weight").alias("_weight")
    )
    total = nodes.agg(F.max("weight")).first()[0] or 0
    rounds = 1
    while BOUND**rounds <= total:
        rounds += 1

    def tops(r: int) -> Column:
        def share(c: str) -> Column:
            return F.call_function("div", F.col(c), F.lit(BOUND**r).cast("bigint"))

        return F.when(F.col("_weight").isNull() | (share("weight") != share("_weight")), 1).otherwise(0)

    level = sum((tops(r) for r in range(2, rounds + 1)), tops(1))
    tree = pin(
        nodes.join(parents, F.col("above") == F.col("_id"), "left")
        .withColumn("level", level)
        .drop("_id", "_weight")
        .join(children, F.col("id") == F.col("_above"), "left")
        .withColumn("n_children", F.coalesce("_children", F.lit(0).cast("bigint")))
        .drop("_above", "_children"),
        "tree",
    )
    # The way from a node to the root is that of its smallest member.
    marks = tree.select(F.col("id").alias("_node"), F.col("conv").alias("_conv"), F.col("level").alias("_level"))
    ways = rows.select("c", "part", "depth", "id").join(marks, F.col("id") == F.col("_node"))
    ways = ways.filter((F.col("_level") > 0) | (F.col("c") == F.col("_conv")))
    place = F.struct("depth", "id")
    ups = {f"_up{r}": F.when(F.col("_level") >= r, place) for r in range(1, rounds + 1)}
    ways = _running_last(ways, ups).filter(F.col("c") == F.col("_conv"))
    ways = ways.select(F.col("_node"), *ups)
    first = F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("above").alias("id")))
    forest = pin(
        tree.join(ways, F.col("id") == F.col("_node")).select(
            "id", "depth", "weight", "level",
            F.array(first, *[F.col(u) for u in ups]).alias("ups"),
            F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ),
        "forest",
    )
    totals = subtree_totals(forest, rounds).select(F.col("id").alias("_id"), "leaves", "saved")
    ends = _ends(rows)
    found = tree.join(totals, F.col("id") == F.col("_id")).join(ends, F.col("id") == F.col("_ended"), "left")
    return found.select(
        F.col("id").alias("node"),
        F.col("above").alias("parent"),
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
