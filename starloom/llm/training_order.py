"""Token ids laid out in training order.

Documents become one stream of token ids, each followed by an end mark, cut into sequences of
equal length. A keyed Feistel network with cycle walking is a permutation of the sequence
numbers that needs no table: every task computes the slot of its own sequences. Slots are
range-partitioned into shards of equal size, and a shard is one file of records of equal
length, so slot s lies at (s mod slots per shard) * stride in shard s div slots per shard. A
trainer reads slots in order, and goes on at any slot after a stop.

Tokens are stored once, to count them before slots are given out, and move once, pieces of a
shard together; both times they are compressed, and a shard is put together by one task.
Shards go through Spark's text writer, bytes as they are, one line break after each record; so
they can lie in any store that Spark writes.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from starloom.llm.arrays import bound_batches, mix
from starloom.sinks.scratch import pin

#: Tokens of a sequence.
SEQUENCE = 1024
#: Slots of a shard: more than SHARD_SLOTS once there would be over MANY_SHARDS, up to
#: MOST_SLOTS (64 MB at two bytes an id), as a shard is read as one row.
SHARD_SLOTS, MANY_SHARDS, MOST_SLOTS = 4096, 100_000, 32_768
KEY = 0x5EED_0F_0DE12
ROUNDS = 6
#: Bytes of tokens a task holds before it passes them on; slots written as one row.
HELD_BYTES, CHUNK_SLOTS = 16 << 20, 128
#: Tokens of a stored row and of a row of pieces; rows of megabytes would fill the JVM's heap.
ROW_TOKENS = 1 << 17
#: Blocks of files up to which their offsets (16 bytes each) are broadcast.
MOST_BROADCAST = 500_000

#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _halves(n: int) -> int:
    """Bits of half a block: two halves number at least ``n`` and fewer than 4 ``n`` things."""
    return max(1, ((n - 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, bits: int, keys: Sequence[int]) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for key in keys:
        left, right = right, left ^ (mix(right + np.uint64(key)) & low)
    return (left << np.uint64(bits)) | right


def _keys(key: int) -> list[int]:
    return [int(k) for k in mix(np.uint64(key) + np.arange(1, ROUNDS + 1, dtype=np.uint64))]


def slots_of(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slots of sequences, a permutation of 0 to n - 1. A number that leaves the range
    walks on until it is back in it."""
    x = _network(numbers.astype(np.uint64), _halves(n), _keys(key))
    while (out := x >= np.uint64(n)).any():
        x[out] = _network(x[out], _halves(n), _keys(key))
    return x.astype(np.int64)


def sequences_of(slots: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The sequences in some slots: the inverse of :func:`slots_of`."""
    bits, keys = _halves(n), _keys(key)[::-1]
    low = np.uint64((1 << bits) - 1)

    def back(x: np.ndarray) -> np.ndarray:
        # Halves change sides, the network runs with its keys the other way round.
        turned = ((x & low) << np.uint64(bits)) | (x >> np.uint64(bits))
        y = _network(turned, bits, keys)
        return ((y & low) << np.uint64(bits)) | (y >> np.uint64(bits))

    x = back(slots.astype(np.uint64))
    while (out := x >= np.uint64(n)).any():
        x[out] = back(x[out])
    return x.astype(np.int64)


_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(file: str) -> tiktoken.Encoding:
    """The vocabulary of a rank file, once per worker process."""
    if file not in _encodings:
        with open(file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[file] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[file]


def _kind(end: int) -> np.dtype:
    """Numbers of a record: two bytes each if the vocabulary allows."""
    return np.dtype("<u2" if end < 1 << 16 else "<u4")


STORED = (
    "part long, file string, block long, n long, starts array<long>, sizes array<long>, "
    "ids array<long>, tokens binary"
)


STORED_FIELDS = pa.schema(
    [
        ("part", pa.int64()),
        ("file", pa.string()),
        ("block", pa.int64()),
        ("n", pa.int64()),
        ("starts", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("ids", pa.list_(pa.int64())),
        ("tokens", pa.binary()),
    ]
)


def _placed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(task, file, block, id, text): the block of the file that a row is read from, no file
    and block where the rows come out of a shuffle or not from files."""
    columns = [F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")]
    task = F.spark_partition_id().cast("bigint").alias("task")
    try:
        return docs.select(
            task,
            F.input_file_name().alias("file"),
            F.input_file_block_start().alias("block"),
            *columns,
        )
    except AnalysisException:  # rows joined from several tables have no file of their own
        none = F.lit(""), F.lit(-1).cast("bigint")
        return docs.select(task, none[0].alias("file"), none[1].alias("block"), *columns)


def _tokenized(docs: DataFrame, file: str, end: int, key: str, text: str) -> DataFrame:
    """The token stream as it lies, stored once: a row for every few documents with their
    starts (from the beginning of the part), sizes and ids, and all their tokens, compressed.

    A part is what a task reads from one block of a file. Its number is the task's times 2^32
    plus a running one: which blocks a task gets, and in which order, depends on their sizes.
    """
    width = _kind(end).itemsize
    code = "H" if width == 2 else "I"

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at = encoding(file).encode_ordinary, 0
        squeeze = zstandard.ZstdCompressor(level=3).compress
        run, now = -1, None
        for batch in batches:
            rows, parts, own, held = [], [], [], 0
            places = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            for k, value in enumerate(batch.column(4).to_pylist()):
                if places[k] != now:
                    run, now, at = run + 1, places[k], 0
                found = encode(value) if value else []
                found.append(end)
                parts.append(array(code, found).tobytes())
                own.append(batch.column(3)[k].as_py())
                held += len(found)
                if k + 1 < len(places) and places[k + 1] == now and held < ROW_TOKENS:
                    continue
                sizes = np.array([len(p) // width for p in parts], np.int64)
                ends = at + np.cumsum(sizes)
                part = (now[0] << 32) + run
                rows.append((part, *now[1:], held, ends - sizes, sizes, own, squeeze(b"".join(parts))))
                at, parts, own, held = int(ends[-1]), [], [], 0
            fields = dict(zip(STORED_FIELDS.names, zip(*rows))) if rows else {}
            yield pa.RecordBatch.from_arrays(
                [pa.array(fields.get(f.name, ()), f.type) for f in STORED_FIELDS], schema=STORED_FIELDS
            )

    return pin(_placed(docs, key, text).mapInArrow(tokenize, STORED), "token-ids")


PIECES = "shard long, slots array<long>, offsets array<long>, sizes array<long>, pieces binary"
PIECE_FIELDS = pa.schema(
    [
        ("shard", pa.int64()),
        ("slots", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("pieces", pa.binary()),
    ]
)


@dataclass
class Layout:
    """Where training data lies and what a reader must know."""

    path: str
    sequences: int
    tokens: int
    sequence: int
    shard_slots: int
    width: int
    key: int

    @property
    def stride(self) -> int:
        """Bytes from one record to the next."""
        return self.sequence * self.width + 1

    def place(self, slot: int) -> tuple[int, int]:
        """(shard, byte offset) of a slot."""
        return slot // self.shard_slots, slot % self.shard_slots * self.stride


def write_training_order(
    docs: DataFrame,
    path: str,
    file: str,
    end: int,
    sequence: int = SEQUENCE,
    shard_slots: int | None = None,
    key: int = KEY,
    id: str = "doc_id",
    text: str = "text",
) -> tuple[Layout, DataFrame]:
    """Write the shards below ``path``; returns their layout and, one row per sequence, its
    ``sequence``, ``slot``, ``n_tokens`` and ``doc_ids`` in stream order.

    ``file`` holds the ranks of a byte-level vocabulary, ``end`` is the id of the end mark.
    The stream has the documents in the order in which they are stored: by file name, shorter
    names first, then by place in the file, however files are split and packed into tasks; rows
    that do not come straight from files stay in the order of their partitions. Null and empty texts
    are an end mark alone, special tokens written out in a text are ordinary text there. The
    last sequence is filled up with end marks, which ``n_tokens`` does not count. Repeated rows
    and ids come as often as they are there; a null id is listed as NULL. An empty table
    writes no shard. Other columns are not written.
    """
    bound_batches(docs.sparkSession)
    stored = _tokenized(docs, file, end, id, text)
    kind = _kind(end)
    sizes = stored.groupBy(F.col("part").alias("_part")).agg(
        F.sum("n").alias("_n"), F.first("file").alias("_file"), F.first("block").alias("_block")
    )
    parts, tokens = sizes.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    total = -(-tokens // sequence)
    shard_slots = shard_slots or min(MOST_SLOTS, max(SHARD_SLOTS, -(-total // MANY_SHARDS)))
    layout = Layout(path, total, tokens, sequence, shard_slots, kind.itemsize, key)
    # Numbers of files that Spark writes get longer, so longer names come later.
    lying = (F.length("_file"), "_file", "_block", "_part")
    earlier = Window.orderBy(*lying).rowsBetween(Window.unboundedPreceding, -1)
    # One row per block of a file.
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    if parts <= MOST_BROADCAST:
        offsets = F.broadcast(offsets)
    stream = stored.join(offsets, F.col("part") == F.col("_part")).select(
        F.col("_before").alias("before"), "starts", "sizes", "ids", "tokens"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stored batches to pieces of sequences, those of a shard together."""
        expand = zstandard.ZstdDecompressor().decompress
        squeeze = zstandard.ZstdCompressor(level=3).compress
        step = max(1, ROW_TOKENS // sequence)
        waiting: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            rows = [
                {
                    "shard": shard,
                    "slots": [slot for slot, _, _ in pieces],
                    "offsets": [offset for _, offset, _ in pieces],
                    "sizes": [len(p) for _, _, p in pieces],
                    "pieces": squeeze(np.concatenate([p for _, _, p in pieces]).tobytes()),
                }
                for shard, whole in waiting.items()
                for pieces in (whole[k : k + step] for k in range(0, len(whole), step))
            ]
            waiting.clear()
            return pa.RecordBatch.from_pylist(rows, PIECE_FIELDS)

        for batch in batches:
            for before, starts, packed in zip(*(batch.column(k) for k in (0, 1, 4))):
                own = np.frombuffer(expand(packed.as_py()), kind)
                first = before.as_py() + starts[0].as_py()
                numbers = np.arange(first // sequence, (first + len(own) - 1) // sequence + 1)
                for number, slot in zip(numbers.tolist(), slots_of(numbers, total, key).tolist()):
                    begin = max(first, number * sequence)
                    piece = own[begin - first : (number + 1) * sequence - first]
                    waiting.setdefault(slot // shard_slots, []).append(
                        (slot, begin - number * sequence, piece)
                    )
                held += own.nbytes
                if held >= HELD_BYTES:
                    yield flush()
                    held = 0
        yield flush()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pieces of whole shards, in the order of shards, to their records."""
        expand = zstandard.ZstdDecompressor().decompress
        now, records = -1, np.zeros((0, 0), np.uint8)

        def flush() -> Iterator[pa.RecordBatch]:
            for a in range(0, len(records) if now >= 0 else 0, CHUNK_SLOTS):
                # The writer adds the last line break of a chunk.
                chunk = records[a : a + CHUNK_SLOTS].tobytes()[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([now]), pa.array([a]), pa.array([chunk], pa.binary())],
                    ["shard", "chunk", "records"],
                )

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != now:
                    yield from flush()
                    now = row["shard"]
                    size = min(shard_slots, total - now * shard_slots)
                    whole = np.full((size, sequence), end, kind)
                    records = np.full((size, layout.stride), 10, np.uint8)
                    records[:, :-1] = whole.view(np.uint8)
                    del whole
                data, at = np.frombuffer(expand(row["pieces"]), np.uint8), 0
                for slot, offset, n in zip(row["slots"], row["offsets"], row["sizes"]):
                    to, n = offset * kind.itemsize, n * kind.itemsize
                    records[slot - now * shard_slots, to : to + n] = data[at : at + n]
                    at += n
        yield from flush()

    shards = -(-total // shard_slots)
    if total:
        # A task holds one shard, also where it gets several.
        ranges = min(shards, MANY_SHARDS)
        spread = stream.mapInArrow(cut, PIECES).repartitionByRange(ranges, "shard")
        chunks = spread.sortWithinPartitions("shard").mapInArrow(
            assemble, "shard long, chunk long, records binary"
        )
        (
            chunks.sortWithinPartitions("shard", "chunk")
            .select(F.col("records").cast("string"), "shard")
            .write.partitionBy("shard")
            .option("lineSep", "\n")
            .text(path)
        )
    documents = stream.select("before", F.explode(F.arrays_zip("starts", "sizes", "ids")).alias("d"))
    documents = documents.select(
        (F.col("d.starts") + F.col("before")).alias("start"),
        F.col("d.sizes").alias("n"),
        F.col("d.ids").alias("id"),
    )
    numbers = F.sequence(
        F.call_function("div", "start", F.lit(sequence)),
        F.call_function("div", F.col("start") + F.col("n") - 1, F.lit(sequence)),
    )
    held = documents.select("start", "id", F.explode(numbers).alias("sequence"))

    @F.arrow_udf("long")
    def slot_column(numbers: pa.Array) -> pa.Array:
        return pa.array(slots_of(numbers.to_numpy(zero_copy_only=False), total, key))

    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("start", "id"))), lambda s: s["id"]
    )
    index = held.groupBy("sequence").agg(listed.alias("doc_ids"))
    return layout, index.select(
        "sequence",
        slot_column("sequence").alias("slot"),
        F.least(F.lit(sequence), F.lit(tokens) - F.col("sequence") * sequence).alias("n_tokens"),
        "doc_ids",
    )


def read_slots(spark: SparkSession, layout: Layout, first: int = 0, last: int | None = None) -> DataFrame:
    """(slot, shard, offset, ids) of the records of slots ``first`` to ``last`` - 1, read back
    from their shards; only those shards are opened. ``ids`` holds the bytes of a sequence."""
    last = layout.sequences if last is None else min(last, layout.sequences)
    schema = "slot long, shard long, offset long, ids binary"
    if first >= last:
        return spark.createDataFrame([], schema)
    stride, shard_slots = layout.stride, layout.shard_slots

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer()
                if data.size % stride:
                    raise ValueError(f"shard {shard} has {data.size} bytes, not a multiple of {stride}")
                begin = shard * shard_slots
                places = range(max(0, first - begin), min(data.size // stride, last - begin))
                for a in range(places.start, places.stop, 1000):
                    rows = places[a - places.start : a - places.start + 1000]
                    records = [data[k * stride : (k + 1) * stride - 1].to_pybytes() for k in rows]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([begin + k for k in rows], pa.int64()),
                            pa.array([shard] * len(rows), pa.int64()),
                            pa.array([k * stride for k in rows], pa.int64()),
                            pa.array(records, pa.binary()),
                        ],
                        ["slot", "shard", "offset", "ids"],
                    )

    files = spark.read.format("binaryFile").load(layout.path)
    wanted = files.filter(F.col("shard").between(first // shard_slots, (last - 1) // shard_slots))
    return wanted.select(F.col("shard").cast("bigint"), "content").mapInArrow(cut, schema)


def training_sequences(docs: DataFrame, path: str, file: str, end: int) -> DataFrame:
    """Write ``docs`` in training order and read the shards back: one row per sequence with
    its slot, where it lies, its tokens' checksum and its documents."""
    layout, index = write_training_order(docs, path, file, end)
    read = read_slots(docs.sparkSession, layout).select(
        F.col("slot").alias("_slot"), "shard", "offset", F.crc32("ids").alias("ids_crc32")
    )
    return index.join(read, F.col("slot") == F.col("_slot")).select(
        "slot", "shard", "offset", "sequence", "n_tokens", "ids_crc32", "doc_ids"
    )
