import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import public_tokenizers

from cases import AWKWARD, awkward, empty
from starloom.llm import queries, training_order as order

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_and_its_inverse(n):
    numbers = np.arange(n)
    slots = order.slots_of(numbers, n, 11)
    assert sorted(slots.tolist()) == numbers.tolist()
    assert (order.sequences_of(slots, n, 11) == numbers).all()
    if n > 50:
        assert (slots != order.slots_of(numbers, n, 12)).any()
        assert abs(np.corrcoef(numbers, slots)[0, 1]) < 0.3


def tokens(text):
    return order.encoding(FILE).encode_ordinary(text or "") + [queries.END]


def check(spark, docs, path, length, slots):
    """Round trip: the shards read back give every document's tokens, whole and in order."""
    layout, index = order.write_training_order(docs, path, FILE, queries.END, length, slots)
    records = {r.slot: r for r in order.read_slots(spark, layout).collect()}
    rows = sorted(index.collect(), key=lambda r: r.sequence)
    assert sorted(records) == list(range(layout.sequences)) == [r.sequence for r in rows]
    assert sorted(r.slot for r in rows) == list(range(layout.sequences))
    stream, ids = [], []
    for r in rows:
        own = np.frombuffer(records[r.slot].ids, "<u2").tolist()
        assert len(own) == length and layout.place(r.slot) == (records[r.slot].shard, records[r.slot].offset)
        assert set(own[r.n_tokens :]) <= {queries.END}
        stream += own[: r.n_tokens]
        ids += r.doc_ids
    found, held = [], []
    for token in stream:
        held.append(token)
        if token == queries.END:
            found.append(tuple(held))
            held = []
    assert not held
    texts = docs.select("doc_id", "text").collect()
    assert sorted(found) == sorted(tuple(tokens(r.text)) for r in texts)
    assert {d for d in ids} == {r.doc_id for r in texts}
    return layout


def test_whole_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    layout = check(spark, docs, str(tmp_path / "shards"), 128, 50)
    # Going on at a slot opens only the shards that follow.
    rest = order.read_slots(spark, layout, 120, 180).collect()
    assert sorted(r.slot for r in rest) == list(range(120, 180)) and {r.shard for r in rest} == {2, 3}
    data = (tmp_path / "shards" / "shard=2").glob("part-*")
    raw = b"".join(f.read_bytes() for f in data)
    assert len(raw) == 50 * layout.stride
    at = 20 * layout.stride
    assert bytes(next(r for r in rest if r.slot == 120).ids) == raw[at : at + 256]


def test_shards_grow_to_a_bound(spark, tmp_path, monkeypatch):
    """Beyond the bound there are more shards, several of them in a task."""
    monkeypatch.setattr(order, "SHARD_SLOTS", 2)
    monkeypatch.setattr(order, "MANY_SHARDS", 3)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for most, expected in ((1 << 20, None), (5, 5)):
        monkeypatch.setattr(order, "MOST_SLOTS", most)
        path = tmp_path / str(most)
        layout = check(spark, docs, str(path), 128, None)
        assert layout.shard_slots == (expected or -(-layout.sequences // 3))
        shards = list(path.glob("shard=*"))
        assert len(shards) == -(-layout.sequences // layout.shard_slots)
        assert all(len(list(s.glob("part-*"))) == 1 for s in shards)
    assert len(shards) > 6


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, slot="x", shard=1, ids=2, part=3)
    check(spark, docs, str(tmp_path / "a"), 16, 7)
    check(spark, docs, str(tmp_path / "b"), 5000, 4)
    assert AWKWARD[0][1] is None and tokens(None) == [queries.END]


def test_empty_table(spark, tmp_path):
    layout, index = order.write_training_order(empty(spark), str(tmp_path / "x"), FILE, queries.END)
    assert layout.sequences == 0 and index.collect() == []
    assert order.read_slots(spark, layout).collect() == []


def test_query_shows_what_lies_in_the_shards(spark):
    rows = queries.op5_training_order(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sum(r.n_tokens for r in rows) == sum(len(tokens(d.text)) for d in docs)
    assert {d for r in rows for d in r.doc_ids} == {d.doc_id for d in docs}
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    # A document that fills its sequence alone is found by its checksum.
    own = {d.doc_id: tokens(d.text) for d in docs}
    for r in rows:
        if len(r.doc_ids) == 1:
            whole, n = own[r.doc_ids[0]], r.n_tokens
            parts = {
                zlib.crc32(np.array(whole[k : k + n], "<u2").tobytes()) for k in range(len(whole) - n + 1)
            }
            if n == order.SEQUENCE:
                assert r.ids_crc32 in parts


def stream_ids(docs, path):
    _, index = order.write_training_order(docs, path, FILE, queries.END, 16, 8)
    ids = []
    for r in sorted(index.collect(), key=lambda r: r.sequence):
        # A document in several sequences is listed by each.
        ids += r.doc_ids[1:] if ids and r.doc_ids[0] == ids[-1] else r.doc_ids
    return ids


def test_stream_keeps_the_order_of_many_unequal_files(spark, tmp_path):
    """Spark reads large files first, packs small ones together and splits large ones."""
    rng, at = np.random.default_rng(5), 0
    folder = str(tmp_path / "docs")
    for k, n in enumerate([3, 40, 1, 200, 7, 90, 2, 400, 11, 5]):
        rows = [(at + d, " ".join(str(v) for v in rng.integers(0, 9999, 20))) for d in range(n)]
        table = pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})
        (tmp_path / "docs").mkdir(exist_ok=True)
        pq.write_table(table, f"{folder}/part-{k:05d}-x.parquet", row_group_size=50)
        at += n
    # Beyond five digits numbers get longer.
    more = pa.table({"doc_id": list(range(at, at + 60)), "text": ["more words"] * 60})
    pq.write_table(more, f"{folder}/part-100000-x.parquet")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for most, cost in (("8k", "0"), ("100k", "0"), ("1g", "1k")):
            spark.conf.set(names[0], most)
            spark.conf.set(names[1], cost)
            docs = spark.read.parquet(folder)
            assert stream_ids(docs, str(tmp_path / f"shards-{most}")) == list(range(at + 60))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    turned = spark.read.parquet(folder).orderBy("doc_id", ascending=False)
    assert stream_ids(turned, str(tmp_path / "turned")) == list(range(at + 60))[::-1]
    joined = spark.read.parquet(folder).join(spark.read.parquet(folder).select("doc_id"), "doc_id")
    assert sorted(stream_ids(joined, str(tmp_path / "joined"))) == list(range(at + 60))
