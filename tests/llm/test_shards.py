import zlib

import pytest

from cases import AWKWARD, awkward, empty
from compare import connect, duck_rows, spark_rows
from starloom.llm import queries, shards
from starloom.operators import numbering

SF = "/root/testdata/sf0.001"


def brute(docs, n):
    rows = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    total, before, out, slots = sum(r[1] for r in rows), 0, [], {}
    for doc, size, crc in rows:
        shard = min(n - 1, (2 * before + size) * n // (2 * total))
        out.append((doc, size, crc, "bytes", shard, slots.setdefault(shard, 0), None))
        slots[shard] += 1
        before += size
    return sorted(out, key=repr)


def test_whole_table_equals_sql(spark):
    df = queries.op4_shards(spark, SF)
    assert spark_rows(df) == duck_rows(connect(SF), queries.SQL["op4_shards"])


def test_awkward_rows(spark):
    docs = awkward(spark, shard=99, slot="x", size=1, _row=1, _key="y")
    found = sorted((tuple(r) for r in shards.document_shards(docs, 4).collect()), key=repr)
    assert found == brute([(d, t) for d, t, *_ in AWKWARD], 4)


HOT = {
    "a third on one id": lambda k: 77 if k % 3 == 0 else k,
    "no ids": lambda k: None,
    "a third without an id, a third on one id": lambda k: [None, 5, k][k % 3],
    "two hot ids and their neighbours": lambda k: [40, 41, 39, 42, k % 90][k % 5],
}


@pytest.mark.parametrize("ids", HOT)
@pytest.mark.parametrize("hot_rows", [numbering.HOT_ROWS, 300])
def test_hot_ids_are_spread(spark, monkeypatch, ids, hot_rows):
    """However many rows an id holds, no range does; copies of whole rows included."""
    monkeypatch.setattr(numbering, "HOT_ROWS", hot_rows)
    docs = [(HOT[ids](k), "same text" if k % 4 == 0 else f"text {k}") for k in range(3000)]
    seen = []
    original = shards.running_totals

    def keep(df, *args):
        sizes = [r["count"] for r in df.groupBy("_part").count().collect()]
        seen.append(max(sizes) / sum(sizes))
        return original(df, *args)

    monkeypatch.setattr(shards, "running_totals", keep)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = spark.createDataFrame(docs, "doc_id long, text string")
        found = sorted((tuple(r) for r in shards.document_shards(df, 7).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == brute(docs, 7)
    assert seen[0] < 0.06


def test_empty_table(spark):
    assert shards.document_shards(empty(spark), 4).collect() == []


def test_written_shards_are_contiguous(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "doc_id", "text", "cast(octet_length(text) + 16 as bigint) as size"
    )
    shards.write_shards(docs, str(tmp_path / "out"), 5, "size", "doc_id")
    back = spark.read.parquet(str(tmp_path / "out"))
    rows = back.orderBy("shard", "slot").collect()
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows) and len(rows) == docs.count()
    sizes = [sum(r.size for r in rows if r.shard == k) for k in range(5)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)
