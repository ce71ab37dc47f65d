from collections import Counter
from fractions import Fraction
from itertools import islice

import pytest

from cases import AWKWARD, awkward, empty
from starloom.llm import mixing, queries
from starloom.operators import numbering

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "weights",
    [
        {"a": 1},
        {"a": 5, "b": 3, "c": 2},
        {f"s{k}": 1 + k * k for k in range(23)},
        {"tiny": 1, "big": 999, "none": 0},
    ],
)
def test_every_block_meets_its_window(weights):
    shares = mixing.ratios(weights)
    whole = sum(shares.values())
    assert "none" not in shares
    done: Counter = Counter()
    table = list(islice(mixing.schedule(shares), whole))
    assert [slot for *_, slot in table] == list(range(whole))
    for source, block, release, deadline, slot in table:
        assert block == done[source] and release <= slot < deadline
        assert release == block * whole // shares[source]
        assert deadline == -(-(block + 1) * whole // shares[source])
        done[source] += 1
        for s, q in shares.items():
            assert abs(done[s] - (slot + 1) * q / whole) < 1
    assert done == Counter(shares)


def brute(docs, weights, block_bytes):
    """The same mixture slot by slot: (slot, offset, block, epoch, id) of every place."""
    sources: dict = {}
    for turn, doc, source, size in sorted(docs, key=repr):
        sources.setdefault(source, []).append((turn, doc, size))
    placed, blocks = {}, {}
    for source, own in sources.items():
        at = 0
        for _, doc, size in sorted(own):
            placed.setdefault((source, at // block_bytes), []).append((at, doc))
            at += size
        blocks[source] = -(-at // block_bytes)
    number: Counter = Counter()
    out, table = [], mixing.schedule(mixing.ratios({s: weights[s] for s in sources}))
    while any(number[s] < n for s, n in blocks.items()):
        source, _, _, _, slot = next(table)
        epoch, block = divmod(number[source], blocks[source])
        out += [(slot, at, block, epoch, doc) for at, doc in placed.get((source, block), [])]
        number[source] += 1
    return sorted(out)


def test_mixture_equals_slot_by_slot(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    weights = {f"src{k}": 1.0 + k % 3 for k in range(20)}
    mixed = mixing.mix(docs, weights, block_bytes=3000).select(
        "mix_slot", "mix_offset", "mix_block", "mix_epoch", "doc_id", "source"
    )
    # Parts come first in the order of a source, of which there is one for few rows.
    turns = docs.selectExpr(
        "xxhash64(cast(doc_id as string), 'mix') as turn", "doc_id", "source", "octet_length(text) + 1 as size"
    ).collect()
    expected = brute([tuple(r) for r in turns], weights, 3000)
    assert sorted(tuple(r)[:5] for r in mixed.collect()) == expected
    assert {e[4] for e in expected} == {r.doc_id for r in turns}


def test_parts_of_a_large_source_are_one_order(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 5)
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "'one' as source")
    rows = mixing.mix(docs, block_bytes=1000).orderBy("mix_offset").collect()
    sizes = {r.doc_id: len(r.text.encode()) + 1 for r in rows}
    at = 0
    for r in rows:
        assert r.mix_offset == at and r.mix_epoch == 0
        at += sizes[r.doc_id]


HOT = {
    "a third on one id": lambda k: 7 if k % 3 == 0 else k,
    "all without an id": lambda k: None,
    "two hot ids": lambda k: [40, 41, k][k % 3],
}


@pytest.mark.parametrize("ids", HOT)
@pytest.mark.parametrize("hot_rows", [numbering.HOT_ROWS, 200])
def test_hot_ids_are_spread(spark, monkeypatch, ids, hot_rows):
    """However many rows an id holds, no part does, copies of whole rows included; the order and
    the offsets of a source have no gaps, and each row comes once."""
    monkeypatch.setattr(numbering, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(mixing, "PART_ROWS", 10)
    rows = [(HOT[ids](k), "copy" if k % 4 else f"text {k}", ["a", "b", None][k % 5 % 3]) for k in range(3000)]
    seen = []
    original = mixing.running_totals

    def keep(df, group, part, *rest):
        sizes = [r["count"] for r in df.groupBy(*group, part).count().collect()]
        seen.append(max(sizes) / sum(sizes))
        return original(df, group, part, *rest)

    monkeypatch.setattr(mixing, "running_totals", keep)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, block_bytes=100).filter("mix_epoch = 0").collect()
    assert seen[0] < 0.03
    assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter(rows)
    for source in ("a", "b", None):
        at = 0
        for r in sorted((r for r in found if r.source == source), key=lambda r: r.mix_offset):
            assert r.mix_offset == at and r.mix_block == at // 100
            at += len(r.text) + 1
        own = [r.doc_id for r in sorted((r for r in found if r.source == source), key=lambda r: r.mix_offset)]
        runs = Counter(doc for k, doc in enumerate(own) if k == 0 or own[k - 1] != doc)
        assert set(runs.values()) == {1}  # rows of one id lie together


def test_blocks_grow_with_the_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 10)
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 50)
    docs = spark.range(1000).selectExpr("id as doc_id", "concat('s', id % 3) as source", "7L as size")
    found = mixing.mix(docs, size=docs["size"]).collect()
    assert {r.doc_id for r in found} == set(range(1000))
    assert all(r.mix_block == r.mix_offset // 140 for r in found)
    assert max(r.mix_slot for r in found) < 60


def test_default_weights_on_the_whole_table(spark):
    rows = queries.op9_mixing(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    assert len({(r.doc_id, r.mix_epoch) for r in rows}) == len(rows)


def test_awkward_rows(spark):
    docs = awkward(spark, mix_slot="x", p_of=1, s_of=2, _size=3)
    first = mixing.mix(docs, block_bytes=64).filter("mix_epoch = 0")
    kept = sorted(((r.doc_id, r.text, r._size) for r in first.collect()), key=repr)
    assert kept == sorted(((d, t, 3) for d, t, *_ in AWKWARD), key=repr)
    only = mixing.mix(awkward(spark), {"c": 1.0, "a": 0.0, "unknown": 2.0}).collect()
    assert {r.source for r in only} == {"c"}


def test_null_is_a_source(spark):
    docs = spark.createDataFrame([(1, "x", None), (2, "y", "NULL")], "doc_id long, text string, source string")
    found = mixing.mix(docs, {None: 1.0, "NULL": 1.0}).collect()
    assert sorted(r.mix_slot for r in found) == [0, 1]


def test_empty_table(spark):
    assert mixing.mix(empty(spark)).collect() == []


@pytest.mark.parametrize(
    "weights",
    [
        {"hot": 10e9**0.9, **{f"s{k}": 1e9**0.9 for k in range(19)}, "tiny": 20e3**0.9},
        {f"s{k}": (1.0 + k) ** 0.9 for k in range(5000)},
    ],
)
def test_true_weights_hold_over_many_slots(weights):
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    shares = mixing.ratios(weights)
    whole = sum(shares.values())
    assert all(Fraction(n, whole) == exact[s] / total for s, n in shares.items())
    done: Counter = Counter()
    for source, block, _, _, slot in islice(mixing.schedule(shares), 300_000):
        # Just before a block begins and just after it ends a source is farthest away.
        assert block == done[source]
        assert slot * shares[source] - block * whole < whole
        assert (block + 1) * whole - (slot + 1) * shares[source] < whole
        done[source] += 1
    assert all(abs(done[s] * whole - 300_000 * n) < whole for s, n in shares.items())


def test_tiny_source_and_many_sources(spark):
    """One document of one block beside 20,000 blocks: it comes as often as its weight asks.
    Thousands of sources are mixed as well."""
    big = spark.range(20_000).selectExpr("id as doc_id", "'big' as source", "64L as size")
    tiny = spark.sql("select 99999L as doc_id, 'tiny' as source, 64L as size")
    docs = big.union(tiny)
    mixed = mixing.mix(docs, {"big": 20_000.0, "tiny": 1.0}, size=docs["size"], block_bytes=64)
    assert mixed.filter("source = 'tiny'").count() == 1
    assert mixed.filter("source = 'big'").count() == 20_000
    many = spark.range(5000).selectExpr("id as doc_id", "concat('s', id) as source", "64L as size")
    found = mixing.mix(many, size=many["size"], block_bytes=64).collect()
    assert sorted(r.mix_slot for r in found) == list(range(5000))


def test_source_of_a_few_bytes_does_not_repeat_the_others(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "if(id = 0, 'tiny', 'big') as source", "if(id = 0, 14L, 65536L) as size"
    )
    found = mixing.mix(docs, size=docs["size"])
    assert found.select("doc_id").distinct().count() == 3000 and found.count() < 3100
