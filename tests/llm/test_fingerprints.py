import hashlib

import numpy as np
import pytest

from cases import AWKWARD, awkward, empty
from starloom.llm import fingerprints as f
from starloom.operators import numbering

SF = "/root/testdata/sf0.001/documents.parquet"


def brute(text):
    """Order MinHash by its definition, over the same hash functions."""
    values = f._kmers(np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.uint64))
    if not len(values):
        return f.written(np.zeros(f.COORDINATES, np.uint32))
    seen, number = {}, []
    for v in values.tolist():
        number.append(seen.get(v, 0))
        seen[v] = number[-1] + 1
    salted = f.mix(values + np.array(number, np.uint64) * np.uint64(0xD1B54A32D192ED03))
    base = (salted ^ (salted >> np.uint64(32))).astype(np.uint32)
    out = []
    for c in range(f.COORDINATES):
        hashes = (base ^ f._XOR[c]) * f._TIMES[c]
        chosen = sorted(sorted(range(len(values)), key=lambda i: (hashes[i], i))[: f.PICKED])
        state = np.array([c + 1], np.uint64)
        for i in chosen:
            state = f.mix(state * f._BASE + values[i : i + 1])
        out.append(int(state[0] >> np.uint64(32)))
    return f.written(np.array(out, np.uint32))


def expected(pairs):
    ordered = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    out = []
    for k, (doc, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        a, b, c = (f.sketch(t).coordinates for t in (text, changed, following))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append(
            (doc, len(text), digest, f.written(a), f.written(b), f.likeness(a, b), f.likeness(a, c))
        )
    return sorted(out, key=repr)


def found(docs):
    return sorted((tuple(r) for r in f.compare_neighbours(docs).collect()), key=repr)


def test_sketch_is_order_minhash():
    for _, text, *_ in AWKWARD:
        text = (text or "")[:3000]
        assert f.written(f.sketch(text).coordinates) == brute(text)


def test_shared_beginnings_change_nothing():
    a, b = AWKWARD[9][1], "x" + AWKWARD[9][1]
    changed = f.edited(a, b)
    own = f.sketch(a)
    again = f.sketch(changed, own, len(a) - len(a) // 4)
    assert (again.coordinates == f.sketch(changed).coordinates).all()


def test_whole_table(spark):
    docs = spark.read.parquet(SF)
    assert found(docs) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark):
    docs = awkward(spark, part=1, ahead=True, fingerprint="x")
    assert found(docs) == expected([(d, t) for d, t, *_ in AWKWARD])


def test_one_and_none(spark):
    docs = awkward(spark).filter("doc_id = 9")
    assert found(docs) == expected([(9, "one")])
    assert found(empty(spark)) == []


HOT = {
    "a third on one id": lambda k: 7 if k % 3 == 0 else k,
    "all without an id": lambda k: None,
    "half without an id": lambda k: None if k % 2 else k,
    "one id only": lambda k: 5,
    "smallest and largest": lambda k: [-1, 9999, k][k % 3],
}


@pytest.mark.parametrize("ids", HOT)
@pytest.mark.parametrize("hot_rows", [numbering.HOT_ROWS, 100])
def test_hot_ids_are_spread(spark, monkeypatch, ids, hot_rows):
    """However many rows an id holds, no range does, copies of whole rows included, and every
    document is compared with the next one across ranges."""
    monkeypatch.setattr(numbering, "HOT_ROWS", hot_rows)
    rows = [(HOT[ids](k), "the same text" if k % 4 == 0 else f"text {k * 7919 % 997}") for k in range(900)]
    seen = []
    original = f.spread

    def keep(*args):
        ranged = original(*args)
        sizes = [r["count"] for r in ranged.groupBy("range").count().collect()]
        seen.append(max(sizes) / sum(sizes))
        return ranged

    monkeypatch.setattr(f, "spread", keep)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "45")
    try:
        got = found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected(rows)
    assert seen[0] < 0.05


def test_edits_and_order_lower_the_likeness():
    text = AWKWARD[9][1][:400] + "".join(chr(97 + i * i % 26) for i in range(600))
    own = f.sketch(text).coordinates
    small = f.sketch(text[:500] + "#" + text[500:]).coordinates
    moved = f.sketch(text[500:] + text[:500]).coordinates
    other = f.sketch(text[::-1]).coordinates
    assert 1 > f.likeness(own, small) > f.likeness(own, moved) > f.likeness(own, other)


def test_column(spark):
    docs = f.fingerprints(awkward(spark, fingerprint=1))
    for r in docs.collect():
        assert r.fingerprint == f.written(f.sketch(r.text).coordinates)
