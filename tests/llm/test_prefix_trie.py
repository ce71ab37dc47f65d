import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cases import rows
from compare import connect, duck_rows, spark_rows
from starloom.llm import prefix_trie, queries
from starloom.operators import numbering

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def turn_digest(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}:{len(text.encode())}:{text}".encode()).digest()


def brute(turns):
    told = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            told[c].append((turn is not None, turn or 0, turn_digest(role, text), role or "", text or ""))
    told = {c: [t[3:] for t in sorted(ts)] for c, ts in told.items()}
    members = defaultdict(list)
    built = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        built[c] = tuple(told.get(head, [])[:h] + own[h:])
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(p[-1][1].encode().split()) if p else 0
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in children[p])
    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == p)
        above = min(members[p[:-1]]) if p else None
        end = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(p), above, len(convs), len(children[p]), leaves[p], saved[p], end))
    return sorted(out, key=repr)


def trie(spark, turns, **extra):
    df = spark.createDataFrame(turns, SCHEMA).withColumns({k: F.lit(v) for k, v in extra.items()})
    return rows(prefix_trie.prefix_trie(df).drop("node", "parent"))


def talks(seed, conversations=90):
    """Few different turns, so that prefixes are shared; some turns long, one conversation of 300."""
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(-200, 400), conversations):
        for turn in range(rng.choice([1, 1, 2, 5, 9])):
            out.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["a", "b c", "d e f"])))
    out += [(1000, k, "user", f"turn {k % 3}") for k in range(300)]
    out += [(1001, k, "user", f"turn {k % 3}") for k in range(280)]
    return out


AWKWARD = [
    (0, 0, "user", "first of the head"),
    (0, 1, "assistant", "second"),
    (3, 1, None, None),
    (3, None, "user", "turn without a number comes first"),
    (3, 1, "user", ""),
    (3, 1, "user", ""),
    (5, 0, "user", "word " * 30_000),
    (5, 0, "user", "tie with the long one"),
    (None, 0, "user", "no conversation"),
    (-7, 2, "us", "er1:a"),
    (-8, 2, "user", "1:a"),
    (23, 7, "user", "Ünï   not a separator\x0b\x1c\x00 x"),
    (24, 7, "user", "dropped if its own first turn is not kept"),
    (25, 7, "user", "dropped if its own first turn is not kept"),
    (26, 7, "user", "dropped if its own first turn is not kept"),
]


def test_whole_table_equals_sql(spark):
    df = queries.op13_prefix_trie(spark, SF)
    assert spark_rows(df) == duck_rows(connect(SF), queries.SQL["op13_prefix_trie"])


def test_awkward_rows(spark):
    assert trie(spark, AWKWARD, c=1, node="x", depth=3, part=2, id="y", level=1) == brute(AWKWARD)


def test_empty_table(spark):
    assert trie(spark, []) == []


@pytest.mark.parametrize("bound, bits", [(4096, 13), (40, 4), (3, 2)])
def test_rounds_of_shards(spark, monkeypatch, bound, bits):
    """The same totals from one shard, from some, and from rounds of tiny ones."""
    monkeypatch.setattr(prefix_trie, "BOUND", bound)
    monkeypatch.setattr(prefix_trie, "PART_BITS", bits)
    monkeypatch.setattr(prefix_trie, "ENDS_BITS", bits)
    turns = talks(bound)
    assert trie(spark, turns) == brute(turns)


def test_hot_conversation_and_first_turn(spark, monkeypatch):
    """Half of the rows are one conversation, all others begin alike, most end alike."""
    monkeypatch.setattr(prefix_trie, "BOUND", 25)
    monkeypatch.setattr(prefix_trie, "PART_BITS", 5)
    monkeypatch.setattr(numbering, "HOT_ROWS", 100)
    turns = [(2000, k // 3, "user", f"w {k}") for k in range(400)]
    turns += [(c, k, "user", "common" if k < 3 else f"w {c % 4}") for c in range(100) for k in range(4)]
    assert trie(spark, turns) == brute(turns)


def test_shards_are_bounded(spark, monkeypatch):
    """However wide or deep the tree, a task's shard holds a few times the bound."""
    monkeypatch.setattr(prefix_trie, "BOUND", 20)
    seen = []
    original = prefix_trie._swept

    def keep(nodes, r, most):
        top = F.when(F.col("level") > r, F.col("id")).otherwise(F.col("ups")[min(r + 1, most)]["id"])
        seen.append(nodes.groupBy(top).count().agg(F.max("count")).first()[0] or 0)
        return original(nodes, r, most)

    monkeypatch.setattr(prefix_trie, "_swept", keep)
    turns = talks(7, 200)
    assert trie(spark, turns) == brute(turns)
    assert len(seen) > 3 and max(seen) <= 4 * 20


def test_spilling_queue():
    rng = random.Random(2)
    queue, expected, found = prefix_trie.SpillingQueue(8), [], []
    for k in range(400):
        entry = (rng.randrange(50), k)
        queue.push(entry)
        expected.append(entry)
        if k % 7 == 0:
            expected.sort()
            assert queue.least() == expected[0] == queue.pop()
            expected.pop(0)
    assert len(queue.heap) <= 8 and queue.runs
    while queue.least() is not None:
        found.append(queue.pop())
    assert found == sorted(expected)
