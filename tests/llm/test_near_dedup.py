import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from cases import AWKWARD, awkward, empty, rows
from compare import connect, duck_rows, spark_rows
from starloom.llm import arrays, near_dedup, queries
from starloom.llm.components import components

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [shingle_set(t) for _, t in docs]
    up = {d: d for d, _ in docs if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j, (b, _) in enumerate(docs[:i]):
            both = len(sets[i] & sets[j])
            if None not in (a, b) and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    out = []
    for (d, _), s in zip(docs, sets):
        c = None if d is None else root(d)
        out.append((d, len(s), c, d == c))
    return sorted(out, key=repr)


def family(seed=3, size=150, steps=12):
    """Copies of copies, each with some words changed: chains around the threshold, exact
    copies and strangers."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    docs, texts = [], [[rng.choice(vocabulary) for _ in range(120)] for _ in range(4)]
    for k in range(size):
        words = list(rng.choice(texts))
        for _ in range(rng.randrange(steps)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.6:
            texts.append(words)
        docs.append((k * 7 % 1009, " ".join(words)))
    return docs


def test_whole_table_equals_sql(spark):
    df = queries.op6_near_duplicates(spark, SF)
    assert spark_rows(df) == duck_rows(connect(SF), queries.SQL["op6_near_duplicates"])


@pytest.mark.parametrize("block", [512, 16])
def test_family_around_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_DOCUMENTS", block)
    docs = family()
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(found) == brute(docs)


def thue_morse(length, letters):
    return "".join(letters[bin(k).count("1") % 2] for k in range(length))


def test_words_built_to_collide_stay_apart(spark):
    """Sums of letters times powers modulo 2**64 are equal for these words, for every base."""
    a, b = thue_morse(1024, "ab"), thue_morse(1024, "ba")
    data = np.frombuffer((a + " " + b).encode(), np.uint8)
    at = np.array([0, len(data)])
    assert len(set(arrays.words(data, at).hash.tolist())) == 1
    assert len(set(arrays.words(data, at, hashes=arrays.sound_hashes).hash.tolist())) == 2
    docs = [(1, a), (2, b), (3, f"{a} x y z w"), (4, f"{b} x y z w"), (5, f"{a}  X\tY z w")]
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(found) == brute(docs)
    assert [r.component_id for r in found.orderBy("doc_id").collect()] == [1, 2, 3, 4, 3]


def test_links_are_confirmed_on_the_shingles(spark, monkeypatch):
    """Even if all hashes collide, no text without a common shingle is linked."""
    def same(data, start, end):
        return np.full(len(start), 7, np.uint64)

    monkeypatch.setattr(near_dedup, "sound_hashes", same)
    texts = [" ".join(f"{x}{k}" for k in range(8)) for x in "abc"] + [" ".join(f"a{k}" for k in range(8)) + " "]
    pdf = pd.DataFrame({"_id": [1, 2, 3, 4], "text": texts})
    for sides in ([1, 2, 2, 2], [3, 3, 3, 3], [2, 2, 2, 1]):
        assert near_dedup._confirm(pdf.assign(_side=sides)).values.tolist() == [[4, 1]]
    assert near_dedup._confirm(pdf.assign(_side=[1, 2, 2, 1])).empty


def test_a_family_is_compared_with_its_leader(spark, monkeypatch):
    """Copies of one template: texts sent to tasks grow with the family, not with its square."""
    monkeypatch.setattr(near_dedup, "BLOCK_DOCUMENTS", 16)
    sent = []
    original = near_dedup._compared

    def keep(texts, work, keys):
        sent.append(work.count())
        return original(texts, work, keys)

    monkeypatch.setattr(near_dedup, "_compared", keep)
    per_size = []
    for size in (200, 800):
        words = [f"w{k}" for k in range(200)]
        docs = [(k, " ".join([*words[:100], f"x{k}", *words[101:]])) for k in range(size)]
        sent.clear()
        found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
        assert {r.component_id for r in found.collect()} == {0}
        per_size.append(sum(sent))
    assert per_size[1] < 5 * per_size[0] and per_size[1] < 3 * 800


def test_same_shingles_in_another_order_are_linked(spark):
    parts = [" ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))]
    docs = [(7, " ".join(parts)), (3, " ".join(parts[::-1])), (5, " ".join(parts * 2))]
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(found) == brute(docs) and {r.component_id for r in found.collect()} == {3}


def test_awkward_rows(spark):
    docs = awkward(spark, component_id=1, kept=False, bucket=3, leader=4, digest="x")
    assert rows(near_dedup.near_duplicates(docs)) == brute([(d, t) for d, t, *_ in AWKWARD])


def test_many_exact_copies(spark):
    docs = [(k, AWKWARD[9][1][:900]) for k in range(500, 0, -1)]
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.component_id for r in found.collect()} == {1}
    assert found.filter("kept").count() == 1


def test_empty_table(spark):
    assert near_dedup.near_duplicates(empty(spark)).collect() == []


def test_second_permutation_is_one_and_estimates(spark):
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(near_dedup._permute(x.copy(), 0x21F0AAAD, 0xD35A2D97))) == len(x)
    words = [f"v{k * k % 7919}" for k in range(3000)]
    a, b = near_dedup.sets(pa.array([" ".join(words), " ".join(words[600:])]))
    both = len(np.intersect1d(a, b))
    exact = both / (len(a) + len(b) - both)
    share = (near_dedup.signature(a) == near_dedup.signature(b)).mean()
    assert abs(share - exact) < 0.12


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(30)]
    links += [(7, 7), (200, None), (300, 301), (301, 300)]
    found = dict(rows(components(spark.createDataFrame(links, "u long, v long"))))
    assert {found[k] for k in range(41)} == {0} and {found[100 + k] for k in range(30)} == {100}
    assert found[301] == found[300] == 300 and 200 not in found
    assert rows(components(spark.createDataFrame([], "u long, v long"))) == []


def test_several_texts_of_one_id_are_one_node(spark):
    first, second = (" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    third, fourth = (" ".join(f"{x}{k}" for k in range(30)) for x in "cd")
    # 5 ties 3 to its second text; 8 ties the classes of 6 and 7 together.
    docs = [(3, first), (5, first), (5, second), (6, third), (7, fourth), (8, third), (8, fourth)]
    docs += [(9, "alone with " + second[:20]), (10, None), (10, first + " x")]
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(found) == brute(docs)
    assert {r.component_id for r in found.collect() if r.doc_id in (3, 5)} == {3}


def test_the_filter_misses_less_than_the_bands():
    n, least = near_dedup.COORDINATES, math.ceil(near_dedup.LEAST_SHARE * near_dedup.COORDINATES)
    tail = sum(math.comb(n, k) * 0.75**k * 0.25 ** (n - k) for k in range(least))
    assert tail < (1 - 0.75**near_dedup.ROWS) ** near_dedup.BANDS < 3e-7
