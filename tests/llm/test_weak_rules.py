import random
import re
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, PROSE, awkward, empty, rows
from starloom.llm import queries, weak_rules

SF = "/root/testdata/sf0.001"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(inside),
        len(words) < 50 or 100 * len(inside) > 50 * len(words),
    )


def by_em(votes, counts, wrong, trust):
    """The estimate once more, a document and a rule at a time."""
    docs = [tuple(v) for v, c in zip(votes, counts) for _ in range(int(c))]
    good = {d: 0.25 if 2 in d else 0.95 for d in docs}
    for _ in range(300):
        rate = {}
        for j in range(len(docs[0])):
            for y in (0, 1):
                cast = [0, weak_rules.PRIOR, weak_rules.PRIOR]
                for d in docs:
                    cast[d[j]] += good[d] if y == 0 else 1 - good[d]
                if y == 0:
                    cast[1] += trust * len(docs) * (1 - wrong)
                    cast[2] += trust * len(docs) * wrong
                rate[y, j] = cast[2] / (cast[1] + cast[2])
        share = (sum(good[d] for d in docs) + weak_rules.PRIOR) / (len(docs) + 2 * weak_rules.PRIOR)
        for d in good:
            odds = [share, 1 - share]
            for y in (0, 1):
                for j, v in enumerate(d):
                    odds[y] *= {0: 1, 1: 1 - rate[y, j], 2: rate[y, j]}[v]
            good[d] = odds[0] / sum(odds)
    return good


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op11_weak_rules(spark, SF).collect()
    assert {r.doc_id: tuple(r[c] for c in BASE) for r in found} == {d: brute(t) for d, t in texts.items()}
    assert len(found) == len(texts)
    by_votes = {r.votes: r.quality for r in found}
    votes = np.array([[int(v) for v in pattern] for pattern in by_votes])
    counts = [sum(r.votes == pattern for r in found) for pattern in by_votes]
    expected = by_em(votes, counts, weak_rules.WRONG, weak_rules.TRUST)
    for pattern, quality in by_votes.items():
        assert quality == pytest.approx(expected[tuple(map(int, pattern))], abs=1e-4)
    assert all(r.kept == (not r.base_failed and r.quality >= 0.5) for r in found)


def test_labels_agree(spark):
    """Labels are no input; of documents that pass the base rules, good ones stay, bad ones go."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = queries.op11_weak_rules(spark, sf).filter("NOT base_failed").join(labels, "doc_id")
    shares = dict(rows(judged.groupBy(labels["quality"]).agg(F.avg(F.col("kept").cast("int")))))
    assert shares[1] > 0.99 and shares[0] < 0.1


def test_awkward_rows(spark):
    docs = awkward(spark, votes="x", n_words=3, kept=True, pattern=4)
    found = weak_rules.judge(docs)[0].collect()
    assert sorted((r.doc_id, *[r[c] for c in BASE]) if r.doc_id != 14 else (14,) for r in found if r.doc_id is not None) == sorted(
        (d, *brute(t)) if d != 14 else (14,) for d, t, *_ in AWKWARD if d is not None
    )
    assert [tuple(r[c] for c in BASE) for r in found if r.doc_id is None] == [brute(AWKWARD[2][1])]
    assert all(0 <= r.quality <= 1 for r in found)
    assert [r.n_repeat_words for r in found if r.doc_id == 14] == [len(AWKWARD[9][1].split())]


def test_empty_table(spark):
    found, raters = weak_rules.judge(empty(spark))
    assert found.collect() == [] and raters is None


def test_repeated_words_by_hand():
    for n, k in product(range(9), range(1, 4)):
        rng = random.Random(n * 10 + k)
        for _ in range(20):
            words = [rng.choice("abc"[:k]).encode() for _ in range(n)]
            assert weak_rules.repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_very_long_text():
    text = (PROSE + "\n") * 4000
    found = dict(zip(weak_rules.MEASURES, weak_rules.measures(text)))
    assert found["n_dup_lines"] == 3999 and found["n_repeat_words"] == found["n_words"]


def test_unreliable_rule_loses_its_weight(spark):
    """Planted raters: EM finds the accuracies, and the verdict beats the worst rule."""
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.85
    hits = np.array([0.7, 0.6, 0.8, 0.3])  # of bad documents
    slips = np.array([0.001, 0.002, 0.001, 0.25])  # of good ones: the last rule is bad at it
    fires = rng.random((len(truth), 4)) < np.where(truth[:, None], slips, hits)
    votes = np.where(fires, 2, np.where(rng.random(fires.shape) < 0.1, 0, 1))
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    raters = weak_rules.estimate(patterns, counts.astype(float), trust=0.3)
    kept = raters.posterior(patterns)[at] >= 0.5
    assert np.abs(raters.rates[1, :3, 2] - hits[:3]).max() < 0.25
    assert (kept == truth).mean() > 0.9 > (fires.any(axis=1) == ~truth).mean()


def test_too_many_rules(spark):
    rule = weak_rules.standard_rules()[0]
    with pytest.raises(ValueError):
        weak_rules.judge(empty(spark), lambda: [rule] * 11)
