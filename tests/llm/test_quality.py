import time
import zlib

import numpy as np
import pyarrow as pa

from cases import AWKWARD, awkward, empty
from starloom.llm import quality, queries
from starloom.llm.arrays import utf8

SF = "/root/testdata/sf0.01"


def features(texts):
    return quality.line_features(*utf8(pa.array(texts, pa.string())))


def test_marginals_equal_all_paths():
    """Probabilities and expected transitions by summing over every labelling."""
    rng = np.random.default_rng(1)
    at = np.array([0, 4, 5, 8])
    score, tie = rng.normal(size=8), rng.normal(size=(2, 2))
    good, expected, partition = quality.marginals(score, at, tie)
    all_good, all_pairs, all_z = np.zeros(8), np.zeros((2, 2)), 0.0
    for a, b in zip(at, at[1:]):
        n = b - a
        paths = [[(k >> i) & 1 for i in range(n)] for k in range(1 << n)]
        weights = [
            np.exp(score[a:b] @ np.array(p) + sum(tie[x, y] for x, y in zip(p, p[1:]))) for p in paths
        ]
        all_z += np.log(sum(weights))
        for p, w in zip(paths, np.array(weights) / sum(weights)):
            all_good[a:b] += w * np.array(p)
            for x, y in zip(p, p[1:]):
                all_pairs[x, y] += w
    assert np.allclose(good, all_good) and np.allclose(expected, all_pairs)
    assert np.isclose(partition, all_z)


def line_by_line(score, tie):
    """Marginals of one document, a line after the other."""
    emit = np.column_stack([np.zeros(len(score)), score])
    forward, backward = emit.copy(), np.zeros_like(emit)
    for t in range(1, len(score)):
        forward[t] += np.logaddexp(forward[t - 1, 0] + tie[0], forward[t - 1, 1] + tie[1])
    for t in range(len(score) - 2, -1, -1):
        later = emit[t + 1] + backward[t + 1]
        backward[t] = np.logaddexp(tie[:, 0] + later[0], tie[:, 1] + later[1])
    z = np.logaddexp(*forward[-1])
    pairs = sum(
        np.exp(forward[t][:, None] + tie + emit[t + 1] + backward[t + 1] - z) for t in range(len(score) - 1)
    )
    return np.exp(forward[:, 1] + backward[:, 1] - z), pairs + np.zeros((2, 2)), z


def test_marginals_of_many_runs(monkeypatch):
    """Documents around one, two and many runs beside each other."""
    rng = np.random.default_rng(2)
    lengths = [1, 7, 8, 9, 16, 17, 100, 3, 8]
    at = np.concatenate([[0], np.cumsum(lengths)])
    score, tie = 3 * rng.normal(size=at[-1]), rng.normal(size=(2, 2))
    monkeypatch.setattr(quality, "RUN_LINES", 8)
    good, expected, partition = quality.marginals(score, at, tie)
    own = [line_by_line(score[a:b], tie) for a, b in zip(at, at[1:])]
    assert np.allclose(good, np.concatenate([o[0] for o in own]))
    assert np.allclose(expected, sum(o[1] for o in own))
    assert np.isclose(partition, sum(o[2] for o in own))
    none = quality.marginals(np.zeros(0), np.zeros(1, np.int64), tie)
    assert len(none[0]) == 0 and none[2] == 0


def test_a_document_of_many_lines_takes_few_steps():
    """A labelled document of 100,000 lines: a pass of the training is a fraction of a second."""
    rng = np.random.default_rng(3)
    n = 100_000
    score, tie = rng.normal(size=n), np.array([[0.5, -0.5], [-0.5, 0.5]])
    begin = time.monotonic()
    good, expected, _ = quality.marginals(score, np.array([0, n]), tie)
    assert time.monotonic() - begin < 1
    assert np.allclose(good, line_by_line(score, tie)[0]) and np.isclose(expected.sum(), n - 1)


def test_lines_are_those_of_the_texts():
    texts = [None, "", "one\n\ntwo words\n", "x", "a b\na b", "é ü"]
    x, size, at = features(texts)
    lines = [(t or "").split("\n") for t in texts]
    assert np.diff(at).tolist() == [len(own) for own in lines]
    flat = [line for own in lines for line in own]
    assert size.tolist() == [len(line.encode()) for line in flat]
    assert np.allclose(np.expm1(x[:, 1] * 4), [len(line.split()) for line in flat])
    assert x[at[4] : at[5], 13].tolist() == [0, 1]


def test_features_do_not_depend_on_the_batch():
    texts = [t for _, t, *_ in AWKWARD]
    x, size, at = features(texts)
    for k, text in enumerate(texts):
        own, bytes_, _ = features([text])
        assert np.allclose(own, x[at[k] : at[k + 1]]) and (bytes_ == size[at[k] : at[k + 1]]).all()


def test_held_out_accuracy(spark):
    scored = queries.op10_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.join(labels, "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    unseen = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.quality for r in unseen)
    assert len(unseen) > 80 and right >= 0.95 * len(unseen)


def test_awkward_rows(spark):
    docs = awkward(spark, score="x", quality=1, held_out=0)
    labels = spark.createDataFrame(
        [(11, 1, 0), (11, 1, 0), (14, 1, None), (9, 0, 1), (7, 0, 1), (5, None, 1), (13, 0, 1), (13, 1, 1), (None, 0, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    found = quality.score_documents(docs, labels).collect()
    assert len(found) == len(AWKWARD)
    for r in found:
        text = next(t for d, t, *_ in AWKWARD if d == r.doc_id)
        assert (r.score == 0) == (not (text or "").strip()) and 0 <= r.score <= 1
    assert not next(r for r in found if r.doc_id is None).held_out


def test_scores_depend_on_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    field = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    a = {r.doc_id: r.score for r in quality.add_scores(docs, field).collect()}
    other = docs.selectExpr("doc_id", "text", "'zz' as lang", "'q' as source").repartition(3)
    assert {r.doc_id: r.score for r in quality.add_scores(other, field).collect()} == a


def test_nothing_to_learn(spark):
    labels = spark.createDataFrame([(11, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality.score_documents(awkward(spark), labels).collect()
    assert {r.score for r in found} == {0.0, 0.5}
    assert quality.score_documents(empty(spark), labels.limit(0)).collect() == []


def long_documents(spark, n=40):
    """Every document begins with 80 good lines; the bad ones go on with junk."""
    good = "The river was high that spring, and the ferry waited for the morning mail."
    junk = "BUY NOW!!! $$$ ### 1234 5678 <<>> {{}} || == CLICK"
    texts = [
        "\n".join([f"{good} {k} {d}" for k in range(80)] + [good if d % 2 else junk] * 120) for d in range(n)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as quality", "0 as toxic")
    return docs, labels


def test_lines_far_down_are_learnt(spark):
    docs, labels = long_documents(spark)
    field = quality.train(docs, labels.filter("doc_id < 20"))
    found = quality.add_scores(docs.filter("doc_id >= 20"), field).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in found)


def test_gradients_of_tasks_equal_those_of_the_driver(spark, monkeypatch):
    docs, labels = long_documents(spark, 12)
    alone = quality.train(docs, labels)
    monkeypatch.setattr(quality, "DRIVER_LINES", 0)
    summed = quality.train(docs.repartition(3), labels)
    assert np.allclose(alone.weight, summed.weight, atol=1e-6)
    assert np.allclose(alone.tie, summed.tie, atol=1e-6)
    assert np.allclose([alone.slope, alone.shift], [summed.slope, summed.shift], atol=1e-6)


def test_a_labelled_document_of_100_000_lines(spark):
    docs, labels = long_documents(spark)
    line = "The river was high that spring, and the ferry waited for the morning mail."
    long = spark.createDataFrame([(100, "\n".join([line] * 100_000))], "doc_id long, text string")
    marked = spark.createDataFrame([(100, 1, 0)], "doc_id long, quality int, toxic int")
    begin = time.monotonic()
    field = quality.train(docs.union(long), labels.filter("doc_id < 20").union(marked))
    assert time.monotonic() - begin < 90
    found = quality.add_scores(docs.filter("doc_id >= 20"), field).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in found)
