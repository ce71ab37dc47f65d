"""Each stage against a plain version of it, on the rows that the stage before kept."""

from collections import Counter
from itertools import groupby

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline as pipeline
import test_decontam
import test_near_dedup
from cases import awkward
from starloom.llm import mixing, queries, quality, training_order
from starloom.llm.arrays import utf8

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The small tables with the awkward rows added to the documents."""
    folder = tmp_path_factory.mktemp("tables")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = awkward(spark).withColumn("doc_id", F.col("doc_id") + 100_000)
    docs.union(more.select(docs.columns)).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def stages(spark, tables, tmp_path_factory):
    """The rows before the first stage and after each."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    found = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, tables).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        found.append(docs)
    return found


def rows(df):
    return [tuple(r) for r in df.select(COLUMNS).collect()]


def test_the_stages_in_their_order(spark):
    assert len(pipeline.STAGES) == 5
    assert spark_entry.queries()["pipeline"].__name__ == "run"
    assert "pipeline" not in spark_entry.oracle_sql() and pipeline.ORACLE_SQL is None


def test_quality(spark, tables, stages):
    labels = spark.read.parquet(f"{tables}/labels.parquet").filter(~quality.held_out())
    field = quality.train(stages[0], labels)
    expected = Counter()
    for row in rows(stages[0]):
        score = field.quality(*quality.line_features(*utf8(pa.array([row[1]], pa.string()))))
        if score[0] >= 0.5:
            expected[row] += 1
    assert Counter(rows(stages[1])) == expected
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    good = {d for d, q in known.items() if q == 1} & {r[0] for r in rows(stages[0])}
    assert len(good - {r[0] for r in rows(stages[1])}) <= 0.02 * len(good)


def test_near_duplicates(stages):
    docs = sorted(set(rows(stages[1])), key=repr)
    kept = {(d, n) for d, n, _, k in test_near_dedup.brute([r[:2] for r in docs]) if k}
    ids = {d for d, _ in kept}
    assert Counter(rows(stages[2])) == Counter(r for r in docs if r[0] is None or r[0] in ids)


def test_decontamination(spark, tables, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    docs = rows(stages[2])
    clean = Counter(r[0] for r in test_decontam.brute([d[:2] for d in docs], items) if not r[-1])
    assert Counter(r[0] for r in rows(stages[3])) == clean
    assert not Counter(rows(stages[3])) - Counter(docs)


def test_mixture(stages):
    before, after = Counter(rows(stages[3])), Counter(rows(stages[4]))
    assert set(before) == set(after) and not before - after


def test_training_shards(stages):
    docs = rows(stages[4])
    own = training_order.encoding(queries.tokenizer_file("byte_bpe_50k.tiktoken"))
    total = sum(len(own.encode_ordinary(r[1] or "")) + 1 for r in docs)
    found = stages[5].collect()
    assert sum(r.n_tokens for r in found) == total
    assert sorted(r.slot for r in found) == list(range(-(-total // training_order.SEQUENCE)))
    assert {d for r in found for d in r.doc_ids} == {r[0] for r in docs}


def test_run_is_the_stages(spark, tables, stages):
    whole = spark_entry.queries()["pipeline"](spark, tables)
    assert whole.columns == stages[5].columns
    assert sum(r.n_tokens for r in whole.collect()) == sum(r.n_tokens for r in stages[5].collect())


def test_empty_documents_and_further_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = ["_score", "_kept", "_copy", "_hits", "mix_slot", "_mix_slot", "score", "component_id"]
    further = docs.limit(30).withColumns({name: F.lit(name) for name in names})
    for k, (_, stage) in enumerate(pipeline.STAGES):
        assert stage(spark, docs.limit(0), tables).count() == 0
        if k < 4:
            found = stage(spark, further, tables)
            assert found.columns[:5] == COLUMNS and found.count() > 0
            assert found.columns == further.columns
            assert set(found.select(names).distinct().first()) == set(names)


def test_tokens_follow_the_order_of_the_mixture(spark, tables, tmp_path):
    """The mixture in several files of unequal sizes, the later ones the larger."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").filter("doc_id IS NOT NULL")
    mixed = pipeline.source_mixture(spark, docs, tables).collect()
    expected = [r.doc_id for r in mixing.mix(docs).orderBy("mix_slot", "mix_offset").collect()]
    assert [r.doc_id for r in mixed] == expected
    ends = [0, 5, 30, 100, 300, len(mixed)]
    for k, (a, b) in enumerate(zip(ends, ends[1:])):
        fields = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
        part = pa.Table.from_pylist([{"doc_id": r.doc_id, "text": r.text} for r in mixed[a:b]], fields)
        (tmp_path / "mixed").mkdir(exist_ok=True)
        pq.write_table(part, tmp_path / "mixed" / f"part-{k:05d}.parquet")
    ranks = queries.tokenizer_file("byte_bpe_50k.tiktoken")
    stored = spark.read.parquet(str(tmp_path / "mixed"))
    _, index = training_order.write_training_order(stored, str(tmp_path / "shards"), ranks, queries.END)
    found = [d for r in sorted(index.collect(), key=lambda r: r.sequence) for d in r.doc_ids]
    # A document in several sequences is listed by each.
    assert [d for d, _ in groupby(found)] == [d for d, _ in groupby(expected)]
