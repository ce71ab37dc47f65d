import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import AWKWARD, awkward, empty, rows
from starloom.llm import tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def expected(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_whole_table_equals_the_tokenizer(spark, tokenizer):
    docs = spark.read.parquet(SF)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in tokens.count_tokens(docs.select("doc_id", "text"), FILE).collect():
        assert r.n_tokens == expected(tokenizer, texts[r.doc_id])
        assert r.n_bytes == len(texts[r.doc_id].encode())


def test_awkward_rows(spark, tokenizer):
    found = tokens.count_tokens(awkward(spark, n_tokens=1, known="x", _row=1, _f=2, _more=3), FILE)
    assert "known" in found.columns and found.columns.count("n_tokens") == 1
    wanted = sorted(
        ((i, len((t or "").encode()), expected(tokenizer, t)) for i, t, *_ in AWKWARD), key=repr
    )
    assert rows(found.select("doc_id", "n_bytes", "n_tokens")) == wanted


def test_unlisted_pre_tokens_are_joined(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "LISTED", 3)
    docs = spark.read.parquet(SF).limit(40)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in tokens.count_tokens(docs.select("doc_id", "text"), FILE).collect():
        assert r.n_tokens == expected(tokenizer, texts[r.doc_id])


def test_empty_table(spark):
    assert tokens.count_tokens(empty(spark).select("doc_id", "text"), FILE).collect() == []


def test_pattern_agrees_where_it_is_used(tokenizer):
    """Every code point of the fast path is cut as the library cuts it."""
    cutter = tokens.PreTokens.of(FILE)
    checked = 0
    for point in range(0x10000):
        if 0xD800 <= point < 0xE000 or cutter.odd(chr(point)):
            continue
        text = f"a{chr(point)}b {chr(point)} 1{chr(point)}.  {chr(point)}"
        assert [text[a:b] for _, (a, b) in cutter.cut(text)] == cutter.fast(text), hex(point)
        checked += 1
    assert checked > 30_000
