import hashlib
import re

from cases import AWKWARD, awkward, empty, rows
from compare import connect, duck_rows, spark_rows
from starloom.llm import decontam, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    patterns = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            patterns.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(p) for p in patterns}:
            for i in range(len(w) - n + 1):
                if (own := patterns.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own - {None}
        names = ",".join(sorted(map(str, found)))
        digest = hashlib.sha256(names.encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "repeated ROW of exactly"),
    (1, "repeated ROW of exactly"),
    (2, None),
    (3, "..."),
    (None, "one"),
    (10, "nobody in the first carriage said a word about the weather, a child counted the bridges"),
    (4, "Текст"),
    (5, "текст 漢字"),
    (6, "12345"),
]


def test_whole_tables_equal_sql(spark):
    df = queries.op2_decontamination(spark, SF)
    assert spark_rows(df) == duck_rows(connect(SF), queries.SQL["op2_decontamination"])


def check(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontam.contamination(docs, items)
    assert rows(found.drop("spans")) == brute([(d, t) for d, t, *_ in AWKWARD], ITEMS)
    return rows(found)


def test_awkward_rows(spark):
    check(spark, awkward(spark, _hits=1, _hits0=1, _own=2, item_id=2, n_words="x"))


def test_many_automata_give_the_same(spark, monkeypatch):
    one = check(spark, awkward(spark))
    assert any(len(r[-1]) > 1 for r in one)
    monkeypatch.setattr(decontam, "AUTOMATON_BYTES", 100)
    assert check(spark, awkward(spark)) == one


def test_spans_of_overlapping_windows_are_one(spark, monkeypatch):
    text = " ".join(f"word{k}" for k in range(15))
    docs = spark.createDataFrame([(1, f"a, {text}; b")], "doc_id long, text string")
    items = spark.createDataFrame([("i", text)], "item_id string, text string")
    for size in (decontam.AUTOMATON_BYTES, 100):
        monkeypatch.setattr(decontam, "AUTOMATON_BYTES", size)
        (row,) = decontam.contamination(docs, items).collect()
        assert (row.n_hit, [tuple(s) for s in row.spans]) == (15, [(3, 3 + len(text))])


def test_item_ids_are_texts(spark):
    items = [("q-7", "repeated ROW of exactly"), ("q-10", "one"), (None, "one"), ("", "текст"), ("q-7", "eight words")]
    table = spark.createDataFrame(items, "item_id string, text string")
    found = decontam.contamination(awkward(spark), table).drop("spans")
    assert rows(found) == brute([(d, t) for d, t, *_ in AWKWARD], items)


def test_a_window_of_very_many_items(spark):
    """Their ids are not broadcast, and not returned by the scan."""
    items = [(k, "repeated row of exactly") for k in range(3000)] + [(9000, "row of exactly eight words in it")]
    table = spark.createDataFrame(items, "item_id long, text string")
    patterns, members = decontam._windows(table, 10)
    assert patterns.count() == 2 and members.count() == 3001
    found = decontam.contamination(awkward(spark), table).drop("spans")
    assert rows(found) == brute([(d, t) for d, t, *_ in AWKWARD], items)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.contamination(empty(spark), items).collect() == []
    clean = decontam.contamination(awkward(spark), items.limit(0)).collect()
    assert len(clean) == len(AWKWARD) and not any(r.contaminated for r in clean)


def test_spans_lie_in_the_original(spark):
    text = "Äh... Nobody—in, the FIRST carriage said a word about THE weather; so"
    found = decontam.Finder([(w, 1) for w in decontam.windows("in the first carriage", 10)])
    hits = found.search(text.replace("—", " "))
    raw = text.replace("—", " ").encode()
    assert [raw[a:b].decode() for a, b in hits.spans] == ["in, the FIRST carriage"]
