import gzip
import hashlib
from pathlib import Path

import pytest

from cases import rows
from compare import connect, duck_rows, spark_rows
from starloom.llm import queries, warc

SF = "/root/testdata/sf0.001"
PAGE = "page_id long, url string, html string"
LONG = "<p>" + "ä\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9

PAGES = [
    (4, "http://a.example/x y", LONG),
    (2, "https://b.example", LONG),
    (2, "https://b.example", LONG),
    (None, "no url\r\nInjected: yes", LONG),
    (9, None, None),
    (8, "", ""),
    (7, "http://c.example/", "short"),
    (6, "http://c.example/", "short"),
    (5, "http://c.example/?q=1", "€" * 40),
    (3, "http://c.example/?q=1", "€" * 40),
    (10, "u", "x" * 300_000),
]


def brute(pages):
    first = {}
    for page, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, _, html in pages:
        data = (html or "").encode()
        rep = first.get(data)
        again = rep is not None and page != rep
        kind, to = ("revisit", rep) if again else ("response", None)
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, to, True, True))
    return sorted(out, key=repr)


def test_whole_table_equals_sql(spark):
    df = queries.op7_warc(spark, SF)
    assert spark_rows(df) == duck_rows(connect(SF), queries.SQL["op7_warc"])


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_awkward_rows(spark, tmp_path, compression):
    pages = spark.createDataFrame([(*p, 1, "x") for p in PAGES], f"{PAGE}, digest int, payload string")
    path = str(tmp_path / "warc")
    warc.write_captures(pages, path, compression=compression, captures_per_file=2)
    assert all(f.name.endswith(".gz") == (compression == "gzip") for f in Path(path).glob("part-*"))
    records = warc.read_warc(spark, path)
    assert rows(warc.resolve(warc.assemble(warc.read_warc(spark, path, payloads=False)))) == brute(PAGES)
    revisits = records.filter("type = 'revisit'").collect()
    assert {r.headers["warc-refers-to-target-uri"] for r in revisits} == {"https://b.example", "http://c.example/?q=1"}
    assert all(r.headers["warc-refers-to-date"] == r.headers["warc-date"] for r in revisits)
    assert rows(warc.resolve(warc.assemble(records))) == brute(PAGES)
    nested = warc.assemble(records).filter("answer.type = 'response'").collect()
    stored = {r.answer.headers.get("warc-page-id"): bytes(r.answer.payload) for r in nested}
    assert stored["2"] == LONG.encode() and stored["10"] == b"x" * 300_000
    asked = {r.answer.headers.get("warc-target-uri"): r.request.http for r in nested}
    assert asked["http://c.example/"].startswith("GET / HTTP/1.1\r\nHost: c.example")
    assert all("injected" not in r.answer.headers for r in nested)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_captures(spark.createDataFrame([], PAGE), path)
    assert warc.resolve(warc.assemble(warc.read_warc(spark, path))).collect() == []


def test_parts_without_a_response(spark):
    records = spark.createDataFrame(
        [
            ("f", 0, "request", "<r>", ["<gone>"], {}, "", None, 0, ""),
            ("f", 9, "response", "<a>", [], {}, "", None, 0, ""),
            ("f", 20, "metadata", "<m2>", ["<a>", "<b>"], {}, "", None, 0, ""),
            ("f", 12, "metadata", "<m1>", ["<a>"], {}, "", None, 0, ""),
            ("f", 30, "revisit", "<b>", [], {}, "", None, 0, ""),
        ],
        warc.SCHEMA,
    )
    found = {r.record_id: r for r in warc.assemble(records).collect()}
    assert set(found) == {"<a>", "<b>"} and found["<a>"].request is None
    assert found["<a>"].metadata.record_id == "<m1>" and found["<b>"].metadata.record_id == "<m2>"


def test_a_member_a_record_is_read(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    (tmp_path / "many.warc.gz").write_bytes(gzip.compress(record) * 3)
    assert warc.read_warc(spark, str(tmp_path)).count() == 3


def test_broken_archives_are_refused():
    whole = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [r["payload"] for r in warc.parse(whole * 2)] == [b"abcd"] * 2
    for broken in (whole[:-6], whole + b"junk"):
        with pytest.raises(ValueError):
            list(warc.parse(broken))
