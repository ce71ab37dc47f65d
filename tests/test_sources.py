import json
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from golden import write_golden
from starloom.plans import schemas
from starloom.sources import (
    path_mapping,
    read_json_auto,
    read_json_mapped,
    read_path_mapping,
    read_with_rejects,
)

MAPPING = [("$['user']['id']", "user_id", "int"), ("$.len", "length", "decimal"), ("$.note", "note", "string")]


def write_lines(folder, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text("\n".join(lines))
    return str(folder)


def test_mapped_scan_quoted_blank_missing_and_unknown(spark, tmp_path):
    path = write_lines(
        tmp_path / "log",
        json.dumps({"user": {"id": "39"}, "len": 218.93179, "note": "a", "unknown": 1}),
        json.dumps({"user": {"id": ""}, "len": ""}),
        json.dumps({"user": {"id": 7}, "len": "-1.99", "note": "b"}),
    )
    df = read_json_mapped(spark, path, MAPPING)
    assert df.dtypes == [("user_id", "int"), ("length", "decimal(18,0)"), ("note", "string")]
    assert {tuple(r) for r in df.collect()} == {
        (39, Decimal(218), "a"), (None, None, None), (7, Decimal(-1), "b"),
    }


def test_auto_scan_matches_keys_by_case(spark, tmp_path):
    path = write_lines(tmp_path / "auto", json.dumps({"itemInSession": 1, "year": "0", "title": "x"}))
    schema = T.StructType.fromDDL("iteminSession int, year int, title string")
    assert tuple(read_json_auto(spark, path, schema).first()) == (None, 0, "x")


def test_scan_reads_every_nested_file(spark, tmp_path):
    log, catalogue = write_golden(tmp_path)
    assert read_json_auto(spark, catalogue, schemas.staging_songs()).count() == 10
    mapping = path_mapping([f.name for f in schemas.staging_events()], schemas.staging_events())
    assert read_json_mapped(spark, log, mapping).count() == 8


def test_one_broken_line_fails_the_load_or_is_rejected(spark, tmp_path):
    path = write_lines(tmp_path / "bad", json.dumps({"note": "ok"}), '{"note": broken')
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        read_json_mapped(spark, path, MAPPING).collect()
    good, rejects = read_with_rejects(spark, path, MAPPING)
    assert [r.note for r in good.collect()] == ["ok"]
    (reject,) = rejects.collect()
    assert reject.line == '{"note": broken' and reject.file.endswith("part.json")


def test_values_that_do_not_fit_are_rejected_with_their_column(spark, tmp_path):
    rows = [
        {"user": {"id": "7"}, "len": "1e2", "note": "fine", "when": 5},
        {"user": {"id": "abc"}, "len": "1.5", "note": "ok"},
        {"user": {"id": 1}, "len": "x", "note": "far too long", "when": "never"},
        {"user": {"id": " "}, "len": "", "note": None},
        {"user": "no object", "len": 3, "note": "ok"},
        {"user": {"id": 99999999999}, "len": 1},
    ]
    path = write_lines(tmp_path / "values", *[json.dumps(r) for r in rows], '{"note": broken', "  ")
    mapping = [*MAPPING, ("$.when", "file", "bigint")]  # a column with the name of a reject's
    good, rejects = read_with_rejects(spark, path, mapping, lengths={"note": 5})
    assert good.columns == ["user_id", "length", "note", "file"]
    assert {tuple(r) for r in good.collect()} == {(7, Decimal(100), "fine", 5), (None, None, None, None)}
    found = {r.line: [tuple(p) for p in r.problems] for r in rejects.collect()}
    assert found[json.dumps(rows[1])] == [("user_id", "abc", "does not fit int")]
    assert found[json.dumps(rows[2])] == [
        ("length", "x", "does not fit decimal"),
        ("note", "far too long", "longer than 5"),
        ("file", "never", "does not fit bigint"),
    ]
    assert found[json.dumps(rows[5])] == [("user_id", "99999999999", "does not fit int")]
    assert found['{"note": broken'] == []
    # An object asked for where the document has none is a broken line.
    assert len(found) == 5 and all(r.file.endswith("part.json") for r in rejects.collect())


def test_unreadable_number_fails_the_strict_load_only(spark, tmp_path):
    path = write_lines(tmp_path / "text", json.dumps({"user": {"id": "abc"}}))
    with pytest.raises(PySparkException, match="does not fit int"):
        read_json_mapped(spark, path, MAPPING).collect()
    assert read_json_mapped(spark, path, MAPPING, mode="PERMISSIVE").first().user_id is None


def test_path_file_pairs_paths_with_columns_by_position(spark, tmp_path):
    file = tmp_path / "paths.json"
    file.write_text(json.dumps({"jsonpaths": ["$['a']", "$.b.c"]}, indent=1))
    schema = T.StructType.fromDDL("x int, y string")
    mapping = read_path_mapping(spark, str(file), schema)
    path = write_lines(tmp_path / "docs", json.dumps({"a": 1, "b": {"c": "deep"}}))
    assert tuple(read_json_mapped(spark, path, mapping).first()) == (1, "deep")
    with pytest.raises(ValueError):
        path_mapping(["$.a"], schema)
    for broken in ("$[0]", "$.a[", "$.a[-1]", "$.a[x]", "$"):
        with pytest.raises(ValueError):
            read_json_mapped(spark, path, [(broken, "x", "int")])


def test_paths_take_elements_of_arrays(spark, tmp_path):
    path = write_lines(
        tmp_path / "arrays",
        json.dumps({"a": [1, "2"], "b": [{"x": 5, "y.z": [["p", "q"]]}, {"x": 6}], "c": {"0": "key"}}),
        json.dumps({"a": [], "b": [{"x": 7}]}),
        json.dumps({"b": None}),
    )
    mapping = [
        ("$['a'][0]", "first", "int"),
        ("$.a[1]", "second", "int"),
        ("$.b[1].x", "x", "int"),
        ("$.b[0]['y.z'][0][1]", "deep", "string"),
        ("$.c['0']", "key", "string"),
    ]
    df = read_json_mapped(spark, path, mapping)
    assert {tuple(r) for r in df.collect()} == {(1, 2, 6, "q", "key"), (None,) * 5}
    assert df.count() == 3
    plan = read_json_mapped(spark, path, mapping[:1])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:array<string>>" in plan
    good, rejects = read_with_rejects(spark, path, [("$.b[0].x", "x", "int"), ("$.a[1]", "a", "int")])
    assert {tuple(r) for r in good.collect()} == {(5, 2), (7, None), (None, None)} and rejects.isEmpty()
    for paths in (("$.a[0]", "$.a.b"), ("$.a", "$.a[0]"), ("$.a[0].b", "$.a[1]")):
        with pytest.raises(ValueError):
            read_json_mapped(spark, path, [(p, f"c{k}", "int") for k, p in enumerate(paths)])


def test_only_mapped_fields_are_read(spark, tmp_path):
    log, _ = write_golden(tmp_path)
    df = read_json_mapped(spark, log, [("$.ts", "ts", "bigint")])
    assert "ReadSchema: struct<ts:string>" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("paths", [("$.a", "$.a.b"), ("$.a.b", "$['a']"), ("$.a.b", "$.a.b.c")])
def test_overlapping_paths_are_refused(spark, tmp_path, paths):
    (tmp_path / "x.json").write_text('{"a": {"b": 1}}')
    mapping = [(path, f"c{k}", "string") for k, path in enumerate(paths)]
    with pytest.raises(ValueError, match="path"):
        read_json_mapped(spark, str(tmp_path), mapping)
