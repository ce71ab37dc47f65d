"""Typed JSON scans.

Each field is read as text in one parse and cast afterwards, so quoted numbers
load, blanks become NULL and decimals are cut rather than rounded. Only the
mapped fields are in the read schema; Spark skips every other key.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starloom.functions.columns import safe_cast
from starloom.sinks.scratch import pin

# (path in the document, column name, type)
Mapping = Sequence[tuple[str, str, T.DataType | str]]

REJECT_COLUMN = "_corrupt_record"
_STEP = re.compile(r"""\['([^']+)'\]|\["([^"]+)"\]|\.([^.\[\]]+)|\[([0-9]+)\]""")
# Stands for the elements of an array among the keys of an object.
_ELEMENT = object()


def _steps(path: str) -> list[str | int]:
    """Object keys and array positions along ``$.a.b``, ``$['a']['b']`` or ``$['a'][0]``; a bare
    name is one key."""
    if not path.startswith("$"):
        return [path]
    found = list(_STEP.finditer(path))
    if not found or _STEP.sub("", path) != "$":
        raise ValueError(f"unsupported path: {path}")
    steps = [int(m[4]) if m[4] else m[1] or m[2] or m[3] for m in found]
    if isinstance(steps[0], int):
        raise ValueError(f"a document is an object: {path}")
    return steps


def path_mapping(paths: Sequence[str], schema: T.StructType) -> list[tuple[str, str, T.DataType]]:
    """Pair paths with the columns of ``schema`` by position."""
    if len(paths) != len(schema.fields):
        raise ValueError(f"{len(paths)} paths for {len(schema.fields)} columns")
    return [(path, f.name, f.dataType) for path, f in zip(paths, schema.fields)]


def read_path_mapping(spark: SparkSession, path: str, schema: T.StructType):
    """Mapping from a ``{"jsonpaths": [...]}`` file."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return path_mapping(json.loads(text)["jsonpaths"], schema)


def _text_schema(mapping: Mapping) -> T.StructType:
    """The mapped values as texts, in the objects and arrays that lead to them."""
    tree: dict = {}
    for path, _, _ in mapping:
        *parents, leaf = [_ELEMENT if isinstance(step, int) else step for step in _steps(path)]
        node = tree
        for key in parents:
            node = node.setdefault(key, {})
            if node is None:
                raise ValueError(f"path {path} goes through a value that another path reads")
        if node.setdefault(leaf, None) is not None:
            raise ValueError(f"path {path} reads an object that other paths go through")

    def build(node: dict | None) -> T.DataType:
        if node is None:
            return T.StringType()
        if _ELEMENT not in node:
            return T.StructType([T.StructField(key, build(child)) for key, child in node.items()])
        if len(node) > 1:
            raise ValueError("paths take the same value for an array and for an object")
        return T.ArrayType(build(node[_ELEMENT]))

    return build(tree)


def _source(path: str, root: str | None = None) -> Column:
    """The text at a path of a parsed document; NULL where an array is too short."""
    first, *others = ([root] if root else []) + _steps(path)
    column = F.col(f"`{first}`")
    for step in others:
        column = F.get(column, F.lit(step)) if isinstance(step, int) else column.getField(step)
    return column


def _typed(mapping: Mapping, strict: bool, decimal_scale: int, root: str | None = None) -> list[Column]:
    return [
        safe_cast(_source(path, root), T.StringType(), target, decimal_scale, strict).alias(name)
        for path, name, target in mapping
    ]


def _auto_mapping(schema: T.StructType) -> list[tuple[str, str, T.DataType]]:
    return [(f.name, f.name, f.dataType) for f in schema.fields]


def _reader(spark: SparkSession, mode: str, recursive: bool, multi_line: bool):
    return (
        spark.read.option("mode", mode)
        .option("recursiveFileLookup", recursive)
        .option("multiLine", multi_line)
    )


def read_json_mapped(
    spark: SparkSession,
    path: str,
    mapping: Mapping,
    mode: str = "FAILFAST",
    decimal_scale: int = 0,
    recursive: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Scan every JSON file under ``path``, one column per mapped document path.

    ``FAILFAST`` (default) fails the load on a broken line or on text that does
    not fit its column; ``PERMISSIVE`` gives NULL and ``DROPMALFORMED`` drops
    broken lines.
    """
    reader = _reader(spark, mode, recursive, multi_line).schema(_text_schema(mapping))
    return reader.json(path).select(_typed(mapping, mode == "FAILFAST", decimal_scale))


def read_json_auto(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    mode: str = "FAILFAST",
    decimal_scale: int = 0,
    recursive: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Scan JSON whose keys are the column names (case matters)."""
    return read_json_mapped(
        spark, path, _auto_mapping(schema), mode, decimal_scale, recursive, multi_line
    )


def _problems(
    mapping: Mapping, typed: Sequence[Column], lengths: dict[str, int], root: str
) -> Column:
    """The columns of a row whose text is no value of their type, or is longer than allowed."""
    found = []
    for (path, name, target), value in zip(mapping, typed):
        text = _source(path, root)
        kind = target if isinstance(target, str) else target.simpleString()
        if kind != "string":
            wrong, what = (F.trim(text) != "") & value.isNull(), f"does not fit {kind}"
        elif name in lengths:
            wrong, what = F.length(value) > lengths[name], f"longer than {lengths[name]}"
        else:
            continue
        problem = [F.lit(name).alias("column"), text.alias("value"), F.lit(what).alias("problem")]
        found.append(F.when(wrong, F.struct(*problem)))
    none = F.array().cast("array<struct<column: string, value: string, problem: string>>")
    return F.filter(F.array(*found), lambda p: p.isNotNull()) if found else none


def read_with_rejects(
    spark: SparkSession,
    path: str,
    mapping: Mapping,
    decimal_scale: int = 0,
    recursive: bool = True,
    lengths: dict[str, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Tolerant load of JSON lines: (typed good rows, rejected lines).

    A line is rejected if it is broken, if a value is no value of its column's type, or if a
    text is longer than ``lengths`` allows its column. Rejects have ``file``, ``line`` and
    ``problems``, a list of column, value and problem; a broken line has an empty list. Blank
    text is NULL and no problem.

    The text is parsed once: typed rows and rejects are stored together in the scratch folder,
    and both results read from there.
    """
    schema = _text_schema(mapping).add(REJECT_COLUMN, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT_COLUMN}
    # Parsed from text lines: a JSON scan may not be asked for its broken lines alone.
    lines = (
        spark.read.option("recursiveFileLookup", recursive)
        .text(path)
        .filter(F.trim("value") != "")
        .select(
            F.input_file_name().alias("_file"),
            F.col("value").alias("_line"),
            F.from_json("value", schema, options).alias("_doc"),
        )
    )
    # Columns may have any name, so the row travels as one struct.
    typed = _typed(mapping, False, decimal_scale, root="_doc")
    read = lines.select(
        "_file",
        "_line",
        F.col(f"_doc.{REJECT_COLUMN}").isNotNull().alias("_broken"),
        _problems(mapping, typed, lengths or {}, "_doc").alias("_problems"),
        F.struct(*typed).alias("_row"),
    )
    rejected = F.col("_broken") | (F.size("_problems") > 0)
    kept = [F.when(rejected, F.col(c)).alias(c) for c in ("_file", "_line")]
    stored = pin(read.select(*kept, F.when(rejected, F.col("_problems")).alias("_problems"), "_row"), "parsed")
    good = stored.filter("_line IS NULL").select("_row.*")
    rejects = stored.filter("_line IS NOT NULL").select(
        F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_problems").alias("problems")
    )
    return good, rejects


def parse_json_mapped(
    df: DataFrame,
    column: str,
    mapping: Mapping,
    keep: Sequence[str] = (),
    mode: str = "FAILFAST",
    decimal_scale: int = 0,
) -> DataFrame:
    """The mapped scan over JSON text already held in a column."""
    parsed = F.from_json(F.col(column), _text_schema(mapping), {"mode": mode})
    return df.select(*keep, parsed.alias("_doc")).select(
        *keep, *_typed(mapping, mode == "FAILFAST", decimal_scale, root="_doc")
    )


def parse_json_auto(
    df: DataFrame,
    column: str,
    schema: T.StructType,
    keep: Sequence[str] = (),
    mode: str = "FAILFAST",
    decimal_scale: int = 0,
) -> DataFrame:
    return parse_json_mapped(df, column, _auto_mapping(schema), keep, mode, decimal_scale)


def cast_safe(
    df: DataFrame,
    types: dict[str, T.DataType | str],
    decimal_scale: int = 0,
    strict: bool = False,
) -> DataFrame:
    """Cast the named columns, see :func:`starloom.functions.columns.safe_cast`."""
    return df.withColumns(
        {
            name: safe_cast(name, df.schema[name].dataType, target, decimal_scale, strict)
            for name, target in types.items()
        }
    )
