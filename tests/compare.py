"""Order-insensitive comparison of a Spark result with DuckDB's."""

from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    values = sorted(repr(tuple(row[i] for i in order)) for row in rows)
    return names, values


def spark_rows(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def spark_types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return table(columns, result.fetchall())


DUCK_TO_SPARK = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
}


def duck_types(con, sql):
    found = {}
    for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall():
        found[name] = DUCK_TO_SPARK.get(kind, kind.lower())
    return found
