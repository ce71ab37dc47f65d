from starloom.sources.catalog import drop_tables, list_tables
from starloom.sources.json_files import (
    cast_safe,
    parse_json_auto,
    parse_json_mapped,
    path_mapping,
    read_json_auto,
    read_json_mapped,
    read_path_mapping,
    read_with_rejects,
)

__all__ = [
    "cast_safe",
    "drop_tables",
    "list_tables",
    "parse_json_auto",
    "parse_json_mapped",
    "path_mapping",
    "read_json_auto",
    "read_json_mapped",
    "read_path_mapping",
    "read_with_rejects",
]
