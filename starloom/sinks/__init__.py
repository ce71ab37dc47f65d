from starloom.sinks.publish import (
    Work,
    clean_old,
    create_empty,
    create_tables,
    finish_pending,
    publish,
    publish_all,
    truncate_table,
    undo_pending,
)
from starloom.sinks.scratch import pin, remove_folder, scratch_path, scratch_root, scratch_run

__all__ = [
    "Work",
    "clean_old",
    "create_empty",
    "create_tables",
    "finish_pending",
    "pin",
    "publish",
    "publish_all",
    "remove_folder",
    "scratch_path",
    "scratch_root",
    "scratch_run",
    "truncate_table",
    "undo_pending",
]
