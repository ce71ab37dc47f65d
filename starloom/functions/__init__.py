from starloom.functions.columns import (
    calendar_parts,
    epoch_micros,
    epoch_to_timestamp,
    null_if_sentinel,
    safe_cast,
    truncate_decimal,
)
from starloom.functions.ordering import null_safe_match, sort_columns

__all__ = [
    "calendar_parts",
    "epoch_micros",
    "epoch_to_timestamp",
    "null_if_sentinel",
    "null_safe_match",
    "safe_cast",
    "sort_columns",
    "truncate_decimal",
]
