from starloom.operators.dedupe import (
    dedupe_delete_reinsert,
    dedupe_ordered,
    delete_using_anti,
    dup_survivors,
)
from starloom.operators.dims import dim_distinct, dim_time, latest_per_key, max_per_key
from starloom.operators.facts import fact_build, join_natural_key
from starloom.operators.numbering import row_number_per_key, surrogate_key
from starloom.operators.quality import (
    count_per_key,
    dq_max_length,
    dq_not_null,
    dq_unique,
    dup_check_group,
    dup_check_window,
    repeated_keys,
    require_not_null,
    sentinel_probe,
    suspect_keys,
)
from starloom.operators.reports import top_sorted, topk_join_agg

__all__ = [
    "count_per_key",
    "dedupe_delete_reinsert",
    "dedupe_ordered",
    "delete_using_anti",
    "dim_distinct",
    "dim_time",
    "dq_max_length",
    "dq_not_null",
    "dq_unique",
    "dup_check_group",
    "dup_check_window",
    "dup_survivors",
    "fact_build",
    "join_natural_key",
    "latest_per_key",
    "max_per_key",
    "repeated_keys",
    "require_not_null",
    "row_number_per_key",
    "sentinel_probe",
    "surrogate_key",
    "suspect_keys",
    "top_sorted",
    "topk_join_agg",
]
