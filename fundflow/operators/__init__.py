"""DataFrame operators: NULL-safe joins, numeric roll-ups, key handling."""

from fundflow.operators.aggs import (
    at_latest,
    combine_sums,
    partial_sums,
    latest_period,
    latest_value,
    lenient_sum,
    max_all_numeric,
    nan_to_null,
    numeric_columns,
    round_doubles,
    running_total,
    strict_sum,
    sum_all_numeric,
    zero_fill_numeric,
)
from fundflow.operators.joins import (
    anti_join_ns,
    full_join_ns,
    join_ns,
    left_join_ns,
    semi_join_ns,
    spread_attribute,
)
from fundflow.operators.keys import can_broadcast, in_keys, key_set, keys_df, resolve_key, union_keys
from fundflow.operators.stage import KeySet, measure_keys, shared_dir, stage

__all__ = [
    "KeySet", "can_broadcast", "combine_sums", "keys_df", "measure_keys", "partial_sums",
    "at_latest", "latest_value", "shared_dir", "stage",
    "anti_join_ns", "full_join_ns", "in_keys", "join_ns", "key_set", "latest_period",
    "left_join_ns", "lenient_sum", "max_all_numeric", "nan_to_null", "numeric_columns",
    "resolve_key", "round_doubles", "running_total", "semi_join_ns", "spread_attribute",
    "strict_sum", "sum_all_numeric", "union_keys", "zero_fill_numeric",
]
