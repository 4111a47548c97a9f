from finlake.operators.filldown import fill_down, fill_down_exact, with_ordinal, with_row_number
from finlake.operators.frames import (
    cast_by_type,
    drop_if_present,
    move_last,
    ordered_columns,
    rename_columns,
    union_by_name,
)
from finlake.operators.hierarchy import hierarchy_paths, max_depth, widen_levels
from finlake.operators.lookup import MergeError, assert_unique, duplicate_keys, key_stats, lookup_join

__all__ = [
    "MergeError",
    "assert_unique",
    "cast_by_type",
    "drop_if_present",
    "duplicate_keys",
    "fill_down",
    "fill_down_exact",
    "hierarchy_paths",
    "key_stats",
    "lookup_join",
    "max_depth",
    "move_last",
    "ordered_columns",
    "rename_columns",
    "union_by_name",
    "widen_levels",
    "with_ordinal",
    "with_row_number",
]
