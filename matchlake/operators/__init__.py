"""DataFrame -> DataFrame operators (nested, relational, contract, checks)."""

from .checks import Check, check_not_null, check_report, check_unique, read_checks
from .contract import cast_first_n, check_castable, contract_types, enforce, read_contract, warehouse_schema
from .nested import (explode_child, explode_positional, flatten_shallow,
                     flatten_struct, vertical_split)
from .relational import (cond_count_distinct, count_distinct, dedupe, first_per_group, flag_first,
                         full_group_flag, is_false, is_true, only_new, roster_filter, sort_cols,
                         star_except, top1_rows, union_all, union_by_name)

__all__ = [
    "Check", "check_not_null", "check_report", "check_unique", "read_checks",
    "cast_first_n", "check_castable", "contract_types", "enforce", "read_contract", "warehouse_schema",
    "explode_child", "explode_positional", "flatten_shallow", "flatten_struct",
    "vertical_split",
    "cond_count_distinct", "count_distinct", "dedupe", "first_per_group", "flag_first",
    "full_group_flag", "is_false", "is_true", "only_new", "roster_filter", "sort_cols",
    "star_except", "top1_rows", "union_all", "union_by_name",
]
