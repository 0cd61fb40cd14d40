from strata.operators.append import append
from strata.operators.delete import delete_where
from strata.operators.merge import MergeConflict, conflicting_keys, merge
from strata.operators.replace import replace_table
from strata.operators.write import write_table

__all__ = [
    "MergeConflict",
    "append",
    "conflicting_keys",
    "delete_where",
    "merge",
    "replace_table",
    "write_table",
]
