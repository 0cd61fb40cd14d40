"""Config-driven medallion loads on Spark."""

from strata.operators import (
    MergeConflict,
    append,
    conflicting_keys,
    delete_where,
    merge,
    replace_table,
    write_table,
)
from strata.plans.cleanup import cleanup_group, delete_config, drop_targets
from strata.plans.runner import LayerFailed, LoadResult, run_group
from strata.plans.views import publish
from strata.site import Site, pick_catalog
from strata.sources import read_source

__all__ = [
    "LayerFailed",
    "LoadResult",
    "MergeConflict",
    "Site",
    "append",
    "cleanup_group",
    "conflicting_keys",
    "delete_config",
    "delete_where",
    "drop_targets",
    "merge",
    "pick_catalog",
    "publish",
    "read_source",
    "replace_table",
    "run_group",
    "write_table",
]
