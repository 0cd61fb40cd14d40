"""Writing a frame to its target by load type."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from strata.functions import parse_keys
from strata.operators.append import append
from strata.operators.counts import remember
from strata.operators.merge import merge
from strata.operators.replace import replace_table
from strata.site import Site

log = logging.getLogger(__name__)


def write_table(
    df: DataFrame,
    schema: str,
    table: str,
    load_type: str | None = "FULL",
    merge_keys: str | None = "",
    site: Site = Site(),
) -> int:
    """Load ``df`` into its target and return the row count of the whole target."""
    spark = df.sparkSession
    site = site.on(spark)
    site.create_schema(spark, schema)
    mode = (load_type or "").strip().upper() or "FULL"
    keys = parse_keys(merge_keys)
    if mode in ("INCREMENTAL", "APPEND"):
        rows = append(df, site, schema, table)
    elif mode == "MERGE" or (mode == "DELTA" and keys):
        rows = merge(df, site, schema, table, keys)
    else:
        if mode not in ("FULL", "DELTA"):
            log.warning("Unknown LOAD_TYPE '%s' for %s.%s, using FULL", mode, schema, table)
        rows = replace_table(df, site, schema, table)
    return remember(spark, site, schema, table, rows)
