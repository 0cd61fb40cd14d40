"""Deleting rows by predicate."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession

from strata.operators.replace import (
    Rewrite,
    current,
    in_partitions,
    replace_table,
    touched_partitions,
)
from strata.site import Site


def delete_where(
    spark: SparkSession,
    site: Site,
    schema: str,
    table: str,
    predicate: str,
    args: dict[str, Any] | None = None,
) -> None:
    """Drop the rows for which ``predicate`` is TRUE; rows where it is NULL stay.

    ``args`` are values for the named parameters (``:name``) of the predicate. Of a partitioned
    table, only the partitions that lose rows are written anew; one that loses all is dropped.
    """
    name = site.table(schema, table)
    before = current(spark, site, schema, table)
    if before and before.in_place:
        spark.sql(f"DELETE FROM {name} WHERE {predicate}", args=args)
        return
    kept = f"SELECT * FROM {name} WHERE NOT coalesce(({predicate}), false)"
    if before and before.partitions:
        listed = ", ".join(f"`{c}`" for c in before.partitions)
        hit = spark.sql(f"SELECT {listed} FROM {name} WHERE {predicate}", args=args)
        touched = touched_partitions(hit, before.partitions)
        if touched:
            write = Rewrite(spark, site, schema, table, before)
            try:
                write.add(in_partitions(spark.sql(kept, args=args), before.partitions, touched))
                write.replace_partitions(touched)
            except Exception:
                write.discard()
                raise
        return
    # A pruned scan that stops at the first hit saves the rewrite when there is none.
    if spark.sql(f"SELECT 1 FROM {name} WHERE {predicate}", args=args).isEmpty():
        return
    replace_table(spark.sql(kept, args=args), site, schema, table, keep_layout=True, before=before)
