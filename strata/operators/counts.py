"""Row counts of loads without reading back what was written.

A write counts its rows on the way. What a table holds in all is remembered as a property, with the
bytes of its files; where those are no longer the same, somebody else has written, and the rows
are counted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.tables import ROWS, Layout, layout_of, set_properties
from strata.site import Site


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, to be written as it is, and its rows once that is done.

    Counted in the tasks that write, whose results count once however often they are retried.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get["rows"]


def _bytes(spark: SparkSession, name: str) -> int:
    """Bytes of the table's files, from their listing."""
    return int(spark.table(name)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def known_rows(spark: SparkSession, name: str, layout: Layout) -> int | None:
    """The rows of a table, if that is known without counting them."""
    rows, _, size = layout.marks.get(ROWS, "").partition(" of ")
    if not rows or layout.partitions or int(size) != _bytes(spark, name):
        return None
    return int(rows)


def remember(spark: SparkSession, site: Site, schema: str, table: str, rows: int | None) -> int:
    """The rows of a table after a load, counted if the load doesn't know them."""
    name = site.table(schema, table)
    if rows is None:
        # A scan of no columns: the row counts come from the file footers.
        rows = spark.table(name).count()
    layout = layout_of(spark, site, schema, table)
    if not layout.in_place and not layout.partitions:
        set_properties(spark, name, {ROWS: f"{rows} of {_bytes(spark, name)}"})
    return rows
