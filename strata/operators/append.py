"""Adding rows to a table, widening its schema where the rows bring new columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.columns import aligned, by_lower_name, merged
from strata.operators.counts import counted, known_rows
from strata.operators.replace import current, replace_table, widen
from strata.operators.tables import Layout, type_text
from strata.site import Site, quote


def append(
    df: DataFrame, site: Site, schema: str, table: str, before: Layout | None = None
) -> int | None:
    """INCREMENTAL / APPEND load.

    Columns match by name, and so do fields inside structs. New ones are added to the table (NULL
    in the old rows), missing ones are NULL in the new rows, and a type that would lose values is
    an error. ``before`` is what `current` gave. Returns the rows that the table now has, where
    that is known without counting them.
    """
    spark, name = df.sparkSession, site.table(schema, table)
    before = before or current(spark, site, schema, table)
    if before.in_place if before else site.table_format == "delta":
        writer = df.write.format("delta").mode("append").option("mergeSchema", "true")
        writer.saveAsTable(name)
        return None
    if before is None:
        return replace_table(df, site, schema, table)
    held = known_rows(spark, name, before)
    columns = before.columns
    wider = merged(columns, df.schema)
    # Types are checked before the table is altered.
    aligned(df, wider, fill_missing=True, nested=True)
    known = by_lower_name(columns)
    added = [f for f in wider if f.name.lower() not in known]
    old = [f for f in wider if f.name.lower() in known]
    if any(f.dataType.simpleString() != known[f.name.lower()].dataType.simpleString() for f in old):
        widen(spark, site, schema, table, wider, before)
    elif added:
        listed = ", ".join(f"{quote(f.name)} {type_text(f.dataType)}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
    else:
        wider = columns
    order = wider if wider is columns else spark.table(name).schema
    rows = df.select(*aligned(df, order, fill_missing=True, nested=True))
    rows, written = counted(rows)
    rows.write.insertInto(name)
    return None if held is None else held + written()
