"""The control tables: installing, reading, maintaining and exporting them.

Every reader returns a lazy DataFrame over the control table.
"""

from __future__ import annotations

from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from strata.functions import first_filled, group_key, or_default, stripped
from strata.operators.merge import merge
from strata.schemas import AUDIT_TABLE, CONTROL_TABLES, DETAIL_TABLES, GROUP, HEADER_TABLE
from strata.site import Site

# Columns an upsert may change in a row that exists already.
HEADER_UPDATES = ["NOTEBOOK_PATH", "IS_ACTIVE", "UPDATED_DATE"]
L0_UPDATES = ["SOURCE_URL", "FILE_FORMAT", "LOAD_TYPE", "IS_ACTIVE", "UPDATED_DATE"]
SQL_LAYER_UPDATES = [
    "TRANSFORMATION_QUERY",
    "LOAD_TYPE",
    "MERGE_KEYS",
    "IS_ACTIVE",
    "UPDATED_DATE",
]


def install(spark: SparkSession, site: Site = Site()) -> list[str]:
    """Create the schemas and control tables that are missing; list the control tables."""
    site = site.on(spark)
    for schema in (site.admin, *site.layers):
        site.create_schema(spark, schema)
    for table, schema in CONTROL_TABLES.items():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in schema
        )
        # Writers of the audit log each have a folder of their own below it.
        own_folders = table == AUDIT_TABLE and site.table_format != "delta"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {site.control(table)} ({columns}) "
            f"USING {site.table_format}"
            + (" OPTIONS (recursiveFileLookup 'true')" if own_folders else "")
        )
    shown = spark.sql(f"SHOW TABLES IN {site.schema(site.admin)}").collect()
    return sorted(row.tableName for row in shown if not row.isTemporary)


def _details(spark: SparkSession, site: Site, layer: str) -> DataFrame:
    return spark.table(site.on(spark).control(DETAIL_TABLES[layer]))


def _in_group(group_id: str) -> Column:
    return F.col(GROUP) == F.lit(group_key(group_id))


_IS_ACTIVE = "IS_ACTIVE = 'Y'"
# A NULL load type satisfies neither, so such rows never run.
_IS_LOAD = "upper(LOAD_TYPE) != 'VIEW'"
_IS_VIEW = "upper(LOAD_TYPE) = 'VIEW'"


def table_filter(table: str | None) -> str | None:
    """Name of the one target asked for; blank and ALL mean every target."""
    name = (table or "").strip()
    return None if name in ("", "ALL") else name


def active_loads(
    spark: SparkSession, layer: str, group_id: str, table: str | None = None, site: Site = Site()
) -> DataFrame:
    """Active rows of a group that the loader runs in a layer, in running order."""
    rows = _details(spark, site, layer).where(_in_group(group_id)).where(_IS_ACTIVE)
    rows = rows.where(_IS_LOAD)
    only = table_filter(table)
    if only:
        rows = rows.where(F.col("TARGET_TABLE") == F.lit(only))
    return rows.orderBy("TARGET_TABLE")


def normalise_rows(rows: DataFrame) -> DataFrame:
    """Control rows as the loader uses them: stripped, with defaults, only those with a target."""
    present = {name.upper() for name in rows.columns}

    def text(name: str) -> str:
        return name if name in present else "CAST(NULL AS STRING)"

    fields = {
        "TARGET_SCHEMA": stripped(text("TARGET_SCHEMA")),
        "TARGET_TABLE": stripped(text("TARGET_TABLE")),
        "LOAD_TYPE": f"upper({or_default(text('LOAD_TYPE'), 'FULL')})",
        "MERGE_KEYS": stripped(text("MERGE_KEYS")),
        "SOURCE_URL": stripped(text("SOURCE_URL")),
        "SOURCE_OBJ_SCHEMA": stripped(text("SOURCE_OBJ_SCHEMA")),
        "SOURCE_OBJ_NAME": stripped(text("SOURCE_OBJ_NAME")),
        "SOURCE_FORMAT": "lower({})".format(
            or_default(first_filled(text("INPUT_FILE_FORMAT"), text("FILE_FORMAT")), "csv")
        ),
        # Only blanks are cut off a separator: a lone tab is one.
        "DELIMETER": f"coalesce(nullif(trim({text('DELIMETER')}), ''), ',')",
        "TRANSFORMATION_QUERY": stripped(text("TRANSFORMATION_QUERY")),
    }
    named = rows.selectExpr(*[f"{value} AS {name}" for name, value in fields.items()])
    return named.where("TARGET_SCHEMA != '' AND TARGET_TABLE != ''")


def active_views(
    spark: SparkSession, group_id: str, run_layer: str = "ALL", site: Site = Site()
) -> DataFrame:
    """Active VIEW rows of a group, L1 before L2, each by target name.

    A layer without a detail table has none.
    """
    site = site.on(spark)
    layers = [layer for layer in ("L1", "L2") if run_layer in ("ALL", layer)]
    if not layers:
        raise ValueError(f"Views exist in L1 and L2, not in '{run_layer}'.")
    layers = [name for name in layers if spark.catalog.tableExists(site.control(DETAIL_TABLES[name]))]
    if not layers:
        raise LookupError(f"No detail tables in {site.schema(site.admin)}.")
    parts = [
        _details(spark, site, layer)
        .where(_in_group(group_id))
        .where(_IS_ACTIVE)
        .where(_IS_VIEW)
        .select(
            F.lit(layer).alias("layer"),
            F.col("SOURCE_OBJ_SCHEMA").alias("src_schema"),
            F.col("SOURCE_OBJ_NAME").alias("src_table"),
            F.col("TARGET_SCHEMA").alias("tgt_schema"),
            F.col("TARGET_TABLE").alias("tgt_table"),
            F.col("TRANSFORMATION_QUERY").alias("query"),
        )
        for layer in layers
    ]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.orderBy("layer", "tgt_table")


def active_groups(
    spark: SparkSession, group_id: str | None = None, site: Site = Site()
) -> DataFrame:
    """Active groups in order, all or the one asked for; an error if there is none."""
    rows = spark.table(site.on(spark).control(HEADER_TABLE)).where(_IS_ACTIVE)
    asked = (group_id or "").strip().upper()
    if asked:
        rows = rows.where(_in_group(asked))
    if rows.isEmpty():
        raise LookupError(
            f"{asked or 'The header'} has no row that is switched on (IS_ACTIVE other than 'Y')."
        )
    return rows.select(GROUP, "JOB_NAME", "NOTEBOOK_PATH", "IS_ACTIVE").orderBy(GROUP)


def group_targets(
    spark: SparkSession, layer: str, group_id: str, site: Site = Site()
) -> DataFrame:
    """Targets the loader writes for a group. A group without layer suffix lists L0."""
    rows = _details(spark, site, layer if layer in ("L1", "L2") else "L0")
    rows = rows.where(_in_group(group_id)).where(_IS_ACTIVE).where(_IS_LOAD)
    return rows.select("TARGET_TABLE", "TARGET_SCHEMA").orderBy("TARGET_TABLE")


def all_targets(spark: SparkSession, layer: str, group_id: str, site: Site = Site()) -> DataFrame:
    """Targets of a group, active or not. The id is matched as stored."""
    rows = _details(spark, site, layer).where(F.col(GROUP) == F.lit(group_id))
    return rows.select("TARGET_SCHEMA", "TARGET_TABLE")


def upsert_header(
    spark: SparkSession, rows: DataFrame | list[dict[str, Any]], site: Site = Site()
) -> None:
    _upsert(spark, site, HEADER_TABLE, rows, [GROUP], HEADER_UPDATES)


def upsert_l0(
    spark: SparkSession, rows: DataFrame | list[dict[str, Any]], site: Site = Site()
) -> None:
    _upsert(spark, site, DETAIL_TABLES["L0"], rows, [GROUP, "TARGET_TABLE"], L0_UPDATES)


def upsert_l1(
    spark: SparkSession, rows: DataFrame | list[dict[str, Any]], site: Site = Site()
) -> None:
    _upsert(spark, site, DETAIL_TABLES["L1"], rows, [GROUP, "TARGET_TABLE"], SQL_LAYER_UPDATES)


def upsert_l2(
    spark: SparkSession, rows: DataFrame | list[dict[str, Any]], site: Site = Site()
) -> None:
    _upsert(spark, site, DETAIL_TABLES["L2"], rows, [GROUP, "TARGET_TABLE"], SQL_LAYER_UPDATES)


def _upsert(
    spark: SparkSession,
    site: Site,
    table: str,
    rows: DataFrame | list[dict[str, Any]],
    keys: list[str],
    updates: list[str],
) -> None:
    """Insert new control rows; in known ones change only the listed columns.

    Rows may leave columns out. Both dates default to now.
    """
    site = site.on(spark)
    if not isinstance(rows, DataFrame):
        rows = _as_frame(spark, rows, CONTROL_TABLES[table])
    for date in ("CREATED_DATE", "UPDATED_DATE"):
        if date not in rows.columns:
            rows = rows.withColumn(date, F.current_timestamp())
    # File tables do not enforce NOT NULL.
    given = F.coalesce(F.col(GROUP), F.raise_error(f"{GROUP} is NULL in a row for {table}"))
    rows = rows.withColumn(GROUP, given)
    merge(rows, site, site.admin, table, keys, updates)


def _as_frame(
    spark: SparkSession, rows: list[dict[str, Any]], schema: StructType
) -> DataFrame:
    named = {name for row in rows for name in row}
    unknown = named.difference(schema.names)
    if unknown:
        raise ValueError(f"Unknown control columns: {', '.join(sorted(unknown))}.")
    used = StructType([StructField(f.name, f.dataType) for f in schema if f.name in named])
    # Through Arrow the rows become a local relation: no Python workers, one task.
    columns = {name: [row.get(name) for row in rows] for name in used.names}
    return spark.createDataFrame(pa.table(columns, to_arrow_schema(used)))


def export_merge_script(
    spark: SparkSession, group_id: str, label: str = "", site: Site = Site()
) -> DataFrame:
    """A group's header and L0 rows as MERGE statements that recreate them elsewhere.

    One row per statement, in order: the header, then the targets by name. Empty unless the
    group has an active header and active L0 rows. Save it with ``write_script``.
    """
    site = site.on(spark)
    group = group_key(group_id)
    active = _in_group(group) & F.expr(_IS_ACTIVE)
    header = spark.table(site.control(HEADER_TABLE)).where(active)
    details = _details(spark, site, "L0").where(active)
    is_complete = F.lit(not header.isEmpty() and not details.isEmpty())

    header_values = {
        GROUP: F.col(GROUP),
        "JOB_NAME": F.concat(F.col(GROUP), F.lit("_JOB")),
        "NOTEBOOK_PATH": F.col("NOTEBOOK_PATH"),
        "IS_ACTIVE": F.lit("Y"),
    }
    detail_columns = (GROUP, "SOURCE_URL", "TARGET_SCHEMA", "TARGET_TABLE", "FILE_FORMAT")
    detail_values = {name: F.col(name) for name in (*detail_columns, "LOAD_TYPE")}
    detail_values["IS_ACTIVE"] = F.lit("Y")
    comment = F.lit(f"-- {label or 'export'} | {group}\n")
    statements = header.select(
        F.lit(0).alias("part"),
        F.lit("").alias("target"),
        F.concat(
            comment,
            _merge_statement(site.control(HEADER_TABLE), header_values, [GROUP], HEADER_UPDATES),
        ).alias("statement"),
    ).unionByName(
        details.select(
            F.lit(1).alias("part"),
            F.col("TARGET_TABLE").alias("target"),
            _merge_statement(
                site.control(DETAIL_TABLES["L0"]),
                detail_values,
                [GROUP, "TARGET_TABLE"],
                L0_UPDATES,
            ).alias("statement"),
        )
    )
    return statements.where(is_complete).orderBy("part", "target")


def write_script(script: DataFrame, path: str) -> None:
    """Save an exported script as text; part files are in statement order."""
    script.select("statement").write.mode("overwrite").text(path)


def _merge_statement(
    table: str, values: dict[str, Column], keys: list[str], updates: list[str]
) -> Column:
    dates = ("CREATED_DATE", "UPDATED_DATE")
    names = [*values, *dates]
    source: list[Column] = []
    for name, value in values.items():
        source += [_literal(value), F.lit(f" AS {name}, ")]
    on = " AND ".join(f"tgt.{key} = src.{key}" for key in keys)
    sets = ", ".join(f"tgt.{name} = src.{name}" for name in updates)
    inserted = ", ".join(f"src.{name}" for name in names)
    return F.concat(
        F.lit(f"MERGE INTO {table} AS tgt\nUSING (SELECT "),
        *source,
        F.lit(", ".join(f"current_timestamp() AS {name}" for name in dates)),
        F.lit(f") AS src\nON {on}\nWHEN MATCHED THEN UPDATE SET {sets}\n"),
        F.lit(f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) VALUES ({inserted});\n"),
    )


def _literal(value: Column) -> Column:
    """SQL literal of a text value."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.coalesce(F.concat(F.lit("'"), escaped, F.lit("'")), F.lit("NULL"))
