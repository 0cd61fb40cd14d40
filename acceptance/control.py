"""Control tables: readers, upserts, export, audit reports and cleanup.

The control rows are derived from the given tables by SQL that Spark and the check both run,
one row per part, customer, supplier or event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acceptance import Checks
from acceptance.workspace import Workspace
from strata import cleanup_group
from strata.plans import audit, config, views
from strata.schemas import AUDIT_TABLE, DETAIL_TABLES, GROUP

checks = Checks()

# One L0 row per part; the part's type is its group.
L0_ROWS = """
SELECT upper(p_type) || '_L0' AS data_flow_group_id,
       CASE WHEN p_size > 3 THEN ' /landing/' || CAST(p_partkey AS STRING) || ' ' END AS source_url,
       CASE WHEN p_size <> 50 THEN 'bronze ' END AS target_schema,
       'part_' || CAST(p_partkey AS STRING) AS target_table,
       CASE WHEN p_size < 20 THEN 'csv' WHEN p_size < 35 THEN ' JSON ' WHEN p_size < 45 THEN '' END
           AS file_format,
       CASE WHEN p_size BETWEEN 15 AND 18 THEN 'Parquet' WHEN p_size BETWEEN 30 AND 33 THEN ' ' END
           AS input_file_format,
       CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'VIEW' WHEN p_brand = 'Brand#3' THEN 'view'
            WHEN p_brand = 'Brand#4' THEN '' WHEN p_brand = 'Brand#5' THEN ' Incremental '
            WHEN p_brand = 'Brand#6' THEN 'WHATEVER' WHEN p_brand <> 'Brand#7' THEN 'FULL' END
           AS load_type,
       CASE WHEN p_size < 10 THEN '|' WHEN p_size < 20 THEN ' ; ' WHEN p_size < 30 THEN chr(9)
            WHEN p_size < 40 THEN '' END AS delimeter,
       CASE WHEN p_size IN (4, 13, 22, 36) THEN 'N' WHEN p_name LIKE 'red%' THEN 'y' ELSE 'Y' END
           AS is_active
FROM part
"""

# One L1 row per customer and one L2 row per supplier, in the same groups.
L1_ROWS = """
SELECT c_mktsegment AS data_flow_group_id, 'bronze' AS source_obj_schema,
       'n' || CAST(c_nationkey AS STRING) AS source_obj_name,
       'silver_' || CAST(c_nationkey AS STRING) AS target_schema,
       'cust_' || CAST(c_custkey AS STRING) AS target_table,
       CASE WHEN c_acctbal < 1000 THEN 'view' WHEN c_acctbal < 3000 THEN 'VIEW'
            WHEN c_acctbal < 8000 THEN 'FULL' END AS load_type,
       'SELECT ' || CAST(c_custkey AS STRING) AS transformation_query,
       'id' AS merge_keys,
       CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS is_active
FROM customer
"""
L2_ROWS = """
SELECT CASE WHEN s_acctbal < 4000 THEN 'BUILDING' ELSE 'MACHINERY' END AS data_flow_group_id,
       'silver' AS source_obj_schema, 'm' || CAST(s_nationkey AS STRING) AS source_obj_name,
       'gold_' || CAST(s_nationkey AS STRING) AS target_schema,
       'supp_' || CAST(s_suppkey AS STRING) AS target_table,
       CASE WHEN s_nationkey < 12 THEN 'VIEW' ELSE 'MERGE' END AS load_type,
       'SELECT ' || CAST(s_suppkey AS STRING) AS transformation_query,
       'id' AS merge_keys, 'Y' AS is_active
FROM supplier
"""

# One header row per customer.
HEADER_ROWS = """
SELECT upper(c_name) AS data_flow_group_id, c_name || ' job' AS job_name,
       '/jobs/' || c_mktsegment AS notebook_path, 'team ' || c_mktsegment AS data_sme,
       CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS is_active
FROM customer
"""

# One audit row per event.
AUDIT_ROWS = """
SELECT 'USER_' || CAST(user_id AS STRING) AS data_flow_group_id, event_type AS target_table,
       CASE WHEN event_type IN ('view', 'click') THEN 'L0' WHEN event_type = 'signup' THEN 'L1'
            ELSE 'L2' END AS etl_layer,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       event_id AS rows_loaded, props AS message, ts AS start_time, ts AS end_time, ts AS load_ts
FROM events
"""


def _derived(ws: Workspace, table: str, text: str) -> DataFrame:
    rows = ws.spark.sql(text.replace(f"FROM {table}", "FROM {given}"), given=ws.read(table))
    return rows.toDF(*[name.upper() for name in rows.columns])


def _l0(spark: SparkSession, sf_dir: str, name: str) -> Workspace:
    ws = Workspace(spark, sf_dir, name)
    config.upsert_l0(spark, _derived(ws, "part", L0_ROWS), ws.site)
    return ws


def _sql_layers(spark: SparkSession, sf_dir: str, name: str) -> Workspace:
    ws = Workspace(spark, sf_dir, name)
    config.upsert_l1(spark, _derived(ws, "customer", L1_ROWS), ws.site)
    config.upsert_l2(spark, _derived(ws, "supplier", L2_ROWS), ws.site)
    return ws


def _audit_log(spark: SparkSession, sf_dir: str, name: str) -> Workspace:
    ws = Workspace(spark, sf_dir, name)
    rows = _derived(ws, "events", AUDIT_ROWS)
    rows.write.insertInto(ws.site.control(AUDIT_TABLE))
    return ws


@checks.add(f"""
SELECT target_table AS "TARGET_TABLE", load_type AS "LOAD_TYPE", source_url AS "SOURCE_URL"
FROM ({L0_ROWS}) r
WHERE data_flow_group_id = 'STANDARD_L0' AND is_active = 'Y' AND upper(load_type) <> 'VIEW'
""")
def cfg_active_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _l0(spark, sf_dir, "cfg_active_loads")
    loads = config.active_loads(spark, "L0", " standard_l0", "ALL", ws.site)
    return loads.select("TARGET_TABLE", "LOAD_TYPE", "SOURCE_URL")


@checks.add(f"""
SELECT 'bronze' AS "TARGET_SCHEMA", target_table AS "TARGET_TABLE",
       CASE WHEN trim(coalesce(load_type, '')) = '' THEN 'FULL' ELSE upper(trim(load_type)) END
           AS "LOAD_TYPE",
       '' AS "MERGE_KEYS", trim(coalesce(source_url, '')) AS "SOURCE_URL",
       CASE WHEN input_file_format = 'Parquet' THEN 'parquet'
            WHEN input_file_format IS NULL AND file_format = ' JSON ' THEN 'json'
            ELSE 'csv' END AS "SOURCE_FORMAT",
       CASE delimeter WHEN '|' THEN '|' WHEN ' ; ' THEN ';' WHEN chr(9) THEN chr(9) ELSE ',' END
           AS "DELIMETER"
FROM ({L0_ROWS}) r WHERE target_schema IS NOT NULL
""")
def cfg_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _l0(spark, sf_dir, "cfg_normalise")
    rows = config.normalise_rows(spark.table(ws.site.control(DETAIL_TABLES["L0"])))
    return rows.drop("SOURCE_OBJ_SCHEMA", "SOURCE_OBJ_NAME", "TRANSFORMATION_QUERY")


@checks.add(f"""
SELECT * FROM (
    SELECT 'L1' AS layer, source_obj_schema AS src_schema, source_obj_name AS src_table,
           target_schema AS tgt_schema, target_table AS tgt_table, transformation_query AS query
    FROM ({L1_ROWS}) a
    WHERE data_flow_group_id = 'BUILDING' AND is_active = 'Y' AND upper(load_type) = 'VIEW'
    UNION ALL
    SELECT 'L2', source_obj_schema, source_obj_name, target_schema, target_table,
           transformation_query
    FROM ({L2_ROWS}) b
    WHERE data_flow_group_id = 'BUILDING' AND is_active = 'Y' AND upper(load_type) = 'VIEW'
) v
""")
def cfg_active_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _sql_layers(spark, sf_dir, "cfg_active_views")
    return config.active_views(spark, "building", "ALL", ws.site)


@checks.add(f"""
WITH v AS (
    SELECT 'L1' AS layer, target_schema FROM ({L1_ROWS}) a
    WHERE data_flow_group_id = 'MACHINERY' AND is_active = 'Y' AND upper(load_type) = 'VIEW'
    UNION ALL
    SELECT 'L2', target_schema FROM ({L2_ROWS}) b
    WHERE data_flow_group_id = 'MACHINERY' AND is_active = 'Y' AND upper(load_type) = 'VIEW'
), c AS (
    SELECT COUNT(*) FILTER (layer = 'L1') AS l1, COUNT(*) FILTER (layer = 'L2') AS l2,
           MAX(target_schema) FILTER (layer = 'L1') AS s1,
           MAX(target_schema) FILTER (layer = 'L2') AS s2
    FROM v
)
SELECT l1 AS "L1_VIEWS", l2 AS "L2_VIEWS",
       CASE WHEN l2 = 0 THEN 'L1' WHEN l1 = 0 THEN 'L2' ELSE 'ALL' END AS "RUN_LAYER",
       coalesce(s1, s2, 'silver') AS "TARGET_SCHEMA"
FROM c WHERE l1 + l2 > 0
""")
def cfg_view_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _sql_layers(spark, sf_dir, "cfg_view_plan")
    return views.plan(spark, "MACHINERY", ws.site)


@checks.add(f"""
SELECT target_table AS "TARGET_TABLE", target_schema AS "TARGET_SCHEMA" FROM ({L1_ROWS}) r
WHERE data_flow_group_id = 'FURNITURE' AND is_active = 'Y' AND upper(load_type) <> 'VIEW'
""")
def cfg_group_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _sql_layers(spark, sf_dir, "cfg_group_targets")
    return config.group_targets(spark, "L1", "FURNITURE", ws.site)


@checks.add(f"""
SELECT target_schema AS "TARGET_SCHEMA", target_table AS "TARGET_TABLE" FROM ({L1_ROWS}) r
WHERE data_flow_group_id = 'HOUSEHOLD'
""")
def cfg_all_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _sql_layers(spark, sf_dir, "cfg_all_targets")
    return config.all_targets(spark, "L1", "HOUSEHOLD", ws.site)


@checks.add(f"""
SELECT data_flow_group_id AS "DATA_FLOW_GROUP_ID", job_name AS "JOB_NAME",
       notebook_path AS "NOTEBOOK_PATH", is_active AS "IS_ACTIVE"
FROM ({HEADER_ROWS}) r WHERE is_active = 'Y'
""")
def cfg_active_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "cfg_active_groups")
    config.upsert_header(spark, _derived(ws, "customer", HEADER_ROWS), ws.site)
    return config.active_groups(spark, site=ws.site)


@checks.add(f"""
SELECT data_flow_group_id AS "DATA_FLOW_GROUP_ID", job_name AS "JOB_NAME",
       CASE WHEN data_sme = 'team BUILDING' THEN '/moved' ELSE notebook_path END
           AS "NOTEBOOK_PATH",
       data_sme AS "DATA_SME",
       CASE WHEN data_sme = 'team BUILDING' THEN 'N' ELSE is_active END AS "IS_ACTIVE"
FROM ({HEADER_ROWS}) r
UNION ALL
SELECT s_name, s_name || ' job', '/jobs/new', NULL, 'Y' FROM supplier
""")
def cfg_upsert_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known groups take only the updatable columns, new groups come in whole."""
    ws = Workspace(spark, sf_dir, "cfg_upsert_header")
    rows = _derived(ws, "customer", HEADER_ROWS)
    config.upsert_header(spark, rows, ws.site)
    changed = rows.where("DATA_SME = 'team BUILDING'").select(
        GROUP,
        F.lit("not taken").alias("JOB_NAME"),
        F.lit("/moved").alias("NOTEBOOK_PATH"),
        F.lit("N").alias("IS_ACTIVE"),
    )
    new = ws.read("supplier").select(
        F.col("s_name").alias(GROUP),
        F.concat("s_name", F.lit(" job")).alias("JOB_NAME"),
        F.lit("/jobs/new").alias("NOTEBOOK_PATH"),
        F.lit("Y").alias("IS_ACTIVE"),
    )
    config.upsert_header(spark, changed.unionByName(new), ws.site)
    header = spark.table(ws.site.control("data_flow_control_header"))
    return header.select(GROUP, "JOB_NAME", "NOTEBOOK_PATH", "DATA_SME", "IS_ACTIVE")


@checks.add(f"""
SELECT data_flow_group_id AS "DATA_FLOW_GROUP_ID", target_table AS "TARGET_TABLE",
       target_schema AS "TARGET_SCHEMA",
       CASE WHEN file_format = 'csv' THEN '/relanded' ELSE source_url END AS "SOURCE_URL",
       CASE WHEN file_format = 'csv' THEN 'parquet' ELSE file_format END AS "FILE_FORMAT",
       CASE WHEN file_format = 'csv' THEN 'APPEND' ELSE load_type END AS "LOAD_TYPE",
       delimeter AS "DELIMETER",
       CASE WHEN file_format = 'csv' THEN 'Y' ELSE is_active END AS "IS_ACTIVE"
FROM ({L0_ROWS}) r
""")
def cfg_upsert_l0(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _l0(spark, sf_dir, "cfg_upsert_l0")
    changed = _derived(ws, "part", L0_ROWS).where("FILE_FORMAT = 'csv'").select(
        GROUP,
        "TARGET_TABLE",
        F.lit("not taken").alias("TARGET_SCHEMA"),
        F.lit("/relanded").alias("SOURCE_URL"),
        F.lit("parquet").alias("FILE_FORMAT"),
        F.lit("APPEND").alias("LOAD_TYPE"),
        F.lit("not taken").alias("DELIMETER"),
        F.lit("Y").alias("IS_ACTIVE"),
    )
    config.upsert_l0(spark, changed, ws.site)
    return spark.table(ws.site.control(DETAIL_TABLES["L0"])).select(
        GROUP, "TARGET_TABLE", "TARGET_SCHEMA", "SOURCE_URL", "FILE_FORMAT", "LOAD_TYPE",
        "DELIMETER", "IS_ACTIVE",
    )


@checks.add(f"""
SELECT data_flow_group_id AS "DATA_FLOW_GROUP_ID", target_table AS "TARGET_TABLE",
       target_schema AS "TARGET_SCHEMA", source_obj_name AS "SOURCE_OBJ_NAME",
       CASE WHEN load_type = 'FULL' THEN 'MERGE' ELSE load_type END AS "LOAD_TYPE",
       CASE WHEN load_type = 'FULL' THEN 'SELECT 1 AS id' ELSE transformation_query END
           AS "TRANSFORMATION_QUERY",
       CASE WHEN load_type = 'FULL' THEN 'id, day' ELSE merge_keys END AS "MERGE_KEYS",
       CAST(NULL AS VARCHAR) AS "PARTITION_BY", is_active AS "IS_ACTIVE"
FROM ({L1_ROWS}) r
UNION ALL
SELECT data_flow_group_id, target_table, target_schema, source_obj_name, load_type,
       transformation_query, merge_keys, NULL, is_active
FROM ({L2_ROWS}) r
""")
def cfg_upsert_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _sql_layers(spark, sf_dir, "cfg_upsert_l1")
    changed = _derived(ws, "customer", L1_ROWS).where("LOAD_TYPE = 'FULL'").select(
        GROUP,
        "TARGET_TABLE",
        F.lit("not taken").alias("TARGET_SCHEMA"),
        F.lit("not taken").alias("SOURCE_OBJ_NAME"),
        F.lit("MERGE").alias("LOAD_TYPE"),
        F.lit("SELECT 1 AS id").alias("TRANSFORMATION_QUERY"),
        F.lit("id, day").alias("MERGE_KEYS"),
        F.lit("not taken").alias("PARTITION_BY"),
        "IS_ACTIVE",
    )
    # Rows of another layer are new targets here, so they come in whole.
    new = _derived(ws, "supplier", L2_ROWS)
    config.upsert_l1(spark, changed.unionByName(new, allowMissingColumns=True), ws.site)
    return spark.table(ws.site.control(DETAIL_TABLES["L1"])).select(
        GROUP, "TARGET_TABLE", "TARGET_SCHEMA", "SOURCE_OBJ_NAME", "LOAD_TYPE",
        "TRANSFORMATION_QUERY", "MERGE_KEYS", "PARTITION_BY", "IS_ACTIVE",
    )


@checks.add(f"""
WITH d AS (
    SELECT target_table, source_url AS url, target_schema AS sch, file_format AS fmt,
           load_type AS lt
    FROM ({L0_ROWS}) r WHERE data_flow_group_id = 'PROMO_L0' AND is_active = 'Y'
)
SELECT 0 AS part, '' AS target, '-- nightly | PROMO_L0
MERGE INTO "control_header" AS tgt
USING (SELECT ''PROMO_L0'' AS DATA_FLOW_GROUP_ID, ''PROMO_L0_JOB'' AS JOB_NAME, ''/jobs/parts'' AS NOTEBOOK_PATH, ''Y'' AS IS_ACTIVE, current_timestamp() AS CREATED_DATE, current_timestamp() AS UPDATED_DATE) AS src
ON tgt.DATA_FLOW_GROUP_ID = src.DATA_FLOW_GROUP_ID
WHEN MATCHED THEN UPDATE SET tgt.NOTEBOOK_PATH = src.NOTEBOOK_PATH, tgt.IS_ACTIVE = src.IS_ACTIVE, tgt.UPDATED_DATE = src.UPDATED_DATE
WHEN NOT MATCHED THEN INSERT (DATA_FLOW_GROUP_ID, JOB_NAME, NOTEBOOK_PATH, IS_ACTIVE, CREATED_DATE, UPDATED_DATE) VALUES (src.DATA_FLOW_GROUP_ID, src.JOB_NAME, src.NOTEBOOK_PATH, src.IS_ACTIVE, src.CREATED_DATE, src.UPDATED_DATE);
' AS statement
WHERE EXISTS (SELECT 1 FROM d)
UNION ALL
SELECT 1, target_table, 'MERGE INTO "l0_detail" AS tgt
USING (SELECT ''PROMO_L0'' AS DATA_FLOW_GROUP_ID, '
|| coalesce('''' || url || '''', 'NULL') || ' AS SOURCE_URL, '
|| coalesce('''' || sch || '''', 'NULL') || ' AS TARGET_SCHEMA, '
|| coalesce('''' || target_table || '''', 'NULL') || ' AS TARGET_TABLE, '
|| coalesce('''' || fmt || '''', 'NULL') || ' AS FILE_FORMAT, '
|| coalesce('''' || lt || '''', 'NULL') || ' AS LOAD_TYPE, ''Y'' AS IS_ACTIVE, current_timestamp() AS CREATED_DATE, current_timestamp() AS UPDATED_DATE) AS src
ON tgt.DATA_FLOW_GROUP_ID = src.DATA_FLOW_GROUP_ID AND tgt.TARGET_TABLE = src.TARGET_TABLE
WHEN MATCHED THEN UPDATE SET tgt.SOURCE_URL = src.SOURCE_URL, tgt.FILE_FORMAT = src.FILE_FORMAT, tgt.LOAD_TYPE = src.LOAD_TYPE, tgt.IS_ACTIVE = src.IS_ACTIVE, tgt.UPDATED_DATE = src.UPDATED_DATE
WHEN NOT MATCHED THEN INSERT (DATA_FLOW_GROUP_ID, SOURCE_URL, TARGET_SCHEMA, TARGET_TABLE, FILE_FORMAT, LOAD_TYPE, IS_ACTIVE, CREATED_DATE, UPDATED_DATE) VALUES (src.DATA_FLOW_GROUP_ID, src.SOURCE_URL, src.TARGET_SCHEMA, src.TARGET_TABLE, src.FILE_FORMAT, src.LOAD_TYPE, src.IS_ACTIVE, src.CREATED_DATE, src.UPDATED_DATE);
'
FROM d
""")
def cfg_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of a group's export; the site's table names are put in short form."""
    ws = _l0(spark, sf_dir, "cfg_export")
    config.upsert_header(
        spark, [{GROUP: "PROMO_L0", "NOTEBOOK_PATH": "/jobs/parts", "IS_ACTIVE": "Y"}], ws.site
    )
    script = config.export_merge_script(spark, "promo_l0", "nightly", ws.site)
    short = script["statement"]
    for table, name in (("data_flow_control_header", "control_header"),
                        ("data_flow_l0_detail", "l0_detail")):
        short = F.replace(short, F.lit(ws.site.control(table)), F.lit(f'"{name}"'))
    return script.withColumn("statement", short)


@checks.add(f"""
SELECT target_table AS "TARGET_TABLE", status AS "STATUS", rows_loaded AS "ROWS_LOADED",
       message AS "MESSAGE"
FROM ({AUDIT_ROWS}) r WHERE data_flow_group_id = 'USER_7'
""")
def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _audit_log(spark, sf_dir, "audit_history")
    rows = audit.history(spark, "user_7", ws.site)
    return rows.select("TARGET_TABLE", "STATUS", "ROWS_LOADED", "MESSAGE")


@checks.add(f"""
SELECT etl_layer AS "ETL_LAYER", COUNT(*) FILTER (status = 'SUCCESS') AS "OK",
       COUNT(*) FILTER (status = 'FAILED') AS "FAILED",
       COUNT(*) FILTER (status = 'FAILED') = 0 AS "ALL_OK"
FROM ({AUDIT_ROWS}) r GROUP BY etl_layer
""")
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _audit_log(spark, sf_dir, "audit_summary")
    return audit.summary(spark, site=ws.site)


@checks.add("""
SELECT t.name AS "TARGET_TABLE", 'SUCCESS' AS "STATUS", t.n AS "ROWS_LOADED", r.n AS run
FROM (SELECT 'orders' AS name, COUNT(*) AS n FROM orders UNION ALL
      SELECT 'customer', COUNT(*) FROM customer UNION ALL
      SELECT 'lineitem', COUNT(*) FROM lineitem) t, (VALUES (1), (2), (3)) r(n)
""")
def audit_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of a group is the same after its runs have become one folder."""
    ws = Workspace(spark, sf_dir, "audit_compacted")
    ws.land("orders", "customer", "lineitem")
    for _ in range(2):
        ws.run("LAND_L0", parallelism=3)
    cleanup_group(spark, "NEVER", ws.site, delete_audit=True)
    if audit.compact(spark, site=ws.site) != 9:
        raise AssertionError("runs were left out")
    in_turn = Window.partitionBy("TARGET_TABLE").orderBy("START_TIME")
    rows = audit.history(spark, "land_l0", ws.site).withColumn("run", F.row_number().over(in_turn))
    return rows.select("TARGET_TABLE", "STATUS", "ROWS_LOADED", "run")


@checks.add(f"""
SELECT 'l0' AS place, data_flow_group_id AS "DATA_FLOW_GROUP_ID", target_table AS "TARGET_TABLE"
FROM ({L0_ROWS}) r WHERE data_flow_group_id <> 'LARGE_L0'
UNION ALL
SELECT 'audit', data_flow_group_id, target_table FROM ({AUDIT_ROWS}) r
""")
def cleanup_one_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays after a group's targets, control rows and audit rows are gone."""
    ws = _l0(spark, sf_dir, "cleanup_one_group")
    _derived(ws, "events", AUDIT_ROWS).write.insertInto(ws.site.control(AUDIT_TABLE))
    ws.land("orders")
    cleanup_group(
        spark, "LAND_L0", ws.site, delete_header=True, delete_l0=True, delete_audit=True,
        drop_bronze=True,
    )
    cleanup_group(spark, "LARGE_L0", ws.site, delete_l0=True, delete_audit=True)
    if spark.catalog.tableExists(ws.site.table(ws.bronze, "orders")):
        raise AssertionError("the target outlived its group")
    place = {"l0": DETAIL_TABLES["L0"], "audit": AUDIT_TABLE}
    parts = [
        spark.table(ws.site.control(table)).select(
            F.lit(name).alias("place"), GROUP, "TARGET_TABLE"
        )
        for name, table in place.items()
    ]
    return parts[0].unionByName(parts[1])
