"""Sources, load modes and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import Checks
from acceptance.workspace import Workspace
from strata import conflicting_keys, publish, write_table
from strata import delete_where as delete_rows
from strata.plans import audit

checks = Checks()


@checks.add("""
SELECT CAST(ts AS DATE) AS event_date, event_type, COUNT(*) AS n_events,
       COUNT(DISTINCT user_id) AS n_users, ROUND(SUM(value), 2) AS total_value
FROM events WHERE value IS NOT NULL GROUP BY CAST(ts AS DATE), event_type
""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to bronze to silver to gold in one run of one group."""
    ws = Workspace(spark, sf_dir, "flagship")
    group = "EVENT_REPORT"
    ws.l0(group, {"SOURCE_URL": ws.path("events"), "TARGET_TABLE": "events"})
    ws.l1(
        group,
        {
            "SOURCE_OBJ_NAME": "events",
            "TARGET_TABLE": "valued_events",
            "TRANSFORMATION_QUERY": "SELECT event_id, ts, user_id, event_type, value, "
            "_etl_load_ts AS bronze_ts, current_timestamp() AS silver_ts "
            f"FROM {ws.bronze}.events WHERE value IS NOT NULL",
        },
    )
    ws.l2(
        group,
        {
            "SOURCE_OBJ_NAME": "valued_events",
            "TARGET_TABLE": "daily_events",
            "TRANSFORMATION_QUERY": "SELECT CAST(ts AS DATE) AS event_date, event_type, "
            "COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS n_users, "
            "ROUND(SUM(value), 2) AS total_value FROM valued_events "
            "GROUP BY CAST(ts AS DATE), event_type",
        },
    )
    ws.run(group)
    return ws.result(ws.gold, "daily_events")


# Sources


@checks.add("""
SELECT CAST(c_custkey AS INT) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer
""")
def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with its own separator and inferred types, many files."""
    ws = Workspace(spark, sf_dir, "src_csv")
    landed = f"{ws.scratch}/customer_csv"
    ws.read("customer").write.csv(landed, header=True, sep="|")
    ws.l0(
        "CSV_L0",
        {
            "SOURCE_URL": landed,
            "FILE_FORMAT": "csv",
            "DELIMETER": " | ",
            "TARGET_TABLE": "customer",
        },
    )
    ws.run("CSV_L0")
    result = ws.result(ws.bronze, "customer")
    return result.withColumn("c_custkey", F.col("c_custkey").cast("int"))


@checks.add("""
SELECT event_id, user_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events
""")
def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files of one array each, with a nested object read as a struct."""
    ws = Workspace(spark, sf_dir, "src_json")
    landed = f"{ws.scratch}/events_json"
    event = F.struct(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.from_json("props", "k BIGINT").alias("props"),
    )
    # Event ids are unique, so an array holds at most 2000 events.
    arrays = ws.read("events").groupBy(F.floor(F.col("event_id") / 2000)).agg(
        F.to_json(F.collect_list(event)).alias("document")
    )
    arrays.select("document").write.option("maxRecordsPerFile", 1).text(landed)
    ws.l0(
        "JSON_L0",
        {
            "SOURCE_URL": landed,
            "FILE_FORMAT": "csv",
            "INPUT_FILE_FORMAT": " Json ",
            "TARGET_TABLE": "events",
        },
    )
    ws.run("JSON_L0")
    return ws.result(ws.bronze, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("props.k").alias("k")
    )


@checks.add("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def src_landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many landed files named by a glob, loaded as one target."""
    ws = Workspace(spark, sf_dir, "src_landed_files")
    orders = ws.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    orders.write.partitionBy("o_orderstatus").parquet(f"{ws.scratch}/landed")
    ws.l0(
        "FILES_L0",
        {"SOURCE_URL": f"{ws.scratch}/landed", "TARGET_TABLE": "by_folder"},
        {"SOURCE_URL": f"{ws.scratch}/landed/*/*.parquet", "TARGET_TABLE": "by_glob"},
    )
    ws.run("FILES_L0")
    # The folder brings its partition column, the glob only what is inside the files.
    by_folder, by_glob = (ws.result(ws.bronze, name) for name in ("by_folder", "by_glob"))
    return by_folder.join(by_glob, ["o_orderkey", "o_custkey", "o_totalprice"], "left_semi")


@checks.add("SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def src_existing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L0 row without a path: LOAD_TYPE DELTA over a table that exists already."""
    ws = Workspace(spark, sf_dir, "src_existing_table")
    lines = ws.read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    write_table(lines, ws.silver, "delivered", site=ws.site)
    ws.l0(
        "TABLE_L0",
        {
            "SOURCE_OBJ_SCHEMA": ws.silver,
            "SOURCE_OBJ_NAME": "delivered",
            "LOAD_TYPE": "delta",
            "TARGET_TABLE": "lines",
        },
    )
    ws.run("TABLE_L0")
    return ws.result(ws.bronze, "lines")


@checks.add("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def table_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 row without a query: the whole source table."""
    ws = Workspace(spark, sf_dir, "table_passthrough")
    ws.land("part")
    ws.l1("PASS_L1", {"SOURCE_OBJ_NAME": "part", "TARGET_TABLE": "part"})
    ws.run("PASS_L1")
    return ws.result(ws.silver, "part")


# Load modes


@checks.add("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def load_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second FULL load replaces rows and schema of the first."""
    ws = Workspace(spark, sf_dir, "load_full")
    ws.transform("SELECT o_orderkey, o_orderstatus FROM orders", "orders")
    ws.load_silver("SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
                   SOURCE_OBJ_SCHEMA=ws.bronze)
    return ws.result(ws.silver, "result")


@checks.add("""
SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus <> 'P'
""")
def load_full_of_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A FULL load whose query reads the table it replaces."""
    ws = Workspace(spark, sf_dir, "load_full_of_itself")
    ws.transform("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders", "orders")
    ws.load_silver(
        "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice "
        f"FROM {ws.silver}.result WHERE o_orderstatus <> 'P'"
    )
    return ws.result(ws.silver, "result")


@checks.add("SELECT event_id, user_id, event_type, value FROM events")
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two INCREMENTAL loads; the row's query changes in between."""
    ws = Workspace(spark, sf_dir, "load_append")
    columns = "SELECT event_id, user_id, event_type, value FROM events"
    ws.transform(f"{columns} WHERE event_type IN ('view', 'click')", "events",
                 LOAD_TYPE="incremental")
    ws.load_silver(f"{columns} WHERE event_type NOT IN ('view', 'click')", LOAD_TYPE="APPEND")
    return ws.result(ws.silver, "result")


@checks.add("""
SELECT event_id, user_id, event_type,
       CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE props END AS props,
       CASE WHEN event_type IN ('view', 'click') THEN value END AS value
FROM events
""")
def load_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch brings a new column and lacks a known one."""
    ws = Workspace(spark, sf_dir, "load_append_evolve")
    ws.transform(
        "SELECT event_id, user_id, event_type, value FROM events "
        "WHERE event_type IN ('view', 'click')",
        "events",
        LOAD_TYPE="APPEND",
    )
    ws.load_silver(
        "SELECT props, event_type, event_id, user_id FROM events "
        "WHERE event_type NOT IN ('view', 'click')",
        LOAD_TYPE="APPEND",
    )
    return ws.result(ws.silver, "result")


@checks.add("""
SELECT event_id, user_id AS who,
       CASE WHEN event_type NOT IN ('view', 'click') THEN value END AS amount
FROM events
""")
def load_append_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch brings a field inside a struct, under a name that needs quotes."""
    ws = Workspace(spark, sf_dir, "load_append_nested")
    ws.transform(
        "SELECT event_id, NAMED_STRUCT('user_id', user_id) AS s FROM events "
        "WHERE event_type IN ('view', 'click')",
        "events",
        LOAD_TYPE="APPEND",
    )
    ws.load_silver(
        "SELECT event_id, NAMED_STRUCT('unit-price', value, 'user_id', user_id) AS s FROM events "
        "WHERE event_type NOT IN ('view', 'click')",
        LOAD_TYPE="APPEND",
    )
    rows = ws.result(ws.silver, "result")
    return rows.selectExpr("event_id", "s.user_id AS who", "s.`unit-price` AS amount")


@checks.add("""
SELECT o_orderkey, o_orderstatus, o_totalprice, 'orders' AS side FROM orders
WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'orders__stage' AS side FROM orders
WHERE o_orderstatus = 'F'
""")
def load_beside_a_stage_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table called like another with a suffix is no stage of it, whatever is loaded."""
    ws = Workspace(spark, sf_dir, "load_beside_a_stage_name")
    ws.land("orders")
    columns = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
    for table, load_type, query in (
        ("orders__stage", "FULL", f"{columns} WHERE o_orderstatus = 'F'"),
        ("orders", "FULL", f"{columns} WHERE o_orderstatus = 'O'"),
        ("orders", "APPEND", f"{columns} WHERE o_orderstatus = 'P'"),
        ("orders", "MERGE", f"{columns} WHERE o_orderstatus <> 'F'"),
    ):
        ws.load_silver(query, TARGET_TABLE=table, LOAD_TYPE=load_type, MERGE_KEYS="o_orderkey")
    sides = (
        ws.result(ws.silver, table).selectExpr("*", f"'{table}' AS side")
        for table in ("orders", "orders__stage")
    )
    left, right = sides
    return left.unionByName(right)


@checks.add("""
SELECT c_mktsegment, COUNT(*) AS n,
       ROUND(SUM(c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 100 ELSE 0 END), 2) AS total,
       c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AS is_untouched
FROM customer WHERE c_mktsegment <> 'MACHINERY' OR c_acctbal >= 0 GROUP BY c_mktsegment
""")
def load_touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge and a delete leave the files of partitions that they don't touch."""
    ws = Workspace(spark, sf_dir, "load_touched_partitions")
    ws.land("customer")
    ws.site.create_schema(spark, ws.silver)
    name = ws.site.table(ws.silver, "result")
    spark.sql(
        f"CREATE TABLE {name} (c_custkey BIGINT, c_acctbal DOUBLE, c_mktsegment STRING) "
        "USING parquet PARTITIONED BY (c_mktsegment)"
    )
    ws.load_silver("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer", LOAD_TYPE="APPEND")

    def files() -> DataFrame:
        return spark.table(name).select("c_mktsegment", F.input_file_name().alias("file")).distinct()

    before = files().groupBy("c_mktsegment").agg(F.sort_array(F.collect_set("file")).alias("files"))
    before.write.parquet(f"{ws.scratch}/files")
    ws.load_silver(
        "SELECT c_custkey, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'",
        LOAD_TYPE="MERGE",
        MERGE_KEYS="c_custkey",
    )
    predicate = "c_mktsegment = 'MACHINERY' AND c_acctbal < 0"
    delete_rows(spark, ws.site, ws.silver, "result", predicate)
    after = files().groupBy("c_mktsegment").agg(F.sort_array(F.collect_set("file")).alias("files"))
    kept = after.join(spark.read.parquet(f"{ws.scratch}/files"), ["c_mktsegment", "files"])
    totals = ws.result(ws.silver, "result").groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total")
    )
    kept = kept.select("c_mktsegment", F.lit(True).alias("kept"))
    return totals.join(kept, "c_mktsegment", "left").select(
        "c_mktsegment", "n", "total", F.coalesce("kept", F.lit(False)).alias("is_untouched")
    )


@checks.add("""
SELECT c_custkey, c_nationkey, n_orders, c_acctbal + CASE WHEN c_nationkey < 5 THEN 100 ELSE 0 END AS c_acctbal
FROM customer JOIN (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey) o
ON c_custkey = o_custkey WHERE c_acctbal >= 0 OR c_nationkey < 5
""")
def load_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed target can be joined by its key after a load, a merge and a delete."""
    ws = Workspace(spark, sf_dir, "load_merge_bucketed")
    ws.land("customer", "orders")
    ws.site.create_schema(spark, ws.silver)
    name = ws.site.table(ws.silver, "result")
    spark.sql(
        f"CREATE TABLE {name} (c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE) USING parquet "
        "CLUSTERED BY (c_custkey) SORTED BY (c_custkey) INTO 8 BUCKETS"
    )
    ws.load_silver("SELECT c_custkey, c_nationkey, c_acctbal FROM customer", LOAD_TYPE="FULL")
    delete_rows(spark, ws.site, ws.silver, "result", "c_acctbal < 0")
    ws.load_silver(
        "SELECT c_custkey, c_nationkey, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_nationkey < 5",
        LOAD_TYPE="MERGE",
        MERGE_KEYS="c_custkey",
    )
    orders = ws.result(ws.bronze, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    orders = orders.agg(F.count("*").alias("n_orders"))
    return ws.result(ws.silver, "result").join(orders, "c_custkey").select(
        "c_custkey", "c_nationkey", "n_orders", "c_acctbal"
    )


@checks.add("""
SELECT c_custkey, c_mktsegment, c_acctbal + CASE WHEN c_nationkey < 5 THEN 100 ELSE 0 END AS c_acctbal,
       TRUE AS is_partitioned
FROM customer
""")
def load_merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that is partitioned stays so when a merge rewrites it."""
    ws = Workspace(spark, sf_dir, "load_merge_partitioned")
    ws.land("customer")
    ws.site.create_schema(spark, ws.silver)
    name = ws.site.table(ws.silver, "result")
    spark.sql(
        f"CREATE TABLE {name} (c_custkey BIGINT, c_acctbal DOUBLE, c_mktsegment STRING) "
        "USING parquet PARTITIONED BY (c_mktsegment)"
    )
    columns = "c_custkey, c_mktsegment, c_acctbal"
    ws.load_silver(f"SELECT {columns} FROM customer", LOAD_TYPE="APPEND")
    ws.load_silver(
        "SELECT c_custkey, c_mktsegment, c_acctbal + 100 AS c_acctbal FROM customer "
        "WHERE c_nationkey < 5",
        LOAD_TYPE="MERGE",
        MERGE_KEYS="c_custkey",
    )
    segments = spark.sql(f"SHOW PARTITIONS {name}").count()
    return ws.result(ws.silver, "result").selectExpr(
        "c_custkey", "c_mktsegment", "c_acctbal", f"{segments} > 1 AS is_partitioned"
    )


@checks.add("""
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
       c_mktsegment
FROM customer
UNION ALL
SELECT -1 - c_custkey AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def load_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MERGE on one key: some customers change, some are new."""
    ws = Workspace(spark, sf_dir, "load_merge")
    columns = "c_name, c_nationkey, c_acctbal, c_mktsegment"
    ws.transform(f"SELECT c_custkey, {columns} FROM customer", "customer",
                 LOAD_TYPE="MERGE", MERGE_KEYS="c_custkey")
    ws.load_silver(
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment "
        "FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL "
        f"SELECT -1 - c_custkey, {columns} FROM customer WHERE c_mktsegment = 'MACHINERY'",
        LOAD_TYPE="MERGE",
        MERGE_KEYS=" C_CUSTKEY ",
    )
    return ws.result(ws.silver, "result")


@checks.add("""
SELECT conv_id, turn, CASE WHEN role = 'user' THEN UPPER(role) ELSE role END AS role, text
FROM conversations
""")
def load_merge_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DELTA with two keys; the second source lacks a column, which is kept."""
    ws = Workspace(spark, sf_dir, "load_merge_composite")
    ws.transform("SELECT conv_id, turn, role, text FROM conversations", "conversations",
                 LOAD_TYPE="DELTA", MERGE_KEYS="conv_id, turn")
    ws.load_silver(
        "SELECT conv_id, turn, UPPER(role) AS role FROM conversations WHERE role = 'user'",
        LOAD_TYPE="DELTA",
        MERGE_KEYS="conv_id, turn",
    )
    return ws.result(ws.silver, "result")


@checks.add("""
SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, o_totalprice FROM orders
UNION ALL
SELECT NULL AS k, o_totalprice FROM orders WHERE o_orderstatus = 'P'
""")
def load_merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows merged twice: a third of the keys is NULL, and those rows double."""
    ws = Workspace(spark, sf_dir, "load_merge_null_keys")
    query = (
        "SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, o_totalprice FROM orders"
    )
    ws.transform(query, "orders", LOAD_TYPE="MERGE", MERGE_KEYS="k")
    ws.load_silver(query, LOAD_TYPE="MERGE", MERGE_KEYS="k")
    return ws.result(ws.silver, "result")


@checks.add("""
SELECT l_returnflag, l_linenumber, l_partkey, l_orderkey FROM lineitem WHERE l_returnflag <> 'A'
UNION ALL
SELECT 'A' AS l_returnflag, l_linenumber, -1 AS l_partkey, l_orderkey
FROM lineitem WHERE l_returnflag = 'A'
UNION ALL
SELECT 'X' AS l_returnflag, l_linenumber, l_partkey, l_orderkey
FROM lineitem WHERE l_returnflag = 'N'
""")
def load_merge_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change meets a third of the target, and a third more rows share one new key."""
    ws = Workspace(spark, sf_dir, "load_merge_hot_key")
    ws.transform("SELECT l_returnflag, l_linenumber, l_partkey, l_orderkey FROM lineitem",
                 "lineitem", LOAD_TYPE="MERGE", MERGE_KEYS="l_returnflag")
    # The change for 'A' names no order, so the target's order keys stay.
    ws.load_silver(
        "SELECT 'A' AS l_returnflag, -1L AS l_partkey",
        LOAD_TYPE="MERGE",
        MERGE_KEYS="l_returnflag",
    )
    ws.load_silver(
        "SELECT 'X' AS l_returnflag, l_linenumber, l_partkey, l_orderkey FROM lineitem "
        "WHERE l_returnflag = 'N'",
        LOAD_TYPE="MERGE",
        MERGE_KEYS="l_returnflag",
    )
    return ws.result(ws.silver, "result")


@checks.add("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem")
def load_merge_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first MERGE into a new table keeps rows that share a key."""
    ws = Workspace(spark, sf_dir, "load_merge_first")
    return ws.transform(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem",
        "lineitem",
        LOAD_TYPE="MERGE",
        MERGE_KEYS="l_orderkey,l_linenumber",
    )


@checks.add("""
SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
GROUP BY l_orderkey HAVING COUNT(*) > 1
""")
def merge_conflict_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys on which a merge of all lines into all orders would be ambiguous."""
    ws = Workspace(spark, sf_dir, "merge_conflict_keys")
    orders = ws.read("orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return conflicting_keys(orders, ws.read("lineitem"), ["l_orderkey"])


@checks.add("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def load_delta_no_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DELTA without keys replaces, here twice."""
    ws = Workspace(spark, sf_dir, "load_delta_no_keys")
    query = "SELECT s_suppkey, s_name, s_acctbal FROM supplier"
    ws.transform(query, "supplier", LOAD_TYPE="DELTA", MERGE_KEYS="  ")
    ws.run("TRANSFORM_L1")
    return ws.result(ws.silver, "result")


@checks.add("SELECT p_partkey, p_brand, p_size FROM part")
def load_unknown_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown load type, and a blank one, replace."""
    ws = Workspace(spark, sf_dir, "load_unknown_mode")
    query = "SELECT p_partkey, p_brand, p_size FROM part"
    ws.transform(query, "part", LOAD_TYPE="WHATEVER")
    ws.load_silver(query, LOAD_TYPE="")
    return ws.result(ws.silver, "result")


@checks.add("SELECT event_id, event_type, value FROM events WHERE (event_type = 'error') IS NOT TRUE")
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "delete_where")
    ws.land("events")
    delete_rows(
        spark, ws.site, ws.bronze, "events", "event_type = :kind", args={"kind": "error"}
    )
    return ws.result(ws.bronze, "events").select("event_id", "event_type", "value")


# Runs


@checks.add("""
SELECT o_orderkey, 'LINEAGE_L0' AS _etl_group_id, 'L0' AS _etl_layer, 'test' AS _etl_env,
       TRUE AS is_stamped
FROM orders
""")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "lineage_columns")
    ws.l0("LINEAGE_L0", {"SOURCE_URL": ws.path("orders"), "TARGET_TABLE": "orders"})
    ws.run(" lineage_l0 ", env=" test ")
    return ws.table(ws.bronze, "orders").select(
        "o_orderkey",
        "_etl_group_id",
        "_etl_layer",
        "_etl_env",
        F.col("_etl_load_ts").isNotNull().alias("is_stamped"),
    )


_AUDITED = """
SELECT '{group}' AS "DATA_FLOW_GROUP_ID", 'customer' AS "TARGET_TABLE", 'L0' AS "ETL_LAYER",
       'SUCCESS' AS "STATUS", COUNT(*) AS "ROWS_LOADED" FROM customer
UNION ALL
SELECT '{group}', 'lineitem', 'L0', 'SUCCESS', COUNT(*) FROM lineitem
UNION ALL
SELECT '{group}', 'orders', 'L0', 'SUCCESS', COUNT(*) FROM orders
"""


def _audited(ws: Workspace, group: str) -> DataFrame:
    return audit.history(ws.spark, group, ws.site).select(
        "DATA_FLOW_GROUP_ID", "TARGET_TABLE", "ETL_LAYER", "STATUS", "ROWS_LOADED"
    )


@checks.add(_AUDITED.format(group="TOGETHER_L0"))
def run_targets_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Independent targets of a layer loading at the same time, as their audit rows tell."""
    ws = Workspace(spark, sf_dir, "run_targets_together")
    tables = ("orders", "customer", "lineitem")
    ws.l0("TOGETHER_L0", *({"SOURCE_URL": ws.path(t), "TARGET_TABLE": t} for t in tables))
    ws.run("TOGETHER_L0", parallelism=3)
    return _audited(ws, "TOGETHER_L0")


@checks.add(_AUDITED.format(group="ISOLATED_L0") + """
UNION ALL SELECT 'ISOLATED_L0', 'missing', 'L0', 'FAILED', 0
""")
def run_failure_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that fails is audited, and the ones after it still run."""
    from strata import LayerFailed

    ws = Workspace(spark, sf_dir, "run_failure_isolated")
    tables = ("orders", "missing", "customer", "lineitem")
    ws.l0("ISOLATED_L0", *({"SOURCE_URL": ws.path(t), "TARGET_TABLE": t} for t in tables))
    try:
        ws.run("ISOLATED_L0")
    except LayerFailed:
        return _audited(ws, "ISOLATED_L0")
    raise AssertionError("the missing source went unnoticed")


@checks.add("SELECT o_orderkey, o_totalprice FROM orders")
def run_one_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run restricted to one target leaves the group's other targets alone."""
    ws = Workspace(spark, sf_dir, "run_one_target")
    tables = ("orders", "lineitem")
    ws.l0("ONE_L0", *({"SOURCE_URL": ws.path(t), "TARGET_TABLE": t} for t in tables))
    ws.run("ONE_L0", table=" orders ")
    if spark.catalog.tableExists(ws.site.table(ws.bronze, "lineitem")):
        raise AssertionError("lineitem was not asked for")
    return ws.result(ws.bronze, "orders").select("o_orderkey", "o_totalprice")


# Views


@checks.add("""
SELECT o_orderstatus, COUNT(*) AS n_orders, ROUND(SUM(o_totalprice), 2) AS revenue
FROM orders GROUP BY o_orderstatus
""")
def gold_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A VIEW row, its query wrapped in CREATE OR REPLACE VIEW."""
    ws = Workspace(spark, sf_dir, "gold_view")
    ws.land("orders")
    ws.l2(
        "STATUS_L2",
        {
            "SOURCE_OBJ_SCHEMA": ws.bronze,
            "SOURCE_OBJ_NAME": "orders",
            "TARGET_TABLE": "order_status",
            "LOAD_TYPE": "view",
            "TRANSFORMATION_QUERY": f"CREATE OR REPLACE VIEW {ws.gold}.order_status AS\n"
            "SELECT o_orderstatus, COUNT(*) AS n_orders, ROUND(SUM(o_totalprice), 2) AS revenue "
            "FROM orders GROUP BY o_orderstatus",
        },
    )
    publish(spark, "STATUS_L2", site=ws.site)
    return ws.table(ws.gold, "order_status")


@checks.add("""
SELECT user_id, COUNT(*) AS n_events, ROUND(SUM(value), 2) AS total_value
FROM events WHERE event_type <> 'error' GROUP BY user_id
""")
def gold_view_over_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIEW rows of both layers; the L2 dataset reads the L1 dataset."""
    ws = Workspace(spark, sf_dir, "gold_view_over_view")
    ws.land("events")
    ws.l1(
        "USERS",
        {
            "SOURCE_OBJ_NAME": "events",
            "TARGET_TABLE": "good_events",
            "LOAD_TYPE": "VIEW",
            "TRANSFORMATION_QUERY": "SELECT * FROM events WHERE event_type <> 'error'",
        },
    )
    ws.l2(
        "USERS",
        {
            "SOURCE_OBJ_NAME": "good_events",
            "TARGET_TABLE": "users",
            "LOAD_TYPE": "VIEW",
            "TRANSFORMATION_QUERY": "SELECT user_id, COUNT(*) AS n_events, "
            f"ROUND(SUM(value), 2) AS total_value FROM {ws.silver}.good_events GROUP BY user_id",
        },
    )
    publish(spark, "users", site=ws.site)
    return ws.table(ws.gold, "users")


@checks.add("""
SELECT o_orderstatus, COUNT(*) AS n_orders FROM orders WHERE o_totalprice > 1000
GROUP BY o_orderstatus
""")
def gold_view_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A VIEW row that reads a later-named one of its own layer."""
    ws = Workspace(spark, sf_dir, "gold_view_in_order")
    ws.land("orders")
    ws.l2(
        "ORDER_L2",
        {
            "SOURCE_OBJ_SCHEMA": ws.gold,
            "TARGET_TABLE": "a_total",
            "LOAD_TYPE": "VIEW",
            "TRANSFORMATION_QUERY": "SELECT o_orderstatus, COUNT(*) AS n_orders FROM b_large "
            "GROUP BY o_orderstatus",
        },
        {
            "SOURCE_OBJ_SCHEMA": ws.bronze,
            "TARGET_TABLE": "b_large",
            "LOAD_TYPE": "VIEW",
            "TRANSFORMATION_QUERY": "SELECT * FROM orders WHERE o_totalprice > 1000",
        },
    )
    publish(spark, "ORDER_L2", site=ws.site)
    return ws.table(ws.gold, "a_total")
