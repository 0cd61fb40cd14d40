"""Transformation queries: SQL in a control row, run by Spark as a silver or gold load.

The queries are written for keys of any frequency: what is grouped is aggregated before it is
joined, the existence side of a semi or anti join holds each key once, and ranks are cut before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acceptance import Checks
from acceptance.workspace import Workspace

checks = Checks()


@checks.add("""
SELECT o_orderkey, o_custkey, o_totalprice AS price, o_orderpriority,
       TRUE AS is_loaded, TRUE AS is_refined
FROM orders WHERE o_totalprice IS NOT NULL
""")
def silver_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection, renaming, lineage of the layer below, computed column, null filter."""
    ws = Workspace(spark, sf_dir, "silver_filter")
    refined = ws.transform(
        "SELECT o_orderkey, o_custkey, o_totalprice AS price, o_orderpriority, "
        "_etl_load_ts AS bronze_ts, current_timestamp() AS silver_ts "
        f"FROM {ws.bronze}.orders WHERE o_totalprice IS NOT NULL",
        "orders",
    )
    return refined.selectExpr(
        "o_orderkey", "o_custkey", "price", "o_orderpriority",
        "bronze_ts IS NOT NULL AS is_loaded", "silver_ts >= bronze_ts AS is_refined",
    )


@checks.add("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def gold_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality with a double-quoted literal, columns in another case."""
    ws = Workspace(spark, sf_dir, "gold_filter")
    ws.transform("SELECT * FROM customer", "customer")
    ws.l2(
        "SEGMENT_L2",
        {
            "TARGET_TABLE": "building",
            "TRANSFORMATION_QUERY": "SELECT c_custkey, c_name, c_mktsegment "
            f'FROM {ws.silver}.result WHERE C_MktSegment = "BUILDING"',
        },
    )
    ws.run("SEGMENT_L2")
    return ws.result(ws.gold, "building")


@checks.add("""
SELECT n.n_name, COUNT(*) AS n_orders, ROUND(SUM(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name
""")
def gold_join_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "gold_join_agg")
    ws.land("orders", "customer", "nation")
    ws.l2(
        "REVENUE_L2",
        {
            "SOURCE_OBJ_SCHEMA": ws.bronze,
            "TARGET_TABLE": "revenue",
            "TRANSFORMATION_QUERY": """
                SELECT n_name, SUM(n_orders) AS n_orders, ROUND(SUM(revenue), 2) AS revenue
                FROM (SELECT o_custkey, COUNT(*) AS n_orders, SUM(o_totalprice) AS revenue
                      FROM orders GROUP BY o_custkey) o
                JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey
                GROUP BY n_name
            """,
        },
    )
    ws.run("REVENUE_L2")
    return ws.result(ws.gold, "revenue")


@checks.add("""
SELECT c_custkey FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def xt_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_semi").transform(
        "SELECT c_custkey FROM customer LEFT SEMI JOIN "
        "(SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') "
        "ON c_custkey = o_custkey",
        "customer",
        "orders",
    )


@checks.add("""
SELECT c_custkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o
                  WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
""")
def xt_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_anti").transform(
        "SELECT c_custkey FROM customer LEFT ANTI JOIN "
        "(SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) "
        "ON c_custkey = o_custkey",
        "customer",
        "orders",
    )


@checks.add("""
SELECT p.p_partkey, p.p_brand, l.n_lines
FROM part p LEFT JOIN (SELECT l_partkey, COUNT(*) AS n_lines FROM lineitem
                       WHERE l_returnflag = 'R' GROUP BY l_partkey) l ON p.p_partkey = l.l_partkey
""")
def xt_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_left_join").transform(
        "SELECT p_partkey, p_brand, n_lines FROM part LEFT JOIN "
        "(SELECT l_partkey, COUNT(*) AS n_lines FROM lineitem WHERE l_returnflag = 'R' "
        "GROUP BY l_partkey) ON p_partkey = l_partkey",
        "part",
        "lineitem",
    )


@checks.add("""
SELECT c_nationkey, c_custkey, c_acctbal, rk FROM (
    SELECT c_nationkey, c_custkey, c_acctbal,
           CAST(ROW_NUMBER() OVER (PARTITION BY c_nationkey
                                   ORDER BY c_acctbal DESC, c_custkey) AS INT) AS rk
    FROM customer) q WHERE rk <= 3
""")
def xt_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_window_topk").transform(
        "SELECT * FROM (SELECT c_nationkey, c_custkey, c_acctbal, "
        "ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rk "
        "FROM customer) WHERE rk <= 3",
        "customer",
    )


@checks.add("""
SELECT user_id, event_id,
       ROUND(SUM(value) OVER (PARTITION BY user_id ORDER BY event_id
                              ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS s3
FROM events
""")
def xt_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding sum over each user's events, whatever a user's share of them.

    A window by user and block of ids is small. Its first rows also need the last two rows that
    the user has before the block: of every block, the last two rows are carried to the next ones,
    so that the window by user alone sees two rows a block. Carried rows don't come out.
    """
    return Workspace(spark, sf_dir, "xt_running_sum").transform(
        """
        WITH rows_of AS (
            SELECT user_id, event_id, value, event_id DIV 10000 AS block FROM events
        ), tails AS (
            SELECT user_id, event_id, value, block FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, block
                                             ORDER BY event_id DESC) AS from_end FROM rows_of)
            WHERE from_end <= 2
        ), before AS (
            SELECT user_id, block,
                   LAG(block, 1) OVER by_user AS last_block,
                   LAG(STRUCT(event_id, value), 1) OVER by_user AS last,
                   LAG(STRUCT(event_id, value), 2) OVER by_user AS second_last
            FROM tails WINDOW by_user AS (PARTITION BY user_id ORDER BY event_id)
        ), carried AS (
            SELECT user_id, block, INLINE(FILTER(ARRAY(last, second_last), x -> x IS NOT NULL))
                   AS (event_id, value)
            FROM before WHERE last_block < block
        ), all_rows AS (
            SELECT user_id, block, event_id, value, FALSE AS is_carried FROM rows_of
            UNION ALL SELECT user_id, block, event_id, value, TRUE FROM carried
        )
        SELECT user_id, event_id, s3 FROM (
            SELECT user_id, event_id, is_carried, ROUND(SUM(value) OVER (
                       PARTITION BY user_id, block ORDER BY event_id
                       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS s3
            FROM all_rows)
        WHERE NOT is_carried
        """,
        "events",
    )


@checks.add("""
SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem
GROUP BY ROLLUP(l_returnflag, l_linestatus)
""")
def xt_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_rollup").transform(
        "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem "
        "GROUP BY ROLLUP(l_returnflag, l_linestatus)",
        "lineitem",
    )


@checks.add("""
SELECT l_returnflag, l_linestatus, l_linenumber, GROUPING(l_returnflag) AS no_flag,
       ROUND(SUM(l_quantity), 2) AS quantity
FROM lineitem
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())
""")
def xt_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_grouping_sets").transform(
        "SELECT l_returnflag, l_linestatus, l_linenumber, "
        "CAST(GROUPING(l_returnflag) AS BIGINT) AS no_flag, "
        "ROUND(SUM(l_quantity), 2) AS quantity FROM lineitem "
        "GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())",
        "lineitem",
    )


@checks.add("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey AS k FROM supplier")
def xt_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_intersect").transform(
        "SELECT DISTINCT c_nationkey AS k FROM customer "
        "INTERSECT SELECT DISTINCT s_nationkey AS k FROM supplier",
        "customer",
        "supplier",
    )


@checks.add("""
SELECT c_custkey AS k FROM customer
EXCEPT SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'
""")
def xt_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_except").transform(
        "SELECT c_custkey AS k FROM customer "
        "EXCEPT SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'",
        "customer",
        "orders",
    )


@checks.add("""
SELECT s_nationkey AS k, 'supplier' AS side FROM supplier
UNION ALL SELECT c_nationkey AS k, 'customer' AS side FROM customer
""")
def xt_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Workspace(spark, sf_dir, "xt_union_all").transform(
        "SELECT s_nationkey AS k, 'supplier' AS side FROM supplier "
        "UNION ALL SELECT c_nationkey AS k, 'customer' AS side FROM customer",
        "customer",
        "supplier",
    )


@checks.add("""
WITH spend AS (SELECT o_custkey, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey)
SELECT o_custkey, total FROM spend ORDER BY total DESC, o_custkey LIMIT 25
""")
def xt_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORDER BY with LIMIT in a query that starts with WITH."""
    return Workspace(spark, sf_dir, "xt_topk").transform(
        "WITH spend AS (SELECT o_custkey, ROUND(SUM(o_totalprice), 2) AS total FROM orders "
        "GROUP BY o_custkey) "
        "SELECT o_custkey, total FROM spend ORDER BY total DESC, o_custkey LIMIT 25",
        "orders",
    )
