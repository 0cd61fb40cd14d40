"""Runs of groups, views, the audit log and cleanup."""

import threading

import pytest

from strata import LayerFailed, cleanup_group, publish, run_group, write_table
from strata.plans import audit, config, runner, views
from strata.schemas import AUDIT_TABLE, DETAIL_TABLES, GROUP, HEADER_TABLE

TITANIC = """PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Fare,Embarked
1,0,3,"Braund, Mr. Owen",male,22,1,0,7.25,S
2,1,1,"Cumings, Mrs. John",female,38,1,0,71.2833,C
3,1,3,"Heikkinen, Miss. Laina",female,26,0,0,7.925,S
4,1,1,"Futrelle, Mrs. Jacques",female,35,1,0,53.1,S
5,0,3,"Allen, Mr. William",male,35,0,0,8.05,S
6,0,3,"Moran, Mr. James",male,,0,0,8.4583,Q
7,0,1,"McCarthy, Mr. Timothy",male,54,0,0,51.8625,S
8,1,3,"O'Dwyer, Miss. Ellen",female,,0,0,7.8792,Q
"""


@pytest.fixture
def landed(tmp_path):
    (tmp_path / "titanic.csv").write_text(TITANIC)
    return str(tmp_path / "titanic.csv")


@pytest.fixture
def audited(spark, site):
    def read(group):
        history = audit.history(spark, group, site).orderBy("ETL_LAYER", "TARGET_TABLE")
        return [(r.ETL_LAYER, r.TARGET_TABLE, r.STATUS, r.ROWS_LOADED) for r in history.collect()]

    return read


def row(group, schema, table, load_type="FULL", **more):
    return {GROUP: group, "TARGET_SCHEMA": schema, "TARGET_TABLE": table,
            "LOAD_TYPE": load_type, "IS_ACTIVE": "Y"} | more


def test_three_layers_from_a_csv_file(spark, site, bronze, silver, gold, landed, rows, audited):
    group = "FINANCE"
    config.upsert_l0(spark, [row(group, bronze, "passengers", SOURCE_URL=landed)], site)
    config.upsert_l1(
        spark,
        [row(group, silver, "passengers", SOURCE_OBJ_SCHEMA=bronze, SOURCE_OBJ_NAME="passengers",
             PARTITION_BY="Pclass",
             TRANSFORMATION_QUERY="SELECT PassengerId, Name, Sex, Age, _etl_load_ts AS bronze_ts, "
             f"current_timestamp() AS silver_ts FROM {bronze}.passengers WHERE Age IS NOT NULL")],
        site,
    )
    config.upsert_l2(
        spark,
        [row(group, gold, "women", SOURCE_OBJ_SCHEMA=silver, SOURCE_OBJ_NAME="passengers",
             TRANSFORMATION_QUERY='SELECT PassengerId, Name, sex FROM passengers '
             'WHERE sex = "female"')],
        site,
    )
    before = spark.catalog.currentDatabase()
    results = run_group(spark, " finance ", site=site)
    assert [(r.layer, r.status, r.rows, r.message) for r in results] == [
        ("L0", "SUCCESS", 8, "8 rows"), ("L1", "SUCCESS", 6, "6 rows"),
        ("L2", "SUCCESS", 3, "3 rows"),
    ]
    assert spark.catalog.currentDatabase() == before
    women = spark.table(site.table(gold, "women"))
    assert rows(women, "PassengerId", "Name") == [
        (2, "Cumings, Mrs. John"), (3, "Heikkinen, Miss. Laina"), (4, "Futrelle, Mrs. Jacques"),
    ]
    assert women.columns == ["PassengerId", "Name", "sex", "_etl_group_id", "_etl_layer",
                             "_etl_env", "_etl_load_ts"]
    assert women.select("_etl_group_id", "_etl_layer", "_etl_env").distinct().collect() == [
        ("FINANCE", "L2", "dev")
    ]
    assert audited(group) == [
        ("L0", "passengers", "SUCCESS", 8), ("L1", "passengers", "SUCCESS", 6),
        ("L2", "women", "SUCCESS", 3),
    ]
    (first, *_) = spark.table(site.control(AUDIT_TABLE)).collect()
    assert first.START_TIME <= first.END_TIME <= first.LOAD_TS


def test_a_failed_load_does_not_stop_its_layer_but_the_next(
    spark, site, bronze, silver, landed, audited
):
    group = "MIXED"
    config.upsert_l0(
        spark,
        [row(group, bronze, "a_ok", SOURCE_URL=landed),
         row(group, bronze, "b_bad", SOURCE_URL="/nowhere/it's.csv"),
         row(group, bronze, "c_ok", SOURCE_URL=landed),
         row(group, "", "skipped", SOURCE_URL=landed)],
        site,
    )
    config.upsert_l1(spark, [row(group, silver, "d", TRANSFORMATION_QUERY="SELECT 1 AS x")], site)
    with pytest.raises(LayerFailed, match="L0 of MIXED had failures .b_bad"):
        run_group(spark, group, site=site)
    assert audited(group) == [
        ("L0", "a_ok", "SUCCESS", 8), ("L0", "b_bad", "FAILED", 0), ("L0", "c_ok", "SUCCESS", 8),
    ]
    (failed,) = audit.history(spark, group, site).where("STATUS = 'FAILED'").collect()
    assert failed.MESSAGE.startswith("AnalysisException: [PATH_NOT_FOUND]")
    assert "it's.csv" in failed.MESSAGE and len(failed.MESSAGE) <= 400
    assert [tuple(r) for r in audit.summary(spark, group, site).collect()] == [("L0", 2, 1, False)]


def test_suffix_selects_the_layer_and_empty_layers_pass(spark, site, bronze, silver, audited):
    # Configured in L0, named for L1: nothing runs.
    config.upsert_l0(spark, [row("AUTO_L1", bronze, "t", SOURCE_URL="/nowhere")], site)
    assert run_group(spark, "AUTO_L1", site=site) == []
    assert audited("AUTO_L1") == []
    with pytest.raises(ValueError, match="GROUP_ID is required"):
        run_group(spark, " ", site=site)


def test_l0_rows_without_keys(spark, site, bronze, landed, audited, rows):
    """L0 has no MERGE_KEYS column: MERGE fails, DELTA replaces."""
    config.upsert_l0(
        spark,
        [row("KEYS_L0", bronze, "merged", "MERGE", SOURCE_URL=landed),
         row("KEYS_L0", bronze, "replaced", "delta", SOURCE_URL=landed)],
        site,
    )
    for _ in range(2):
        with pytest.raises(LayerFailed, match="merged"):
            run_group(spark, "KEYS_L0", site=site)
    assert audited("KEYS_L0") == [
        ("L0", "merged", "FAILED", 0), ("L0", "merged", "FAILED", 0),
        ("L0", "replaced", "SUCCESS", 8), ("L0", "replaced", "SUCCESS", 8),
    ]


def test_sources_that_are_tables(spark, site, bronze, silver, audited):
    write_table(spark.range(4), silver, "given", site=site)
    source = {"SOURCE_OBJ_SCHEMA": silver, "SOURCE_OBJ_NAME": "given"}
    config.upsert_l0(
        spark,
        [row("TAB_L0", bronze, "a", " Delta ", SOURCE_URL=" ", **source),
         row("TAB_L0", bronze, "b", "FULL", **source)],
        site,
    )
    with pytest.raises(LayerFailed, match="b"):
        run_group(spark, "TAB_L0", site=site)
    assert audited("TAB_L0") == [("L0", "a", "SUCCESS", 4), ("L0", "b", "FAILED", 0)]
    config.upsert_l1(spark, [row("TAB_L1", silver, "copy", **source)], site)
    assert run_group(spark, "TAB_L1", site=site)[0].rows == 4


def test_only_the_named_table_runs(spark, site, silver, audited):
    config.upsert_l1(
        spark,
        [row("ONE_L1", silver, name, TRANSFORMATION_QUERY="SELECT 1 AS x") for name in "ab"],
        site,
    )
    run_group(spark, "ONE_L1", table="b", site=site)
    assert [entry[1] for entry in audited("ONE_L1")] == ["b"]
    run_group(spark, "ONE_L1", table="ALL", site=site)
    assert [entry[1] for entry in audited("ONE_L1")] == ["a", "b", "b"]


def test_targets_load_at_the_same_time(spark, site, silver, audited, monkeypatch):
    names = [f"t{i}" for i in range(4)]
    config.upsert_l1(
        spark,
        [row("PAR_L1", silver, n, TRANSFORMATION_QUERY=f"SELECT {i} AS x")
         for i, n in enumerate(names)],
        site,
    )
    meeting = threading.Barrier(4, timeout=60)
    resolve = runner.resolve_source

    def wait_then_resolve(*args):
        meeting.wait()
        return resolve(*args)

    monkeypatch.setattr(runner, "resolve_source", wait_then_resolve)
    run_group(spark, "PAR_L1", site=site, parallelism=4)
    assert audited("PAR_L1") == [("L1", n, "SUCCESS", 1) for n in names]


def test_reads_after_a_parallel_run_see_it(spark, site, silver):
    """Loads run in the caller's session, so nothing that it keeps goes stale."""
    config.upsert_l1(
        spark,
        [row("AGAIN_L1", silver, "added", "APPEND", TRANSFORMATION_QUERY="SELECT id FROM range(10)"),
         row("AGAIN_L1", silver, "full", TRANSFORMATION_QUERY="SELECT id FROM range(7)")],
        site,
    )
    added, full = site.table(silver, "added"), site.table(silver, "full")
    for turn in (1, 2, 3):
        run_group(spark, "AGAIN_L1", site=site, parallelism=2)
        assert spark.table(added).count() == 10 * turn
        assert spark.table(full).count() == 7
        assert audit.history(spark, "AGAIN_L1", site).count() == 2 * turn


def test_parallel_loads_see_the_sessions_functions_and_views(spark, site, silver, rows):
    spark.udf.register("plus_one", lambda x: x + 1, "int")
    spark.sql("SELECT 41 AS x").createOrReplaceTempView("given")
    try:
        config.upsert_l1(
            spark,
            [row("SEES_L1", silver, n, TRANSFORMATION_QUERY="SELECT plus_one(x) AS y FROM given")
             for n in ("a", "b", "c")],
            site,
        )
        run_group(spark, "SEES_L1", site=site, parallelism=3)
        assert rows(spark.table(site.table(silver, "c")), "y") == [(42,)]
    finally:
        spark.catalog.dropTempView("given")


def test_rows_with_one_target_load_in_turn(spark, site, bronze, tmp_path):
    for n in range(4):
        spark.range(n, n + 1).write.parquet(str(tmp_path / f"in{n}"))
    config.upsert_l0(
        spark,
        [row("ONE_L0", bronze, "T" if n % 2 else "t", "APPEND", SOURCE_URL=str(tmp_path / f"in{n}"),
             FILE_FORMAT="parquet", SOURCE_OBJ_NAME=str(n)) for n in range(4)],
        site,
    )
    results = run_group(spark, "ONE_L0", site=site, parallelism=4)
    assert len(results) == len(spark.table(site.control(DETAIL_TABLES["L0"])).where("DATA_FLOW_GROUP_ID = 'ONE_L0'").collect())
    assert spark.table(site.table(bronze, "t")).count() == max(r.rows for r in results)


def test_lineage_replaces_a_column_where_it_stands(spark):
    df = runner.add_lineage(spark.sql("SELECT 1 AS _ETL_LAYER, 2 AS x"), "G", "L0", "dev")
    assert [c.lower() for c in df.columns] == ["_etl_layer", "x", "_etl_group_id", "_etl_env",
                                               "_etl_load_ts"]
    assert df.first()[0] == "L0"


def test_a_lost_audit_log_does_not_fail_the_load(spark, site, silver):
    config.upsert_l1(
        spark, [row("NOLOG_L1", silver, "t", TRANSFORMATION_QUERY="SELECT 1 AS x")], site
    )
    spark.sql(f"DROP TABLE {site.control(AUDIT_TABLE)}")
    assert run_group(spark, "NOLOG_L1", site=site)[0].status == "SUCCESS"


# Views


def test_to_select(spark):
    for query, select in (
        ("select 1;", "select 1"),
        (" CREATE OR\nREPLACE view `g`.v AS\n SELECT 1 ", "SELECT 1"),
        ("CREATE VIEW `a-b`.`v w` AS WITH q AS (SELECT 1) TABLE q", "WITH q AS (SELECT 1) TABLE q"),
        ("CREATE VIEW v (`x y`) AS SELECT 1", "SELECT * FROM (SELECT 1) AS `_view` (`x y`)"),
    ):
        assert views.to_select(spark, query, "v") == select
    for text in ("DROP TABLE x", "INSERT INTO t VALUES (1)", "CREATE TABLE t (a INT)"):
        with pytest.raises(ValueError, match="'v' needs a query"):
            views.to_select(spark, text, "v")


def test_names_that_a_query_reads(spark):
    query = """WITH q AS (SELECT * FROM A JOIN s.`B-1` USING (x))
        SELECT (SELECT max(y) FROM c) FROM q WHERE z IN (SELECT z FROM d) UNION SELECT 1 FROM E"""
    assert views.reads(spark, query) == {"a", "s.b-1", "c", "d", "e"}


def test_publish_views(spark, site, bronze, silver, gold, rows):
    write_table(spark.range(6), bronze, "ids", site=site)
    source = {"SOURCE_OBJ_SCHEMA": bronze, "SOURCE_OBJ_NAME": "ids"}
    config.upsert_l1(
        spark,
        [row("V", silver, "even", "view", TRANSFORMATION_QUERY="SELECT id FROM ids WHERE id % 2 = 0",
             **source),
         row("V", silver, "no_query", "VIEW", **source),
         row("V", silver, "a_load", "FULL", TRANSFORMATION_QUERY="SELECT 1")],
        site,
    )
    config.upsert_l2(
        spark,
        [row("V", gold, "total", "VIEW", SOURCE_OBJ_SCHEMA=silver, SOURCE_OBJ_NAME="even",
             TRANSFORMATION_QUERY=f"CREATE OR REPLACE VIEW {gold}.total AS "
             f"SELECT sum(id) AS total FROM {silver}.even")],
        site,
    )
    assert rows(views.plan(spark, "v", site)) == [(2, 1, "ALL", silver)]
    for _ in range(2):
        assert publish(spark, "v", site=site) == [f"{silver}.even", f"{gold}.total"]
    assert rows(spark.table(site.table(gold, "total"))) == [(6,)]
    details = {r.col_name: r.data_type for r in
               spark.sql(f"DESCRIBE TABLE EXTENDED {site.table(gold, 'total')}").collect()}
    assert f"quality={gold}" in details["Table Properties"]
    assert details["Comment"].startswith("GROUP_ID=V | ")
    assert audit.history(spark, "v", site).isEmpty()
    assert publish(spark, "v", "l2", site) == [f"{gold}.total"]
    with pytest.raises(ValueError, match="not in 'L0'"):
        publish(spark, "v", "L0", site)
    with pytest.raises(LookupError, match="NONE_L2 has no active row"):
        publish(spark, "none_l2", site=site)
    assert views.plan(spark, "none", site).isEmpty()


def test_view_settings_come_from_the_session(spark, site, gold):
    config.upsert_l2(
        spark, [row("CONF_L2", gold, "one", "VIEW", TRANSFORMATION_QUERY="SELECT 1 AS x")], site
    )
    spark.conf.set("GROUP_ID", "other")
    spark.conf.set("pipelines.GROUP_ID", " conf_l2 ")
    try:
        assert views.setting(spark, "GROUP_ID") == "CONF_L2"
        assert views.setting(spark, "RUN_LAYER", "all") == "ALL"
        assert publish(spark, site=site) == [f"{gold}.one"]
        assert [tuple(r) for r in views.plan(spark, "conf_l2", site).collect()] == [
            (0, 1, "L2", gold)
        ]
    finally:
        spark.conf.unset("GROUP_ID")
        spark.conf.unset("pipelines.GROUP_ID")


# Audit and cleanup


def test_history_is_newest_first(spark, site):
    from datetime import datetime

    for i in range(3):
        now = datetime.now()
        audit.record(spark, "H", f"t{i}", "L0", "SUCCESS", i, "m" * 500, now, now, site)
    history = audit.history(spark, "h", site).collect()
    assert [r.ROWS_LOADED for r in history] == [2, 1, 0]
    assert {len(r.MESSAGE) for r in history} == {400}


def test_audit_rows_of_several_writers_all_arrive(spark, site):
    """Sessions of their own stand for drivers of their own: they share only the folder."""
    from concurrent.futures import ThreadPoolExecutor
    from datetime import datetime

    def write(session):
        for i in range(4):
            now = datetime.now()
            audit.record(session, "MANY", f"t{i}", "L0", "SUCCESS", i, "m", now, now, site)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, [spark.newSession() for _ in range(6)]))
    assert audit.history(spark, "MANY", site).count() == 24
    assert audit.summary(spark, "MANY", site).first().OK == 24


def test_views_may_read_later_named_ones(spark, site, silver, rows):
    config.upsert_l1(
        spark,
        [row("DEP_L1", silver, "a_total", "VIEW", SOURCE_OBJ_SCHEMA=silver,
             TRANSFORMATION_QUERY="SELECT sum(x) AS s FROM b_base"),
         row("DEP_L1", silver, "b_base", "VIEW", SOURCE_OBJ_SCHEMA=silver,
             TRANSFORMATION_QUERY=f"CREATE OR REPLACE VIEW `{silver}`.`b-base` (x) AS WITH q AS "
             f"(SELECT y FROM {silver}.c_first) SELECT y + 1 FROM q"),
         row("DEP_L1", silver, "c_first", "VIEW", SOURCE_OBJ_SCHEMA=silver,
             TRANSFORMATION_QUERY="SELECT explode(array(1, 2)) AS y")],
        site,
    )
    assert sorted(publish(spark, "DEP_L1", site=site)) == [f"{silver}.{n}" for n in ("a_total", "b_base", "c_first")]
    assert rows(spark.table(site.table(silver, "a_total"))) == [(5,)]
    config.upsert_l1(
        spark,
        [row("DEP_L1", silver, "c_first", "VIEW", SOURCE_OBJ_SCHEMA=silver,
             TRANSFORMATION_QUERY="SELECT s AS y FROM a_total")],
        site,
    )
    with pytest.raises(ValueError, match="read each other"):
        publish(spark, "DEP_L1", site=site)


def test_a_failed_view_does_not_stop_independent_ones(spark, site, silver, rows):
    config.upsert_l1(
        spark,
        [row("FAIL_L1", silver, n, "VIEW", SOURCE_OBJ_SCHEMA=silver, TRANSFORMATION_QUERY=q)
         for n, q in (("a", "SELECT nothing FROM nowhere"), ("b", "SELECT * FROM a"), ("c", "SELECT 3 AS x"))],
        site,
    )
    with pytest.raises(RuntimeError, match="a, .*b"):
        publish(spark, "FAIL_L1", site=site)
    assert rows(spark.table(site.table(silver, "c"))) == [(3,)]


def test_cleanup_drops_targets_before_their_rows(spark, site, bronze, silver, landed):
    for group in ("OLD_L0", "NEW_L0"):
        config.upsert_header(spark, [{GROUP: group, "IS_ACTIVE": "Y"}], site)
        config.upsert_l0(
            spark,
            [row(group, bronze, f"{group}_{i}", SOURCE_URL=landed, IS_ACTIVE=active)
             for i, active in enumerate("YN")],
            site,
        )
        run_group(spark, group, site=site)
    write_table(spark.range(1), bronze, "OLD_L0_1", site=site)

    with pytest.raises(ValueError, match="at least one action"):
        cleanup_group(spark, "OLD_L0", site)
    with pytest.raises(ValueError, match="GROUP_ID"):
        cleanup_group(spark, " ", site, delete_l0=True)
    # The id is taken as stored.
    assert cleanup_group(spark, "old_l0", site, delete_l0=True, drop_bronze=True) == []

    dropped = cleanup_group(
        spark, "OLD_L0", site, delete_header=True, delete_l0=True, delete_l1=True,
        delete_l2=True, delete_audit=True, drop_bronze=True, drop_silver=True, drop_gold=True,
    )
    assert dropped == [f"{bronze}.OLD_L0_0", f"{bronze}.OLD_L0_1"]
    for table in (HEADER_TABLE, DETAIL_TABLES["L0"], AUDIT_TABLE):
        groups = spark.table(site.control(table)).select(GROUP).distinct().collect()
        assert [r[0] for r in groups] == ["NEW_L0"]
    assert not spark.catalog.tableExists(site.table(bronze, "OLD_L0_0"))
    assert spark.table(site.table(bronze, "NEW_L0_0")).count() == 8
