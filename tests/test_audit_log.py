"""The audit log beside deletes and compaction, the order of views, and scheduler pools."""

import threading
import time
from datetime import datetime

import pytest

from strata.plans import audit, cleanup, config, views
from strata.plans.audit import AuditBusy
from strata.plans.runner import fair_share
from strata.schemas import AUDIT_TABLE


@pytest.fixture
def note(spark, site):
    def run(group, status="SUCCESS", message="m"):
        now = datetime(2024, 1, 1)
        audit.record(spark, group, "t", "L0", status, 1, message, now, now, site)

    return run


@pytest.fixture
def counts(spark, site):
    def run():
        name = site.control(AUDIT_TABLE)
        spark.catalog.refreshTable(name)
        return {row[0]: row[1] for row in spark.table(name).groupBy("DATA_FLOW_GROUP_ID").count().collect()}

    return run


def home(spark, site):
    return audit._opened(spark, site)


def test_a_row_recorded_during_a_delete_stays(spark, site, note, counts, monkeypatch):
    """Rows come between the listing of a delete and its removals, of this group and another."""
    note("A_L0"), note("B_L0")
    real = audit._settle

    def meanwhile(folder):
        real(folder)
        listed = folder.children
        runs = listed()
        note("A_L0", message="late"), note("C_L0")
        monkeypatch.setattr(type(folder), "children", lambda self: runs if self.path == folder.path else [])

    with monkeypatch.context() as patch:
        patch.setattr(audit, "_settle", meanwhile)
        kept = audit._Folder.children
        audit.delete(spark, "A_L0", site)
        audit._Folder.children = kept
    assert counts() == {"A_L0": 1, "B_L0": 1, "C_L0": 1}
    assert audit.history(spark, "A_L0", site).first().MESSAGE == "late"


def test_cleanup_deletes_one_group(spark, site, note, counts):
    note("A_L0"), note("A_L0"), note("B_L0"), note("it's/odd %ä_L0")
    cleanup.delete_config(spark, AUDIT_TABLE, "A_L0", site)
    cleanup.delete_config(spark, AUDIT_TABLE, "NONE", site)
    assert counts() == {"B_L0": 1, "it's/odd %ä_L0": 1}
    cleanup.delete_config(spark, AUDIT_TABLE, "it's/odd %ä_L0", site)
    assert counts() == {"B_L0": 1}


def test_rows_from_before_groups_had_folders(spark, site, note, counts):
    note("A_L0"), note("B_L0")
    now = spark.table(site.control(AUDIT_TABLE))
    rows = spark.createDataFrame(now.collect(), now.schema)
    opened = home(spark, site)
    opened.write(rows, opened.home() / "run-old")
    opened.write(rows, opened.home())
    assert counts() == {"A_L0": 3, "B_L0": 3}
    assert audit.history(spark, "a_l0", site).count() == 3
    audit.delete(spark, "A_L0", site)
    assert counts() == {"B_L0": 3}


def test_compaction_leaves_few_files(spark, site, note, counts):
    for n in range(6):
        note("A_L0", message=str(n))
    note("B_L0")
    # Many runs at once, each a folder as a writer leaves it.
    opened = home(spark, site)
    many = spark.sql(
        "SELECT 'A_L0' AS DATA_FLOW_GROUP_ID, 't' AS TARGET_TABLE, 'L0' AS ETL_LAYER, 'SUCCESS' AS STATUS, id AS ROWS_LOADED, "
        "string(id) AS MESSAGE, now() AS START_TIME, now() AS END_TIME, now() AS LOAD_TS FROM range(10000)"
    ).repartition(40)
    opened.write(many, opened.of_group("A_L0") / "run-many")
    assert audit.compact(spark, site=site) == 7
    (run,) = opened.of_group("A_L0").children()
    assert len([c for c in run.children() if c.name.startswith("part-")]) <= 2
    assert counts() == {"A_L0": 10006, "B_L0": 1}
    assert audit.compact(spark, "A_L0", site) == 0


@pytest.mark.parametrize("finished", [True, False])
def test_lost_compaction_is_mended(spark, site, note, counts, finished):
    note("A_L0"), note("A_L0")
    opened = home(spark, site)
    folder = opened.of_group("A_L0")
    runs = folder.children()
    (folder / "run-new" / audit.STANDS_FOR).put_text("\n".join(r.name for r in runs))
    opened.write(opened.read(runs), folder / "run-new")
    if not finished:
        (folder / "run-new" / audit.FINISHED).remove()
    note("A_L0", message="later")
    audit.compact(spark, "A_L0", site)
    assert counts() == {"A_L0": 3}


def test_one_driver_removes_at_a_time(spark, site, note, counts, monkeypatch):
    note("A_L0"), note("A_L0")
    claim = home(spark, site).of_group("A_L0") / audit.CLAIM
    assert claim.claim() and not claim.claim()
    with pytest.raises(AuditBusy):
        audit.delete(spark, "A_L0", site)
    assert audit.compact(spark, "A_L0", site) == 0
    monkeypatch.setattr(audit, "CLAIM_SECONDS", -1)  # whoever claimed it is lost
    audit.delete(spark, "A_L0", site)
    assert counts() == {}
    assert not claim.exists()


def test_history_reads_one_group(spark, site, note):
    note("A_L0"), note("B_L0")
    files = audit.history(spark, "A_L0", site).inputFiles()
    assert files and all("group-A_L0" in file for file in files)
    assert audit.history(spark, "NEVER", site).count() == 0
    assert [tuple(row) for row in audit.summary(spark, "B_L0", site).collect()] == [("L0", 1, 0, True)]


# Views


def test_independent_views_overlap_and_failures_stop_dependants():
    spans, lock = {}, threading.Lock()

    def rebuild(key):
        started = time.monotonic()
        time.sleep(0.3)
        if key == "b":
            raise ValueError("b")
        with lock:
            spans[key] = (started, time.monotonic())
        return key.upper()

    needs = {"a": set(), "b": set(), "c": {"a"}, "d": {"b"}, "e": {"d"}, "f": {"a", "c"}}
    done, failed = views._in_order(needs, rebuild, 4)
    assert done in (["A", "C", "F"],)
    assert failed.keys() == {"b", "d", "e"} and failed["d"] is None and isinstance(failed["b"], ValueError)
    assert spans["a"][1] <= spans["c"][0] and spans["c"][1] <= spans["f"][0]
    spans.clear()
    views._in_order({"a": set(), "x": set()}, rebuild, 2)
    assert spans["a"][0] < spans["x"][1] and spans["x"][0] < spans["a"][1]
    with pytest.raises(ValueError, match="read each other"):
        views._in_order({"a": {"b"}, "b": {"a"}}, rebuild, 2)


def test_views_of_one_depth_run_together(spark, site, silver, gold, monkeypatch):
    rows = [
        {"DATA_FLOW_GROUP_ID": "V_L2", "SOURCE_OBJ_SCHEMA": silver, "SOURCE_OBJ_NAME": "s", "TARGET_SCHEMA": gold,
         "TARGET_TABLE": f"v{n}", "LOAD_TYPE": "VIEW", "IS_ACTIVE": "Y", "TRANSFORMATION_QUERY": query}
        for n, query in enumerate(["SELECT 1 AS a", "SELECT 2 AS a", f"SELECT a FROM {gold}.v0 UNION ALL SELECT a FROM {gold}.v1"])
    ]
    config.upsert_l2(spark, rows, site)
    meet = threading.Barrier(2, timeout=60)
    real = views.query_in

    def together(session, query, *args):
        if "gold" not in query:
            meet.wait()
        return real(session, query, *args)

    monkeypatch.setattr(views, "query_in", together)
    assert views.publish(spark, "V_L2", site=site) == [f"{gold}.v0", f"{gold}.v1", f"{gold}.v2"]
    assert spark.table(site.table(gold, "v2")).count() == 2


def test_each_load_has_a_pool(spark):
    pool = lambda: spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    with fair_share(spark, "bronze.t"):
        assert pool() == "load bronze.t"
    assert pool() is None
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "mine")
    with fair_share(spark, "bronze.t"):
        assert pool() == "mine"
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
