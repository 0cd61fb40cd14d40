import pytest

from strata import pick_catalog
from strata.functions import group_key, layer_of, parse_keys
from strata.plans import config
from strata.schemas import CONTROL_TABLES, DETAIL_TABLES, GROUP, HEADER_TABLE

L0 = DETAIL_TABLES["L0"]


def detail(name, load_type="FULL", active="Y", group="G_L0", **more):
    row = {GROUP: group, "TARGET_TABLE": name, "TARGET_SCHEMA": "b"}
    return row | {"LOAD_TYPE": load_type, "IS_ACTIVE": active} | more


def test_install_is_idempotent_and_typed(spark, bare_site):
    config.install(spark, bare_site)
    assert config.install(spark, bare_site) == sorted(CONTROL_TABLES)
    for name, schema in CONTROL_TABLES.items():
        assert spark.table(bare_site.control(name)).dtypes == [
            (f.name, f.dataType.simpleString()) for f in schema
        ]
    assert len(CONTROL_TABLES[HEADER_TABLE]) == 22 and len(CONTROL_TABLES[L0]) == 20
    for schema in bare_site.layers:
        assert spark.catalog.databaseExists(bare_site.schema(schema))


def test_pick_catalog(spark):
    assert pick_catalog(spark) == "spark_catalog"
    assert pick_catalog(spark, ("none", "spark_catalog")) == "spark_catalog"


def test_run_parameters():
    assert group_key(" sales_l1 ") == "SALES_L1"
    assert [layer_of(g) for g in ("A_L0", "A_L1", "A_L2", "A_L0_RAW", "L1")] == [
        "L0", "L1", "L2", "ALL", "ALL",
    ]
    assert parse_keys(" a, b ,c") == ["a", "b", "c"]
    assert parse_keys(" ") == parse_keys(None) == []
    for blank in ("", "  ", None):
        with pytest.raises(ValueError, match="GROUP_ID is required"):
            group_key(blank)


def test_active_loads_are_three_valued_and_ordered(spark, site):
    load_types = ("MERGE", None, "", "VIEW", "view", "incremental", "WHATEVER")
    targets = [detail(f"t{i}", kind) for i, kind in enumerate(load_types)]
    targets += [detail("off", active="N"), detail("lower", active="y"), detail("x", group="g_l0")]
    config.upsert_l0(spark, targets[::-1], site)
    loads = config.active_loads(spark, "L0", "g_l0", site=site)
    assert [r.TARGET_TABLE for r in loads.collect()] == ["t0", "t2", "t5", "t6"]
    assert [r.TARGET_TABLE for r in config.group_targets(spark, "ALL", "g_l0", site).collect()] == [
        "t0", "t2", "t5", "t6",
    ]
    for table, count in (("t5", 1), (" t5 ", 1), ("T5", 0), ("ALL", 4), ("", 4), (None, 4)):
        assert config.active_loads(spark, "L0", "G_L0", table, site).count() == count
    assert config.all_targets(spark, "L0", "G_L0", site).count() == 9
    assert config.all_targets(spark, "L0", "g_l0", site).count() == 1


def test_normalised_rows(spark, rows):
    given = spark.createDataFrame(
        [
            (" b ", "t1\n", None, "json", " ", "\t", " sql\n"),
            ("b", "t2", " delta ", " Parquet ", "", " ; ", None),
            ("b", "t3", "", None, "CSV", " ", ""),
            (" ", "t4", "FULL", None, None, None, None),
            ("b", None, "FULL", None, None, None, None),
        ],
        "TARGET_SCHEMA STRING, TARGET_TABLE STRING, LOAD_TYPE STRING, FILE_FORMAT STRING, "
        "INPUT_FILE_FORMAT STRING, DELIMETER STRING, TRANSFORMATION_QUERY STRING",
    )
    assert rows(
        config.normalise_rows(given),
        "TARGET_SCHEMA", "TARGET_TABLE", "LOAD_TYPE", "SOURCE_FORMAT", "DELIMETER",
        "TRANSFORMATION_QUERY", "MERGE_KEYS",
    ) == [
        ("b", "t1", "FULL", "csv", "\t", "sql", ""),
        ("b", "t2", "DELTA", "parquet", ";", "", ""),
        ("b", "t3", "FULL", "csv", ",", "", ""),
    ]


def test_upserts_change_only_the_listed_columns(spark, site, rows):
    config.upsert_l1(
        spark,
        [detail("t", group="G_L1", PARTITION_BY="p", MERGE_KEYS="k", SOURCE_OBJ_NAME="s")],
        site,
    )
    first = spark.table(site.control(DETAIL_TABLES["L1"])).first()
    changed = detail("t", "MERGE", "N", "G_L1", PARTITION_BY="q", MERGE_KEYS="k2",
                     SOURCE_OBJ_NAME="s2", TRANSFORMATION_QUERY="SELECT 1")
    config.upsert_l1(spark, [changed | {"TARGET_SCHEMA": "other"}], site)
    (row,) = spark.table(site.control(DETAIL_TABLES["L1"])).collect()
    assert (row.TARGET_SCHEMA, row.PARTITION_BY, row.SOURCE_OBJ_NAME) == ("b", "p", "s")
    assert (row.LOAD_TYPE, row.MERGE_KEYS, row.TRANSFORMATION_QUERY, row.IS_ACTIVE) == (
        "MERGE", "k2", "SELECT 1", "N",
    )
    assert row.CREATED_DATE == first.CREATED_DATE and row.UPDATED_DATE > first.UPDATED_DATE


def test_upserts_check_rows(spark, site):
    with pytest.raises(Exception, match="DATA_FLOW_GROUP_ID is NULL"):
        config.upsert_header(spark, [{GROUP: None, "JOB_NAME": "j"}], site)
    with pytest.raises(ValueError, match="Unknown control columns: NAME"):
        config.upsert_header(spark, [{GROUP: "G", "NAME": "j"}], site)


def test_active_groups(spark, site, rows):
    with pytest.raises(LookupError, match="The header has no row"):
        config.active_groups(spark, site=site)
    config.upsert_header(
        spark,
        [{GROUP: g, "NOTEBOOK_PATH": f"/{g}", "IS_ACTIVE": a} for g, a in
         (("B", "Y"), ("A", "Y"), ("C", "N"))],
        site,
    )
    assert [r[GROUP] for r in config.active_groups(spark, site=site).collect()] == ["A", "B"]
    assert [r.NOTEBOOK_PATH for r in config.active_groups(spark, " b ", site).collect()] == ["/B"]
    with pytest.raises(LookupError, match="C has no row"):
        config.active_groups(spark, "c", site)


def test_exported_script_can_be_parsed_and_is_in_order(spark, site, tmp_path):
    assert config.export_merge_script(spark, "G_L0", site=site).isEmpty()
    config.upsert_l0(
        spark,
        [detail("t2", SOURCE_URL="/it's/a\\b", FILE_FORMAT=None), detail("t1", "VIEW"),
         detail("t0", active="N")],
        site,
    )
    assert config.export_merge_script(spark, "G_L0", site=site).isEmpty()
    config.upsert_header(
        spark, [{GROUP: "G_L0", "NOTEBOOK_PATH": "/nb", "IS_ACTIVE": "Y"}], site
    )
    script = config.export_merge_script(spark, " g_l0", "nightly", site)
    assert [(r.part, r.target) for r in script.collect()] == [(0, ""), (1, "t1"), (1, "t2")]
    config.write_script(script, f"{tmp_path}/script")
    saved = "\n".join(r.value for r in spark.read.text(f"{tmp_path}/script").collect())
    assert saved.startswith("-- nightly | G_L0\nMERGE INTO")
    parser = spark._jsparkSession.sessionState().sqlParser()
    statements = [s for s in saved.split(";\n") if s.strip()]
    assert len(statements) == 3
    for statement in statements:
        assert "MergeIntoTable" in parser.parsePlan(statement.rstrip().rstrip(";")).toString()
    # The quoted values read back as they were.
    using = statements[2].split("USING (")[1].split(") AS src")[0]
    row = spark.sql(using).first()
    assert (row.SOURCE_URL, row.FILE_FORMAT, row.TARGET_TABLE) == ("/it's/a\\b", None, "t2")
