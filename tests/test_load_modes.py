import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import MergeConflict, conflicting_keys, delete_where, write_table
from strata.operators import replace as replacing
from strata.operators import tables
from strata.operators.columns import can_widen


@pytest.fixture
def load(spark, site, silver):
    """Load SQL text into the table ``t`` and return the reported count."""

    def run(text, load_type="FULL", keys=""):
        return write_table(spark.sql(text), silver, "t", load_type, keys, site)

    return run


@pytest.fixture
def table(spark, site, silver):
    return lambda: spark.table(site.table(silver, "t"))


def folders(site, schema, table="t"):
    home = f"{site.root.removeprefix('file:')}/{schema}"
    return sorted(name for name in os.listdir(home) if name.startswith(f"{table}-"))


# FULL


def test_full_replaces_rows_and_schema(load, table, rows, site, silver):
    assert load("SELECT 1 AS a, 'x' AS b UNION ALL SELECT 2, 'y'") == 2
    assert load("SELECT 5L AS c", " full ") == 1
    assert table().dtypes == [("c", "bigint")]
    assert rows(table()) == [(5,)]
    assert len(folders(site, silver)) == 2


@pytest.mark.parametrize("load_type", ["FULL", "", None, "  ", "WHATEVER", "DELTA"])
def test_modes_that_replace(load, table, load_type):
    for _ in range(2):
        assert load("SELECT id FROM range(7)", load_type) == 7
    assert table().count() == 7


def test_full_may_read_its_own_target(load, table, rows, site, silver):
    load("SELECT id FROM range(4)")
    name = site.table(silver, "t")
    assert load(f"SELECT id FROM {name} WHERE id > 1") == 2
    assert load(f"SELECT id, id * 10 AS tens FROM {name}") == 2
    assert rows(table()) == [(2, 20), (3, 30)]


def test_full_creates_the_schema(spark, bare_site):
    assert write_table(spark.range(3), bare_site.layers[2], "t", site=bare_site) == 3


def test_failed_full_leaves_the_table_as_it_was(load, table, rows, site, silver):
    load("SELECT id FROM range(3)")
    with pytest.raises(Exception, match="broken"):
        load("SELECT IF(id = 2, CAST(raise_error('broken') AS BIGINT), id) AS id FROM range(3)")
    assert rows(table()) == [(0,), (1,), (2,)]
    assert len(folders(site, silver)) == 1


def test_empty_frame_keeps_its_schema(load, table):
    load("SELECT id FROM range(3)")
    assert load("SELECT 1 AS a WHERE false") == 0
    assert table().dtypes == [("a", "int")]


def test_dropping_a_target_removes_its_files(spark, load, site, silver):
    load("SELECT id FROM range(3)")
    load("SELECT id FROM range(4)")
    replacing.drop_with_files(spark, site, silver, "t")
    assert folders(site, silver) == []
    assert load("SELECT 'x' AS again") == 1


@pytest.mark.parametrize("lost_after", ["stage", "drop", "create"])
def test_interrupted_schema_change_is_finished(
    spark, load, table, rows, site, silver, lost_after
):
    load("SELECT id FROM range(3)")
    name, stage = site.table(silver, "t"), site.table(silver, "t__strata_stage_0f")
    location = tables.new_location(spark, site, silver, "t")
    new = spark.sql("SELECT 'new' AS v")
    new.write.parquet(location)
    spark.sql(
        f"CREATE TABLE {stage} (v STRING) USING parquet "
        f"TBLPROPERTIES ('{replacing.REPLACES}' = 't') LOCATION '{location}'"
    )
    if lost_after in ("drop", "create"):
        spark.sql(f"DROP TABLE {name}")
    if lost_after == "create":
        spark.catalog.createTable(name, source="parquet", schema=new.schema)
    assert load("SELECT 'next' AS v", "APPEND") == 2
    assert rows(table()) == [("new",), ("next",)]
    assert not spark.catalog.tableExists(stage)


# INCREMENTAL / APPEND


@pytest.mark.parametrize("load_type", ["INCREMENTAL", "append", " Append "])
def test_append_doubles_and_reports_the_whole_target(load, load_type):
    assert load("SELECT id FROM range(3)", load_type) == 3
    assert load("SELECT id FROM range(3)", load_type) == 6


def test_append_evolves_by_name(load, table, rows):
    load("SELECT 1 AS a, 'x' AS b", "APPEND")
    load("SELECT 2.5D AS c, 2 AS A", "APPEND")
    assert table().dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert rows(table()) == [(1, "x", None), (2, None, 2.5)]


def test_append_widens_to_the_target_type(load, table, rows):
    load("SELECT 1L AS a, 'x' AS b, 1.0D AS c, TIMESTAMP'2024-01-01' AS d", "APPEND")
    load("SELECT 2 AS a, 7 AS b, 3 AS c, DATE'2024-01-02' AS d", "APPEND")
    assert rows(table().select("a", "b", "c", F.col("d").cast("string"))) == [
        (1, "x", 1.0, "2024-01-01 00:00:00"),
        (2, "7", 3.0, "2024-01-02 00:00:00"),
    ]


@pytest.mark.parametrize("value", ["'x'", "1.7D", "1.0", "true", "array(1L)"])
def test_append_refuses_types_that_lose_values(load, table, rows, value):
    load("SELECT 1L AS a", "APPEND")
    with pytest.raises(ValueError, match="cannot store"):
        load(f"SELECT {value} AS a, 1 AS b", "APPEND")
    assert table().columns == ["a"]
    assert rows(table()) == [(1,)]


def test_append_may_read_its_own_target(load, site, silver):
    load("SELECT id FROM range(3)", "APPEND")
    assert load(f"SELECT id + 3 AS id FROM {site.table(silver, 't')}", "APPEND") == 6


def test_can_widen():
    decimal = T.DecimalType
    assert can_widen(T.IntegerType(), decimal(12, 2))
    assert not can_widen(T.LongType(), decimal(12, 2))
    assert can_widen(decimal(5, 2), decimal(7, 3)) and not can_widen(decimal(5, 2), decimal(5, 3))
    assert can_widen(T.NullType(), T.ArrayType(T.LongType()))
    array = T.ArrayType(T.LongType())
    assert can_widen(array, T.ArrayType(T.LongType(), containsNull=False))
    assert not can_widen(array, T.StringType())


# MERGE and DELTA with keys


@pytest.mark.parametrize("load_type", ["MERGE", "DELTA", "merge"])
def test_merge_updates_and_inserts(load, table, rows, load_type):
    load("SELECT * FROM VALUES (1, 'a', 'e1'), (2, 'b', 'e2') AS t(k, v, extra)", load_type, "k")
    changes = "SELECT * FROM VALUES (2, 'B'), (3, 'C') AS t(k, v)"
    for _ in range(2):  # merging again changes nothing
        assert load(changes, load_type, " K ") == 3
        # A column only the target has is kept, and NULL in new rows.
        assert rows(table()) == [(1, "a", "e1"), (2, "B", "e2"), (3, "C", None)]


def test_merge_updates_to_null(load, table, rows):
    load("SELECT 1 AS k, 'a' AS v", "MERGE", "k")
    load("SELECT 1 AS k, CAST(NULL AS STRING) AS v", "MERGE", "k")
    assert rows(table()) == [(1, None)]


def test_merge_null_keys_never_match(load, table, rows):
    text = "SELECT * FROM VALUES (1, 10, 'a'), (1, NULL, 'b'), (NULL, NULL, 'c') AS t(k, l, v)"
    load(text, "MERGE", "k, l")
    assert load(text, "MERGE", "k, l") == 5
    assert rows(table(), "v") == [("a",), ("b",), ("b",), ("c",), ("c",)]


def test_merge_updates_every_target_row_with_the_key(load, table, rows):
    load("SELECT * FROM VALUES (1, 'a'), (1, 'b'), (2, 'c') AS t(k, v)", "MERGE", "k")
    assert load("SELECT 1 AS k, 'z' AS v", "MERGE", "k") == 3
    assert rows(table()) == [(1, "z"), (1, "z"), (2, "c")]


def test_merge_refuses_two_rows_for_one_target_row(load, table, rows):
    load("SELECT 1 AS k, 'a' AS v", "MERGE", "k")
    with pytest.raises(MergeConflict, match="Several source rows"):
        load("SELECT * FROM VALUES (1, 'x'), (1, 'y') AS t(k, v)", "MERGE", "k")
    assert rows(table()) == [(1, "a")]


def test_merge_inserts_unmatched_duplicates(load, table, rows):
    load("SELECT * FROM VALUES (1, 'a', 0), (2, 'b', 0) AS t(k, v, n)", "MERGE", "k")
    load("SELECT * FROM VALUES (7, 'x'), (7, 'y'), (2, 'B') AS t(k, v)", "MERGE", "k")
    assert rows(table(), "k", "v") == [(1, "a"), (2, "B"), (7, "x"), (7, "y")]


def test_first_merge_keeps_duplicates(load, spark, site, silver):
    text = "SELECT * FROM VALUES (1, 'a'), (1, 'b') AS t(k, v)"
    assert load(text, "MERGE", "k") == 2
    # The same holds for a table that exists and is empty.
    spark.sql(f"CREATE TABLE {site.table(silver, 'empty')} (k INT, v STRING) USING parquet")
    assert write_table(spark.sql(text), silver, "empty", "MERGE", "k", site) == 2


def test_merge_checks_columns(load, table, rows):
    with pytest.raises(ValueError, match="needs at least one key"):
        load("SELECT 1 AS k", "MERGE", " ")
    with pytest.raises(ValueError, match="not in the source: z"):
        load("SELECT 1 AS k", "MERGE", "z")
    load("SELECT 1 AS k, 'a' AS v", "MERGE", "k")
    with pytest.raises(ValueError, match="Columns not in .*: w"):
        load("SELECT 1 AS k, 'b' AS v, 1 AS w", "MERGE", "k")
    with pytest.raises(ValueError, match="cannot store string as int"):
        load("SELECT 'x' AS k, 'b' AS v", "MERGE", "k")
    assert rows(table()) == [(1, "a")]


def test_merge_source_may_read_the_target(load, table, rows, site, silver):
    load("SELECT id AS k, id AS v FROM range(3)", "MERGE", "k")
    name = site.table(silver, "t")
    load(f"SELECT k + 1 AS k, v FROM {name}", "MERGE", "k")
    assert rows(table()) == [(0, 0), (1, 0), (2, 1), (3, 2)]


def test_merge_evaluates_its_source_once(load, table, rows):
    load("SELECT id AS k, 0.0D AS v FROM range(100)", "MERGE", "k")
    # A random key either matches or not; drawn anew per scan it would do both or neither.
    assert load("SELECT DISTINCT CAST(rand() * 200 AS BIGINT) AS k, 1.0D AS v FROM range(100)",
                "MERGE", "k") == 100 + table().where("k >= 100").count()
    assert table().groupBy("k").count().where("count > 1").isEmpty()


def test_merge_leaves_nothing_behind(spark, load, site, silver):
    for _ in range(3):
        load("SELECT id AS k FROM range(5)", "MERGE", "k")
    assert len(folders(site, silver)) == 2  # and the version before
    shared = spark.conf.get("spark.checkpoint.dir", None)
    places = [shared] if shared else []
    assert not [n for p in places for n in os.listdir(p) if n.startswith("t-changes-")]


def test_merge_agrees_with_plain_python(spark, load, table, rows):
    """Random keys with NULLs, target duplicates and unmatched source duplicates."""
    import random

    draw = random.Random(3)
    target = [(draw.choice([None, *range(30)]), i) for i in range(200)]
    held = {k for k, _ in target}
    source = [(k, 1000 + k) for k in range(20)] + [(None, 2000), (None, 2001)]
    source += [(draw.choice(range(100, 105)), 3000 + i) for i in range(50)]
    expected = [(k, dict(source).get(k, v) if k is not None else v) for k, v in target]
    expected += [(k, v) for k, v in source if k is None or k not in held]

    def text(data):
        values = ", ".join(f"({'NULL' if k is None else k}, {v})" for k, v in data)
        return f"SELECT * FROM VALUES {values} AS t(k, v)"

    load(text(target), "MERGE", "k")
    load(text(source), "MERGE", "k")
    assert rows(table()) == sorted(expected, key=repr)
    # The same with joins that shuffle.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        load(text(target))
        load(text(source), "MERGE", "k")
        assert rows(table()) == sorted(expected, key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_statement_for_tables_that_merge_in_place(spark):
    """The connector is not installed here, so only the statement is checked."""
    import sys

    statement = sys.modules["strata.operators.merge"]._merge_statement
    parser = spark._jsparkSession.sessionState().sqlParser()
    text = statement("c.s.t", "_changes_t", ["K", "v", "odd name"], ["k"], None)
    assert "UPDATE SET t.`v` = s.`v`, t.`odd name` = s.`odd name` WHEN NOT" in text
    assert "MergeIntoTable" in parser.parsePlan(text).toString()
    text = statement("c.s.t", "_changes_t", ["k", "v"], ["k"], ["v", "not brought"])
    assert "SET t.`v` = s.`v` WHEN NOT" in text
    text = statement("c.s.t", "_changes_t", ["k"], ["k"], None)
    assert "UPDATE" not in text
    assert "MergeIntoTable" in parser.parsePlan(text).toString()


def test_conflicting_keys(spark, rows):
    target = spark.sql("SELECT * FROM VALUES (1), (1), (2), (NULL) AS t(k)")
    source = spark.sql("SELECT * FROM VALUES (1), (2), (2), (3), (3), (NULL), (NULL) AS t(k)")
    assert rows(conflicting_keys(target, source, ["k"])) == [(2,)]


# DELETE


def test_delete_keeps_rows_where_the_predicate_is_null(spark, load, table, rows, site, silver):
    load("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (3, NULL) AS t(k, v)")
    delete_where(spark, site, silver, "t", "v = :v", args={"v": "a"})
    assert rows(table()) == [(2, "b"), (3, None)]


def test_delete_without_a_hit_rewrites_nothing(spark, load, site, silver):
    load("SELECT 1 AS k")
    before = folders(site, silver)
    delete_where(spark, site, silver, "t", "k = 2 OR NULL")
    assert folders(site, silver) == before
    delete_where(spark, site, silver, "t", "k = 1 OR k = 5")
    assert spark.table(site.table(silver, "t")).isEmpty()


# Site


def test_external_target_keeps_its_files(spark, site, silver, tmp_path):
    outside = str(tmp_path / "outside")
    spark.range(3).write.parquet(outside)
    name = site.table(silver, "t")
    spark.catalog.createTable(name, path=outside, source="parquet")
    assert write_table(spark.range(5), silver, "t", "FULL", "", site) == 5
    assert spark.read.parquet(outside).count() == 3


def test_partitioned_target_keeps_its_rows(spark, site, silver, rows):
    """A table partitioned by someone else is read, appended to and rewritten correctly."""
    name = site.table(silver, "t")
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING, p INT) USING parquet PARTITIONED BY (p)")
    spark.sql(f"INSERT INTO {name} VALUES (1, 'a', 1), (2, 'b', 2)")
    changes = spark.sql("SELECT 3 AS p, 3 AS k, 'c' AS v")
    assert write_table(changes, silver, "t", "APPEND", "", site) == 3
    changes = spark.sql("SELECT 'B' AS v, 2 AS k")
    assert write_table(changes, silver, "t", "MERGE", "k", site) == 3
    assert rows(spark.table(name)) == [(1, "a", 1), (2, "B", 2), (3, "c", 3)]
    assert write_table(changes, silver, "t", "MERGE", "k", site) == 3


def test_target_of_another_format_keeps_it(spark, site, silver, rows):
    name = site.table(silver, "t")
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING) USING orc")
    spark.sql(f"INSERT INTO {name} VALUES (1, 'a'), (2, 'b')")
    changes = spark.sql("SELECT 1 AS k, 'c' AS v")
    assert write_table(changes, silver, "t", "MERGE", "k", site) == 2
    assert tables.layout_of(spark, site, silver, "t").provider == "orc"
    assert rows(spark.table(name)) == [(1, "c"), (2, "b")]
    assert write_table(changes, silver, "t", "FULL", "", site) == 1
    assert tables.layout_of(spark, site, silver, "t").provider == "parquet"


@pytest.mark.parametrize("rewrite", ["merge", "delete", "full"])
def test_rewrites_keep_the_layout(spark, site, silver, rows, rewrite):
    name = site.table(silver, "t")
    spark.sql(
        f"CREATE TABLE {name} (k INT, v STRING, p INT, q STRING) USING parquet "
        "PARTITIONED BY (p, q) COMMENT 'it\\'s ours' TBLPROPERTIES ('steward' = 'a=b, c')"
    )
    spark.sql(f"INSERT INTO {name} VALUES (1, 'a', 1, 'x'), (2, 'b', 2, NULL), (3, 'c', 2, 'y')")
    for turn in range(2):
        if rewrite == "merge":
            changes = spark.sql(f"SELECT 2 AS k, 'B{turn}' AS v")
            assert write_table(changes, silver, "t", "MERGE", "k", site) == 3
        elif rewrite == "delete":
            delete_where(spark, site, silver, "t", f"k = {turn + 1}")
            assert spark.table(name).count() == 2 - turn
        else:
            new = spark.sql("SELECT 9 AS k, 1 AS p, 'z' AS q, 2.5D AS w")
            assert write_table(new, silver, "t", "FULL", "", site) == 1
    layout = tables.layout_of(spark, site, silver, "t")
    assert layout.partitions == ["p", "q"]
    assert (layout.comment, layout.properties["steward"]) == ("it's ours", "a=b, c")
    assert len(spark.sql(f"SHOW PARTITIONS {name}").collect()) == {"merge": 3, "delete": 1, "full": 1}[rewrite]
    if rewrite == "merge":
        assert rows(spark.table(name)) == [(1, "a", 1, "x"), (2, "B1", 2, None), (3, "c", 2, "y")]


@pytest.mark.parametrize("other", ["t__stage", "t__strata_stage_1"])
def test_tables_that_look_like_a_stage_are_left_alone(spark, load, table, rows, site, silver, other):
    write_table(spark.sql("SELECT 7 AS x"), silver, other, "FULL", "", site)
    load("SELECT 1 AS k, 'a' AS v")
    assert load("SELECT 2 AS k, 'b' AS v", "APPEND") == 2
    assert load("SELECT 2 AS k, 'c' AS v", "MERGE", "k") == 2
    delete_where(spark, site, silver, "t", "k = 1")
    assert load("SELECT 'd' AS v, 2.5D AS w") == 1
    assert rows(table()) == [("d", 2.5)]
    assert rows(spark.table(site.table(silver, other))) == [(7,)]


def test_the_version_before_stays_readable(spark, load, table, site, silver):
    load("SELECT id FROM range(5)")
    held = table()
    load("SELECT id FROM range(3)")
    assert held.count() == 5
    for n in (2, 4, 6):
        load(f"SELECT id FROM range({n})")
    assert len(folders(site, silver)) == 2


def test_values_are_never_changed_by_a_cast(spark, load, table, rows):
    load("SELECT 9007199254740992D AS k, 'a' AS v")
    for mode in ("APPEND", "MERGE"):
        with pytest.raises(ValueError, match="cannot store bigint as double"):
            load("SELECT 9007199254740993L AS k, 'b' AS v", mode, "k")
    load("SELECT CAST(1 AS FLOAT) AS k, 'a' AS v")
    with pytest.raises(ValueError, match="cannot store int as float"):
        load("SELECT 16777217 AS k, 'b' AS v", "APPEND")
    load("SELECT 1 AS k, 'a' AS v")
    assert load("SELECT 1L AS k, 'b' AS v", "MERGE", "k") == 1
    assert rows(table()) == [(1, "b")]
    with pytest.raises(Exception, match="overflows int"):
        load("SELECT 2147483649L AS k, 'c' AS v", "MERGE", "k")
    assert rows(table()) == [(1, "b")]


def test_append_widens_inside_structs(spark, load, table, rows):
    load("SELECT 1 AS id, NAMED_STRUCT('a', 1) AS s, ARRAY(NAMED_STRUCT('x', 1)) AS l", "APPEND")
    load(
        "SELECT 2 AS id, NAMED_STRUCT('unit-price', 2.5D, 'A', 7) AS s, "
        "ARRAY(NAMED_STRUCT('y', 'n', 'x', 2), NULL) AS l, MAP('k', NAMED_STRUCT('z w', 1)) AS m",
        "APPEND",
    )
    load("SELECT 3 AS id, CAST(NULL AS STRUCT<a: INT>) AS s, MAP('k', NAMED_STRUCT('q', TRUE)) AS m", "APPEND")
    got = table().orderBy("id").selectExpr("id", "s", "l", "m").toPandas().to_dict("records")
    assert [r["s"] and tuple(r["s"]) for r in got] == [(1, None), (7, 2.5), None]
    assert [x and tuple(x) for x in got[0]["l"]] == [(1, None)]
    assert [x and tuple(x) for x in got[1]["l"]] == [(2, "n"), None]
    assert [r["m"] and {k: tuple(v) for k, v in r["m"].items()} for r in got] == [None, {"k": (1, None)}, {"k": (None, True)}]
    with pytest.raises(ValueError, match="cannot store"):
        load("SELECT 4 AS id, NAMED_STRUCT('a', 'text') AS s", "APPEND")
    assert table().count() == 3


@pytest.mark.parametrize("layout", ["PARTITIONED BY (p)", ""])
def test_target_of_someone_else_widens_inside_structs(spark, site, silver, layout):
    name = site.table(silver, "t")
    spark.sql(f"CREATE TABLE {name} (s STRUCT<a: INT>, p INT) USING parquet {layout}")
    spark.sql(f"INSERT INTO {name} VALUES (NAMED_STRUCT('a', 1), 1)")
    new = spark.sql("SELECT 2 AS p, NAMED_STRUCT('b', 2) AS s")
    assert write_table(new, silver, "t", "APPEND", "", site) == 2
    got = {r.p: tuple(r.s) for r in spark.table(name).collect()}
    assert got == {1: (1, None), 2: (None, 2)}
