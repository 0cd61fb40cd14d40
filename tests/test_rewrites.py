"""What a MERGE or delete touches of a table, and what the table keeps."""

import importlib
import re

import pytest
from pyspark.sql import functions as F

from strata import MergeConflict, delete_where, write_table
from strata.operators import replace as replacing
from strata.operators import tables

# The package has a function of that name.
merging = importlib.import_module("strata.operators.merge")


@pytest.fixture(params=["few", "many"])
def changes_are(request, monkeypatch):
    """Both ways of a merge: a look at the keys first, or one pass over the target."""
    if request.param == "many":
        monkeypatch.setattr(merging, "_few", lambda *_: False)
    return request.param


@pytest.fixture
def merge(spark, site, silver):
    return lambda query, keys="k": write_table(spark.sql(query), silver, "t", "MERGE", keys, site)


@pytest.fixture
def make(spark, site, silver):
    def run(definition, values):
        name = site.table(silver, "t")
        spark.sql(f"CREATE TABLE {name} {definition}")
        spark.sql(f"INSERT INTO {name} VALUES {values}")
        return name

    return run


@pytest.fixture
def folders(spark, site, silver):
    """Files of the table by partition folder."""

    def read():
        found = {}
        for row in spark.table(site.table(silver, "t")).select(F.input_file_name()).distinct().collect():
            folder = re.search(r"/p=([^/]*)/", row[0])
            found.setdefault(folder[1] if folder else "", set()).add(row[0])
        return found

    return read


PARTITIONED = "(k INT, v STRING, p STRING) USING parquet PARTITIONED BY (p)"
ROWS = "(1, 'a', 'x'), (2, 'b', 'y'), (3, 'c', 'z'), (4, 'd', NULL), (5, 'e', 'a/b c')"


def test_merge_leaves_untouched_partitions_alone(spark, make, merge, folders, rows, changes_are):
    name = make(PARTITIONED, ROWS)
    before = folders()
    assert merge("SELECT 2 AS k, 'B' AS v, 'y' AS p UNION ALL SELECT 9, 'n', 'new'") == 6
    after = folders()
    assert {p for p in before if before[p] == after.get(p)} == before.keys() - {"y"}
    assert merge("SELECT 4 AS k, 'D' AS v UNION ALL SELECT 5, 'E'") == 6
    assert folders()["x"] == before["x"]
    assert rows(spark.table(name)) == [
        (1, "a", "x"), (2, "B", "y"), (3, "c", "z"), (4, "D", None), (5, "E", "a/b c"), (9, "n", "new")]


def test_merge_moves_rows_between_partitions(spark, make, merge, folders, rows, changes_are):
    name = make(PARTITIONED, ROWS)
    before = folders()
    assert merge("SELECT 2 AS k, 'B' AS v, 'x' AS p UNION ALL SELECT 3, 'C', 'new'") == 5
    assert folders()["a%2Fb%20c" if "a%2Fb%20c" in before else next(p for p in before if p.startswith("a"))] in before.values()
    assert rows(spark.table(name)) == [
        (1, "a", "x"), (2, "B", "x"), (3, "C", "new"), (4, "d", None), (5, "e", "a/b c")]
    shown = {row.partition for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert not shown & {"p=y", "p=z"}


def test_merge_by_partition_column_reads_few_partitions(spark, make, merge, folders, rows, changes_are):
    name = make("(k INT, v STRING, p INT) USING parquet PARTITIONED BY (p)", "(1, 'a', 1), (1, 'b', 2), (1, 'c', 3)")
    before = folders()
    assert merge("SELECT 1 AS k, 'B' AS v, 2 AS p UNION ALL SELECT 7, 'n', 2", "k, p") == 4
    assert {p for p in before if folders()[p] == before[p]} == {"1", "3"}
    assert rows(spark.table(name)) == [(1, "B", 2), (1, "a", 1), (1, "c", 3), (7, "n", 2)]


def test_delete_leaves_untouched_partitions_alone(spark, make, folders, rows, site, silver):
    name = make(PARTITIONED, f"{ROWS}, (6, 'f', 'y')")
    before = folders()
    delete_where(spark, site, silver, "t", "k IN (1, 2)")
    after = folders()
    assert {p for p in before if before[p] == after.get(p)} == before.keys() - {"x", "y"}
    assert "p=x" not in {row.partition for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    delete_where(spark, site, silver, "t", "p IS NULL")
    assert rows(spark.table(name)) == [(3, "c", "z"), (5, "e", "a/b c"), (6, "f", "y")]
    write_table(spark.sql("SELECT 8 AS k, 'g' AS v, 'y' AS p"), silver, "t", "APPEND", "", site)
    assert rows(spark.table(name).where("p = 'y'")) == [(6, "f", "y"), (8, "g", "y")]


def test_many_partitions_are_found_by_a_join(spark, make, merge, rows, monkeypatch, changes_are):
    monkeypatch.setattr(replacing, "LISTED_PARTITIONS", 1)
    name = make(PARTITIONED, ROWS)
    assert merge("SELECT 2 AS k, 'B' AS v UNION ALL SELECT 3, 'C' UNION ALL SELECT 4, 'D'") == 5
    assert [row[1] for row in rows(spark.table(name))] == ["a", "B", "C", "D", "e"]


@pytest.mark.parametrize("statements", [0, 1, 3, 5])
def test_a_lost_driver_is_completed(spark, make, merge, rows, site, silver, monkeypatch, statements):
    """The driver goes after some of the statements that point partitions elsewhere."""
    name = make(PARTITIONED, ROWS)
    real, left = replacing._promote_partitions, [statements]

    class Lost(BaseException):
        pass

    def some(session, *args):
        sql = type(session).sql

        def counted(self, statement, *more, **options):
            if statement.startswith("ALTER TABLE"):
                left[0] -= 1
                if left[0] < 0:
                    raise Lost
            return sql(self, statement, *more, **options)

        with monkeypatch.context() as patch:
            patch.setattr(type(session), "sql", counted)
            real(session, *args)

    with monkeypatch.context() as patch:
        patch.setattr(replacing, "_promote_partitions", some)
        with pytest.raises(Lost):
            merge("SELECT k, upper(v) AS v, if(k = 3, 'w', p) AS p FROM VALUES (1,'a','x'), (2,'b','y'), (3,'c','z') AS t(k, v, p)")
    assert merge("SELECT 5 AS k, 'E' AS v") == 5
    assert rows(spark.table(name)) == [(1, "A", "x"), (2, "B", "y"), (3, "C", "w"), (4, "d", None), (5, "E", "a/b c")]
    assert not tables.stages_of(spark, site, silver, "t")


def test_partitions_of_a_dropped_target_go(spark, make, merge, folders, site, silver):
    make(PARTITIONED, ROWS)
    merge("SELECT 2 AS k, 'B' AS v")
    merge("SELECT 2 AS k, 'C' AS v")
    files = [f for some in folders().values() for f in some]
    replacing.drop_with_files(spark, site, silver, "t")
    assert not any(tables.folder_exists(spark, f) for f in files)


def test_version_before_of_a_partition_stays_one_rewrite(spark, make, merge, folders, rows):
    make(PARTITIONED, ROWS)
    old = folders()["y"]
    merge("SELECT 2 AS k, 'B' AS v")
    assert rows(spark.read.parquet(*old)) == [(2, "b")]
    merge("SELECT 2 AS k, 'C' AS v")
    assert not any(tables.folder_exists(spark, f) for f in old)


def exchanges(spark, name):
    plan = spark.sql(f"SELECT k, count(*) FROM {name} GROUP BY k")._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange")


@pytest.mark.parametrize("rewrite", ["full", "append", "merge", "delete", "none"])
def test_bucketed_targets_stay_bucketed(spark, make, merge, rows, site, silver, rewrite, changes_are):
    name = make("(k INT, v STRING) USING parquet CLUSTERED BY (k) SORTED BY (k) INTO 4 BUCKETS COMMENT 'b'",
                ", ".join(f"({n}, 'v{n}')" for n in range(50)))
    for turn in range(2):
        if rewrite == "full":
            write_table(spark.range(50).selectExpr("CAST(id AS INT) AS k", "concat('v', id) AS v"), silver, "t", "FULL", "", site)
        elif rewrite == "append":
            write_table(spark.sql(f"SELECT {100 + turn} AS k, 'n' AS v"), silver, "t", "APPEND", "", site)
        elif rewrite == "merge":
            assert merge(f"SELECT 7 AS k, 'm{turn}' AS v UNION ALL SELECT {200 + turn}, 'n'") == 51 + turn
        elif rewrite == "none":
            assert merge(f"SELECT {200 + turn} AS k, 'n' AS v") == 51 + turn
        else:
            delete_where(spark, site, silver, "t", f"k = {turn}")
    total = {"full": 50, "append": 52, "merge": 52, "none": 52, "delete": 48}[rewrite]
    counted = rows(spark.sql(f"SELECT k, count(*) FROM {name} GROUP BY k"))
    assert len(counted) == total and {n for _, n in counted} == {1}
    other = spark.table(name).select("k", F.lit(1).alias("one"))
    assert spark.table(name).join(other, "k").count() == total
    assert exchanges(spark, name) == 0
    layout = tables.layout_of(spark, site, silver, "t")
    assert layout.buckets == tables.Buckets(4, ["k"], ["k"]) and layout.comment == "b"
    assert not tables.stages_of(spark, site, silver, "t")


def test_bucketed_and_partitioned(spark, make, merge, rows, folders, changes_are):
    name = make("(k INT, v STRING, p STRING) USING parquet PARTITIONED BY (p) CLUSTERED BY (k) INTO 2 BUCKETS", ROWS)
    before = folders()
    assert merge("SELECT 2 AS k, 'B' AS v UNION ALL SELECT 8, 'n'") == 6
    assert folders()["x"] == before["x"]
    assert rows(spark.sql(f"SELECT k, max(v) FROM {name} GROUP BY k"))[1] == (2, "B")


def test_buckets_go_with_their_column(spark, make, site, silver, rows):
    name = make("(k INT, v STRING) USING parquet CLUSTERED BY (k) INTO 4 BUCKETS", "(1, 'a')")
    write_table(spark.sql("SELECT 'x' AS v"), silver, "t", "FULL", "", site)
    assert rows(spark.table(name).groupBy("v").count()) == [("x", 1)]
    assert tables.layout_of(spark, site, silver, "t").buckets is None


@pytest.mark.parametrize("partitions", ["", "PARTITIONED BY (p)"])
def test_column_comments_stay(spark, make, merge, site, silver, partitions):
    name = make(f"(k INT COMMENT 'the key', v STRING COMMENT 'it\\'s', p STRING COMMENT 'part') USING parquet {partitions}", ROWS)
    merge("SELECT 2 AS k, 'B' AS v")
    delete_where(spark, site, silver, "t", "k = 1")
    write_table(spark.sql("SELECT 9 AS k, named_struct('a', 1) AS s"), silver, "t", "APPEND", "", site)
    write_table(spark.sql("SELECT 9 AS k, named_struct('a', 1, 'b', 2) AS s"), silver, "t", "APPEND", "", site)
    comments = {f.name: f.metadata.get("comment") for f in spark.table(name).schema}
    assert comments == {"k": "the key", "v": "it's", "p": "part", "s": None}


def test_options_with_commas_stay(spark, make, merge, rows, site, silver):
    name = make("(k INT, v STRING) USING csv OPTIONS (sep ', ', nullValue 'a=b')", "(1, 'a'), (2, 'b'), (3, NULL)")
    assert merge("SELECT 2 AS k, 'B' AS v") == 3
    assert rows(spark.table(name)) == [(1, "a"), (2, "B"), (3, None)]
    assert tables.layout_of(spark, site, silver, "t").options["sep"] == ", "


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_one_pass_agrees_with_plain_python(spark, make, merge, rows, format, monkeypatch):
    monkeypatch.setattr(merging, "_few", lambda *_: False)
    name = make(f"(k INT, v STRING, only STRING) USING {format}", ", ".join(f"({n % 40}, 'v{n}', 'o{n}')" for n in range(60)))
    merge("SELECT CAST(id * 3 AS INT) AS k, concat('n', id) AS v FROM range(30) UNION ALL SELECT NULL, 'none'"
          " UNION ALL SELECT NULL, 'none' UNION ALL SELECT 500, 'a' UNION ALL SELECT 500, 'b'")  # fmt: skip
    new = {n * 3: f"n{n}" for n in range(30)}
    expected = [(n % 40, new.get(n % 40, f"v{n}"), f"o{n}") for n in range(60)]
    expected += [(k, v, None) for k, v in new.items() if k >= 40]
    expected += [(None, "none", None)] * 2 + [(500, "a", None), (500, "b", None)]
    assert rows(spark.table(name)) == sorted(expected, key=repr)
    assert spark.table(name).columns == ["k", "v", "only"]
    with pytest.raises(MergeConflict):
        merge("SELECT 3 AS k, 'x' AS v UNION ALL SELECT 3, 'y'")
    assert rows(spark.table(name)) == sorted(expected, key=repr)


def test_one_pass_shuffles_the_target_once(spark, make, merge, site, silver, monkeypatch):
    monkeypatch.setattr(merging, "_few", lambda *_: False)
    make("(k INT, v STRING) USING parquet", "(1, 'a'), (2, 'b')")
    plans = []
    real = replacing.Rewrite.add

    def kept(self, df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(self, df)

    monkeypatch.setattr(replacing.Rewrite, "add", kept)
    merge("SELECT 1 AS k, 'B' AS v UNION ALL SELECT 7, 'n'")
    reads = [plan for plan in plans if "silver" in plan]
    assert len(plans) == 2 and len([p for p in plans if re.search(r"LeftOuter", p)]) == 1
    assert all("LeftOuter" in plan for plan in reads)


def test_counts_need_no_scan(spark, make, site, silver, monkeypatch):
    """After FULL and APPEND the count is what was written; after a stranger's write it is counted."""
    counted = []
    real = type(spark.range(1)).count
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: counted.append(1) or real(self))
    load = lambda n, mode: write_table(spark.range(n), silver, "t", mode, "id", site)
    assert (load(5, "FULL"), load(3, "APPEND"), load(4, "FULL"), load(0, "APPEND")) == (5, 8, 4, 4)
    assert not counted
    spark.sql(f"INSERT INTO {site.table(silver, 't')} VALUES (77L), (78L)")
    assert load(1, "APPEND") == 7 and len(counted) == 1
    assert load(2, "APPEND") == 9 and len(counted) == 1
    assert load(3, "MERGE") == 9


def test_one_repeated_key_is_combined_before_it_travels(spark):
    """However often the changes repeat a key, a task sends it once."""
    changes = spark.range(5000).selectExpr("1 AS k", "id AS v")
    repeated = merging._repeated_keys(changes, ["k"])
    assert [tuple(row) for row in repeated.collect()] == [(1,)]
    plan = repeated._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count")
