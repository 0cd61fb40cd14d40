import numpy as np
import pytest

from strata.llm import sharding

NAMES = [f"s{n}" for n in range(20)]


def test_shares_differ_by_one_slot():
    owner = sharding.fill(NAMES)
    shares = np.bincount(owner, minlength=20)
    assert (owner >= 0).all() and len(owner) == sharding.prime_from(2000)
    assert shares.max() - shares.min() <= 1


def test_fill_against_the_definition():
    """Whole preference lists, written out."""
    names, size = ["a", "b", "c"], 31
    order = {}
    for name in names:
        offset = sharding._number(f"offset:{name}") % size
        skip = sharding._number(f"skip:{name}") % (size - 1) + 1
        order[name] = [(offset + j * skip) % size for j in range(size)]
        assert sorted(order[name]) == list(range(size))
    owner = {}
    while len(owner) < size:
        for k, name in enumerate(names):
            if len(owner) < size:
                owner[next(slot for slot in order[name] if slot not in owner)] = k
    assert sharding.fill(names, 31).tolist() == [owner[slot] for slot in range(size)]


def test_few_slots_move_when_a_shard_goes():
    before, after = sharding.fill(NAMES, 2003), sharding.fill(NAMES[:-1], 2003)
    stayed = (before == after)[before != 19].mean()
    assert stayed > 0.8


def test_tables_that_do_not_suit():
    for shards, slots in (([], None), (["a", "a"], None), (["a"], sharding.MOST_SLOTS + 1), (NAMES, 7)):
        with pytest.raises(ValueError):
            sharding.fill(shards, slots)


def test_odd_rows(spark):
    schema = "doc_id long, text string, slot int"
    df = spark.createDataFrame(
        [(1, "x", 1), (1, "y", None), (None, None, None), (None, "", 2), (2, "long " * 50000, 3)], schema
    )
    got = sharding.place(df, ["doc_id"], NAMES)
    assert got.count() == 5 and set(df.columns) < set(got.columns)
    by = {}
    for r in got.collect():
        assert by.setdefault(r.doc_id, r.shard) == r.shard
    texts = sharding.place(df, ["text"], NAMES).select("shard_slot").collect()
    assert len({r[0] for r in texts}) == 5  # null and empty are keys of their own
    assert sharding.place(df.where("false"), ["doc_id"], NAMES).count() == 0
    with pytest.raises(ValueError):
        sharding.place(df.withColumn("shard", df.slot), ["doc_id"], NAMES)


def test_a_hot_key_can_be_spread(spark):
    df = spark.range(20000).selectExpr("'hot' AS source", "id")
    assert sharding.place(df, ["source"], NAMES).select("shard").distinct().count() == 1
    counts = sharding.place(df, ["source"], NAMES, spread=["id"]).groupBy("shard").count().collect()
    assert len(counts) == 20 and max(r["count"] for r in counts) < 1300


def test_the_table_is_broadcast(spark):
    plan = sharding.place(spark.range(10), ["id"], NAMES)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_rows_are_written_by_shard(spark, tmp_path):
    """Whole rows come back from their shards, a hot key's from many."""
    names = [f"s{n}" for n in range(8)]
    docs = spark.range(4000).selectExpr(
        "IF(id % 50 = 0, NULL, id) AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id % 40 AS STRING)) AS source",
        "repeat('t', CAST(id % 7 AS INT)) AS text", "id AS slot",
    )
    placed = sharding.place(docs, ["source"], names, spread=["doc_id"])
    path = f"{tmp_path}/shards"
    sharding.write(placed, path)
    held = sharding.read(spark, path, placed.schema)
    assert held.schema.names == placed.schema.names
    assert sorted(map(repr, held.collect())) == sorted(map(repr, placed.collect()))
    hot = held.where("source = 'hot'").groupBy("shard").count().collect()
    assert len(hot) == 8 and max(r["count"] for r in hot) < 2 * 1334 / 8 + 40
    shards = {f.rsplit("/", 2)[1] for f in spark.read.parquet(path).inputFiles()}
    assert shards == {f"shard={name}" for name in names}
    empty = f"{tmp_path}/none"
    sharding.write(placed.where("false"), empty)
    assert sharding.read(spark, empty, placed.schema).count() == 0
