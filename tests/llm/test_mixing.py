from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing

SCALE = "/root/testdata/sf0.01"


def plain_targets(sizes):
    """Share by weight, cut at the limit, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        spare = budget - sum(target[s] for s in names if s not in open_)
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] = spare * weight[s] / total
        above = {s for s in open_ if target[s] >= 2 * sizes[s]}
        for s in above:
            target[s] = 2.0 * sizes[s]
        if not above:
            break
        open_ -= above
    return target


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10}, {"a": 1000, "b": 10, "c": 10, "d": 500, "ä": 3, None: 70}, {"a": 0, "b": 5},
     {f"s{i}": (i * 37) % 101 + 1 for i in range(50)}],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    expected = plain_targets(sizes)
    assert got.keys() == expected.keys()
    for s in got:
        assert got[s] == pytest.approx(expected[s])


def test_words_come_near_the_targets(spark):
    docs = spark.read.parquet(f"{SCALE}/documents.parquet")
    rows = mixing.plan(docs).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    for s, wanted in target.items():
        assert abs(taken[s] - wanted) <= 0.01 * wanted, s
    again = mixing.plan(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)


def test_probabilities_are_unequal(spark):
    """The first of two sources weighs more and reaches its limit, so the other is sampled: large
    documents more often."""
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.lit("s").alias("source"),
        F.expr("repeat('w ', cast(if(id % 2 = 0, 1, 32) as int))").alias("text"),
    )
    other = spark.createDataFrame([(9999, "a", "w " * 6000)], "doc_id long, source string, text string")
    rows = [r for r in mixing.plan(docs.union(other)).collect() if r.source == "s"]
    small = sum(r.copies for r in rows if r.size == 1) / 1000
    large = sum(r.copies for r in rows if r.size == 32) / 1000
    assert large > small > 0


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, its_source string, q int, row int, size string"
    docs = spark.createDataFrame(
        [(1, "a b c", "x", "i", 1, 2, "s"), (1, "a b c", "x", "i", 1, 2, "s"), (None, "a", None, None, None, None, None),
         (2, None, "x", None, None, None, None), (3, "", "y", "i", 1, 2, "s"), (4, "w " * 50000, "y", "i", 1, 2, "s")],
        schema,
    )
    rows = mixing.plan(docs).collect()
    assert len(rows) == 6
    assert len({r.copies for r in rows if r.doc_id == 1}) == 1
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    want = sorted(repr(r.doc_id) for r in rows for _ in range(r.copies))
    assert sorted(repr(r.doc_id) for r in out.collect()) == want
    assert mixing.plan(docs.where("false")).count() == mixing.mixed(docs.where("false")).count() == 0
    nothing = docs.where("text IS NULL")
    assert [r.target for r in mixing.plan(nothing).collect()] == [0.0]
