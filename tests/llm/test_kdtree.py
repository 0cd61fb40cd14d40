import math

import numpy as np
import pytest

from strata.llm import kdtree, queries


def plain(rows, asked, k):
    """rows: (id, vector); asked: ids. Exact, in Python's whole numbers."""
    numbers = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i in asked:
        mine = min((v for j, v in numbers if j == i), default=None)
        if mine is None:
            continue
        scored = [
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(mine, v)))), j) for j, v in numbers if j != i and len(v) == len(mine)
        ]
        for rank, (score, j) in enumerate(sorted(scored)[:k], 1):
            out.append((i, rank, j, -score))
    return sorted(out)


def run(spark, rows, asked, k=10, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, rank int, dim string, shard int")
    got = kdtree.search(df, df.where(df.vec_id.isin(asked)), k)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())


def filled(rows):
    return [(i, v, 1, "x", 2) for i, v in rows]


def test_tree_prunes_and_finds_all():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(3000, 3)) * 1000)
    tree = kdtree.Tree(np.arange(3000), vectors, leaf=16)
    for node in range(len(tree.first)):
        mine = tree.vectors[tree.first[node] : tree.last[node]]
        assert (mine.min(axis=0) == tree.low[node]).all() and (mine.max(axis=0) == tree.high[node]).all()
    asked = vectors[:20]
    found = list(tree.search(np.arange(20), asked, np.full(20, -np.inf), 5))
    scores = asked @ vectors.T
    for q in range(20):
        scores[q, q] = -np.inf
        best = sorted(((-s, i) for i, s in enumerate(scores[q].tolist())))[:5]
        assert sorted((-s, i) for n, i, s in found if n == q) == best


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    got = sorted(map(tuple, queries.QUERIES["op6_kdtree"](spark, path).collect()))
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    assert got == plain(rows, [i for i, _ in rows if i % 100 == 0], 10)


def test_many_shards_ties_and_short_lists(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 40)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(600)]
    rows += [(1000 + i, [0.5, 0.25]) for i in range(4)]
    asked = [*range(0, 60, 7), 1000]
    assert run(spark, filled(rows), asked) == plain(rows, asked, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, 2.0]), (6, [1.0, 2.0]),
            (7, [0.0, -0.0]), (None, [1.0, 1.0]), (8, [-1e-5, 2.0]), (9, [1.0, 2.0, 3.0]), (10, [3.0, 1.0])]
    asked = [1, 2, 3, 4, 5, 6, 7, 9, 10]
    assert run(spark, filled(rows), asked) == plain(rows, asked, 10)
    assert run(spark, [], asked) == []


@pytest.mark.parametrize("size", [1e4, 4e5, 1e30])
def test_large_components(spark, size):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * size).tolist()) for i in range(80)]
    asked = [0, 5, 9]
    assert run(spark, filled(rows), asked, 4, "double") == plain(rows, asked, 4)


def test_copies_of_queries_are_not_broadcast(spark, monkeypatch):
    """A copy of the queries for each shard doesn't fit the driver."""
    plans, settle = {}, kdtree.settle

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return settle(df, name)

    monkeypatch.setattr(kdtree, "settle", kept)
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 40)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(600)]
    asked = list(range(0, 600, 100))
    assert run(spark, filled(rows), asked) == plain(rows, asked, 10)
    for name in ("found-first", "found-rest"):
        assert "MapInArrow" in plans[name] and "Broadcast" not in plans[name]


@pytest.mark.parametrize("size", [1, 1e5, 1e12])
def test_many_groups_of_queries(spark, monkeypatch, size):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 40)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(kdtree, "GROUP_BYTES", 64)
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=4) * size).tolist()) for i in range(300)]
    rows += [(i, (rng.normal(size=3) * size).tolist()) for i in range(300, 400)]
    asked = list(range(0, 400, 9))
    assert run(spark, filled(rows), asked, 5, "double") == plain(rows, asked, 5)


def test_a_block_of_queries_searches_as_each_alone():
    rng = np.random.default_rng(8)
    vectors = rng.integers(-9, 10, (2000, 5)).astype(float)
    ids = rng.integers(0, 1500, 2000)  # repeated ones too
    tree = kdtree.Tree(ids, vectors, leaf=16)
    asked, asking = vectors[:90], ids[:90]
    for k in (1, 7, 3000):
        for floor in (-np.inf, 150.0):
            found, floors = [], []
            for search in (tree._search_block, tree._search_each):
                floors.append(np.full(90, floor))
                found.append(sorted(search(asking, asked, floors[-1], k)))
            assert found[0] == found[1]
            assert (floors[0] == floors[1]).all()


def test_blocks_reach_few_leaves(monkeypatch):
    """In few dimensions most leaves are cut off."""
    rng = np.random.default_rng(9)
    vectors = np.floor(rng.normal(size=(20_000, 2)) * 1000)
    tree, met = kdtree.Tree(np.arange(20_000), vectors, leaf=16), []
    tree.vectors = Counted(tree.vectors, met)
    found = list(tree._search_block(np.arange(50), vectors[:50], np.full(50, -np.inf), 5))
    assert len(found) == 250 and sum(met) < 20_000 // 2


class Counted(np.ndarray):
    """Vectors that note how many rows are cut out of them."""

    def __new__(cls, vectors, met):
        made = np.asarray(vectors).view(cls)
        made.met = met
        return made

    def __array_finalize__(self, other):
        self.met = getattr(other, "met", None)

    def __getitem__(self, key):
        made = np.asarray(self)[key]
        if isinstance(key, slice):
            self.met.append(len(made))
        return made
