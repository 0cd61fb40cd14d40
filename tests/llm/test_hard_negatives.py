import math
from fractions import Fraction

import numpy as np
import pytest

from strata.llm import hard_negatives, queries
from strata.llm.hard_negatives import Bucket


def plain(rows, asked, positives=5, negatives=10):
    """rows: (id, label, vector); asked: ids. In Python's whole numbers."""
    numbers = [
        (i, label, [math.floor(256 * float(x)) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor in asked:
        own = min(((label, v) for i, label, v in numbers if i == anchor), default=None)
        if own is None:
            continue
        label, mine = own
        scored = sorted(
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(mine, v)))), i, other == label)
            for i, other, v in numbers
            if i != anchor and len(v) == len(mine)
        )
        for p, positive, _ in [x for x in scored if x[2]][:positives]:
            p = -p
            hard = [(i, -s) for s, i, same in scored if not same and 30 * p <= -100 * s <= 90 * p]
            for rank, (i, s) in enumerate(hard[:negatives], 1):
                out.append((anchor, positive, rank, i, p, s))
    return sorted(out)


def run(spark, rows, asked, kind="float"):
    rows = [(*row, 1, 2, "x") for row in rows]
    df = spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>, bucket int, key int, v string")
    return sorted(map(tuple, hard_negatives.mine(df, df.where(df.vec_id.isin(asked))).collect()))


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    got = queries.QUERIES["op12_hard_negatives"](spark, path)
    assert got.dtypes[2] == ("rank", "int") and {t for c, t in got.dtypes if c != "rank"} == {"bigint"}
    rows = [
        (r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, list(r.embedding))
        for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()
    ]
    assert sorted(map(tuple, got.collect())) == plain(rows, [i for i, _, _ in rows if i % 100 == 0])


def test_many_buckets_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(3)), [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(500)]
    rows += [(1000 + i, 0, [1.0, 1.0, 2.0, 0.0]) for i in range(150)]  # one hot vector
    rows += [(2000 + i, i % 2, [0.5, 0.25]) for i in range(6)]
    asked = [*range(0, 60, 7), 1000, 2000]
    assert run(spark, rows, asked) == plain(rows, asked)


def test_ranges_prune_and_lose_nothing():
    """Clustered vectors of one length and few dimensions: most rows are never verified."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 5))
    centres *= 1000 / np.linalg.norm(centres, axis=1, keepdims=True)
    vectors = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 5)) * 20)
    bucket = Bucket(np.arange(4000), np.zeros(4000, np.int64), vectors)
    verified = 0
    for n in range(0, 4000, 97):
        scores = (vectors @ vectors[n]).astype(np.int64)
        least = int(0.98 * scores[n])
        rows = bucket.candidates(vectors[n], float(np.linalg.norm(vectors[n])), least)
        rows = np.arange(4000) if rows is None else rows
        assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist())
        verified += len(rows)
    assert verified < 0.2 * 42 * 4000
    assert not len(bucket.candidates(vectors[0], float(np.linalg.norm(vectors[0])), 10**12))


def test_random_vectors_are_all_found():
    rng = np.random.default_rng(6)
    for dim in (1, 2, 3, 8):
        vectors = np.floor(rng.normal(size=(300, dim)) * rng.choice([1, 50, 3000], (300, 1)))
        bucket = Bucket(np.arange(300), rng.integers(0, 2, 300), vectors)
        for n in range(0, 300, 11):
            scores = vectors @ vectors[n]
            for least in np.quantile(scores, [0.3, 0.9, 0.99]).astype(int).tolist():
                got = list(bucket.best(n, 0, vectors[n], [(7, least, 2**62)], True, 300))
                wanted = np.flatnonzero((scores >= least) & (bucket.labels == 0) & (bucket.ids != n))
                assert sorted(i for _, i, _ in got) == wanted.tolist()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, None), (2, 1, []), (3, 1, [1.0, None]), (4, 1, [nan, 1.0]), (5, 1, [inf, 1.0]), (6, 1, [1.0, 2.0]),
            (6, 1, [1.0, 2.0]), (7, 1, [0.0, -0.0]), (None, 1, [1.0, 1.0]), (8, None, [-1e-5, 2.0]), (9, 1, [1.0, 2.0, 3.0]),
            (10, 1, [3.0, 1.0]), (11, 2, [0.5, 1.0]), (11, 2, [0.5, 1.0]), (12, 2, [0.0, 0.0]), (13, 2, [1.0, 0.5])]
    asked = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12]
    assert run(spark, rows, asked) == plain(rows, asked)
    assert run(spark, rows, []) == []
    assert run(spark, [], asked) == []
    with pytest.raises(ValueError):
        df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
        hard_negatives.mine(df, df, least=Fraction(1), most=Fraction(1, 2))


@pytest.mark.parametrize("size", [1e4, 4e5, 1e6, 1e30])
def test_large_components(spark, size):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, (rng.normal(size=6) * size).tolist()) for i in range(60)]
    asked = [0, 5, 9]
    assert run(spark, rows, asked, "double") == plain(rows, asked)
