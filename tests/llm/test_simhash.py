import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import queries, simhash
from strata.llm.common import settle

SCALE = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        text = text.replace(blank, " ")
    words = [word for word in text.split(" ") if word]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{position: smallest id reached} by comparing all pairs."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(rows))]


@pytest.mark.parametrize(
    "text",
    [None, "", " \n\x0b ", "One", "one two three", "A b\tC d", "Ünï cödé ÀB x y", "x " * 500,
     "  no break", " ".join(str(i % 7) for i in range(70000))],
)
def test_fingerprint(text):
    if text and len(text) > 10000:
        assert simhash.fingerprint(text) == simhash.fingerprint(text + " ")
    else:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_bit_sliced_distances():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 130, dtype=np.uint64)
    near = base.copy()
    for k in range(130):
        for bit in rng.choice(64, k % 9, replace=False):
            near[k] ^= np.uint64(1) << np.uint64(bit)
    wanted = np.full((130, 3), 2**64 - 1, np.uint64)
    rows, lanes = simhash.within_radius(base, simhash.planes(near), wanted)
    hits = np.unpackbits(lanes.view(np.uint8), axis=1, bitorder="little")[:, :130]
    found = {(int(r), int(c)) for r, hit in zip(rows, hits) for c in np.flatnonzero(hit)}
    distance = np.bitwise_count(base[:, None] ^ near[None, :])
    assert found == {(int(r), int(c)) for r, c in np.argwhere(distance <= 4)}


@pytest.mark.parametrize("slice_size", [8192, 7])
def test_components_of_fingerprints(spark, monkeypatch, slice_size):
    monkeypatch.setattr(simhash, "SLICE", slice_size)
    rnd = random.Random(5)
    points = [rnd.getrandbits(64) for _ in range(60)]
    for start in points[:12]:  # chains of growing distance, and stars
        now = start
        for _ in range(12):
            for bit in rnd.sample(range(64), rnd.randint(1, 5)):
                now ^= 1 << bit
            points.append(now)
    points += points[:20]
    rows = [(i, p) for i, p in enumerate(points)]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in rows]
    df = settle(spark.createDataFrame(signed, "doc_id long, fingerprint long"), "test")
    got = df.join(simhash.label(df), "fingerprint").select("doc_id", "component_id").collect()
    assert [r.component_id for r in sorted(got)] == plain_components(rows)


def test_query_against_brute_force(spark):
    got = queries.QUERIES["op5_simhash"](spark, SCALE).collect()
    texts = spark.read.parquet(f"{SCALE}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in sorted(texts)]
    expected = [
        (i, f"{f:016x}", c) for (i, f), c in zip(rows, plain_components(rows), strict=True)
    ]
    assert sorted(map(tuple, got)) == expected


def test_odd_rows(spark):
    schema = "doc_id long, text string, fingerprint string, component_id int"
    odd = spark.createDataFrame(
        [(3, None, "x", 1), (2, "", "y", 2), (5, "a b", "z", 3), (5, "a b", "z", 3),
         (None, "a b", None, None), (None, "all alone here", None, None),
         (None, "all alone here", None, None)],
        schema,
    )
    got = simhash.near_duplicates(odd).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [
        (0, 0), (0, 0), (0, 5), (2, 2), (3, 2), (5, 5), (5, 5)
    ]
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert by[(3, 0)] == by[(2, 0)] == 2
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 5]
    none = odd.where("false")
    assert simhash.near_duplicates(none).count() == simhash.deduplicate(none).count() == 0


def test_no_copies_reach_one_task(spark):
    """Copies fall together before any pair is made."""
    df = spark.range(5000).select("id", F.lit("the very same text here").alias("text"))
    got = simhash.near_duplicates(df, "id")
    assert got.select("component_id").distinct().collect() == [(0,)]
