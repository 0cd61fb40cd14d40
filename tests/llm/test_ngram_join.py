import random
import re

import numpy as np
import pytest

from strata.llm import ngram_join, queries
from strata.llm.ngram_join import grams, parts, signatures, size_class, trie_links


def plain_grams(text, width=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    width = min(width, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def linked(x, y, least=9, of=10):
    return bool(x) and bool(y) and of * len(x & y) >= least * len(x | y)


def roots(n, pairs):
    at = list(range(n))
    for a, b in pairs:
        x, y = at[a], at[b]
        if x != y:
            at = [min(x, y) if r in (x, y) else r for r in at]
    return at


def plain(rows, width=3, least=9, of=10):
    """(id, size, component) of rows (id, text)."""
    sets = [plain_grams(t, width) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if linked(sets[a], sets[b], least, of)]
    at, ids = roots(len(rows), pairs), [i for i, _ in rows]
    least_of = {r: min((i for i, q in zip(ids, at) if q == r and i is not None), default=None) for r in at}
    return sorted(((i, len(s), least_of[r]) for i, s, r in zip(ids, sets, at)), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, size int, node string")
    got = ngram_join.similar_texts(df, **options).collect()
    return sorted(map(tuple, got), key=repr)


def changed(draw, words, share):
    return [draw.choice("qrstuvw") * 3 + str(draw.randrange(99)) if draw.random() < share else w for w in words]


def near_copies(draw, n, size, share):
    base = [f"w{draw.randrange(400)}" for _ in range(size)]
    return [" ".join(changed(draw, base, share)) for _ in range(n)]


def hashed(sets):
    names = {}
    return [np.unique(np.array([names.setdefault(g, draw_hash(len(names))) for g in s], np.uint64)) for s in sets]


def draw_hash(n):
    return int(ngram_join._mixed(np.array([n + 1], np.uint64))[0])


@pytest.mark.parametrize("similar", [(9, 10), (4, 5), (1, 2)])
def test_trie_joins_what_all_pairs_join(similar):
    draw = random.Random(1)
    for _ in range(120):
        base = [draw.randrange(60) for _ in range(draw.randrange(1, 40))]
        made = {
            frozenset(x for x in [*base, *draw.sample(range(60, 90), 3)] if draw.random() > draw.choice([0, 0.05, 0.4]))
            for _ in range(draw.randrange(1, 40))
        }
        sets = [s for s in made if s]
        cut = draw.choice([len(sets), len(sets) // 2])
        found = trie_links(*(lambda h: (h[:cut], h[cut:]))(hashed(sets)), similar)
        n = range(len(sets))
        every = [(a, b) for a in n for b in range(a) if linked(sets[a], sets[b], *similar) and b < cut]
        assert all(linked(sets[a], sets[b], *similar) for a, b in found)
        assert roots(len(sets), found) == roots(len(sets), every)
        assert len(found) < max(1, len(sets))


@pytest.mark.parametrize("similar", [(9, 10), (4, 5)])
def test_linked_sets_share_a_signature(similar):
    draw = np.random.default_rng(2)
    least, of = similar
    for size in [*range(1, 60), *([9, 10, 19] * 30), 333, 1000]:
        one = np.unique(draw.integers(0, 1 << 63, size, np.uint64) * np.uint64(2))
        for less in range(0, (of - least) * size // of + 1):
            other = draw.permutation(one)[: len(one) - less]
            grown = 0
            while of * len(other) >= least * (len(one) + grown + 1) and draw.random() < 0.5:
                grown += 1
            other = np.unique(np.concatenate([other, draw.integers(0, 1 << 63, grown, np.uint64)]))
            both = len(np.intersect1d(one, other))
            if len(other) and of * both >= least * len(np.union1d(one, other)):
                assert len(np.intersect1d(signatures(one, similar), signatures(other, similar)))


def test_classes():
    for size in range(1, 2000):
        assert size_class(size) <= size_class(size + size // 9) <= size_class(size) + 1
    assert [parts(size_class(n)) for n in (1, 8)] == [1, 1]


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    got = queries.QUERIES["op13_ngram_join"](spark, path)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    expected = plain(rows)
    assert sum(r[0] != r[2] for r in expected) > 5
    assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_odd_rows(spark):
    draw = random.Random(3)
    base = [f"w{n}" for n in range(40)]
    rows = [(9, None), (3, None), (4, ""), (5, " \t"), (7, "a b"), (6, "A  b"), (6, "a b"), (8, "a"), (None, "a"), (None, "z z z z"),
            (11, " ".join(base)), (12, " ".join([*base, "x"])), (13, " ".join([*base, "x", "y"])), (14, " ".join(["q", *base])),
            (15, " ".join(base * 3)), (1, " ".join([*base[:20], "mid", *base[20:]])), (16, "ÄÖ é" * 3), (17, "äö é" * 3)]
    rows += enumerate(near_copies(draw, 30, 60, 0.02), 100)
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, rows, width=2, similar=(1, 2)) == plain(rows, 2, 1, 2)


def test_large_groups_in_many_slices(spark, monkeypatch):
    """Slices of eight sets: groups that hang together, and one whose members are nearly alike."""
    monkeypatch.setattr(ngram_join, "SLICE_SETS", 8)
    draw = random.Random(4)
    rows = list(enumerate(near_copies(draw, 60, 150, 0.004) + near_copies(draw, 60, 90, 0.02) + near_copies(draw, 40, 120, 0.03)))
    draw.shuffle(rows)
    expected = plain(rows)
    assert 10 < len({r[2] for r in expected}) < 150
    assert run(spark, rows) == expected


def test_texts_that_share_one_passage_make_no_pairs(spark):
    """Work on texts of one long common passage follows their number."""
    draw = random.Random(5)
    passage = [f"p{n}" for n in range(100)]
    texts = [" ".join([*passage, *(f"u{draw.randrange(10**6)}" for _ in range(50))]) for _ in range(300)]
    sets = [grams(t) for t in texts]
    assert trie_links(sets, []) == []
    rows = list(enumerate(texts))
    assert run(spark, rows) == sorted(((i, len(s), i) for (i, _), s in zip(rows, sets)), key=repr)
