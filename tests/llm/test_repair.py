import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import queries, repair
from strata.llm.queries import vocabulary

SCALE = "/root/testdata/sf0.001"


def round_trip(documents):
    g = repair.compress(documents)
    ids = repair.Expansions(g.left, g.right, g.lengths).expand(g.symbols)
    assert ids.tolist() == np.concatenate(documents).tolist()
    ends = np.cumsum(g.doc_symbols)
    sizes = np.where(g.symbols < repair.TERMINALS, 1,
                     np.append(g.lengths, 0)[np.maximum(g.symbols - repair.TERMINALS, 0)])
    for k, document in enumerate(documents):  # no rule crosses documents
        assert sizes[ends[k] - g.doc_symbols[k] : ends[k]].sum() == len(document)
    return g


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=300), min_size=1, max_size=6))
def test_any_documents_come_back(documents):
    round_trip([np.array([*d, repair.END], np.uint16) for d in documents])


def test_repeats_become_rules():
    words = [np.array(w) for w in ([5, 6, 7, 8], [9, 9, 9, 9, 9], [11, 12])]
    rng = np.random.default_rng(1)
    documents = [
        np.concatenate([words[i] for i in rng.integers(0, 3, 400)] + [[repair.END]]).astype(np.uint16)
        for _ in range(5)
    ]
    g = round_trip(documents)
    assert len(g.symbols) < sum(map(len, documents)) / 3
    assert g.lengths.max() >= 8
    symbols = g.symbols[: g.doc_symbols[0]]
    whole = documents[0].tolist()
    for start, stop in ((0, 5), (17, 18), (100, 900), (len(whole) - 3, len(whole)), (40, 40)):
        assert repair.decode_part(symbols, g.left, g.right, g.lengths, start, stop) == whole[start:stop]


def test_long_runs_and_short_blocks():
    round_trip([np.append(np.full(5000, 7), repair.END).astype(np.uint16)])
    round_trip([np.array([repair.END], np.uint16)] * 3)


def plain(spark, rows):
    tokenizer = Tokenizer.from_file(vocabulary())
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_the_tokenizer(spark):
    got = queries.QUERIES["op3_token_files"](spark, SCALE).collect()
    docs = spark.read.parquet(f"{SCALE}/documents.parquet").orderBy("doc_id")
    expected = plain(spark, [(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(tuple(r) for r in got) == expected


@pytest.mark.parametrize("partitions", [1, 3])
def test_odd_rows(spark, tmp_path, partitions):
    schema = "doc_id long, text string, shard string, ids int"
    rows = [(None, "a b", None, None), (1, None, "x", 1), (2, "", "x", 1), (3, "the cat " * 3000, "x", 1),
            (4, "dog", "x", 1), (4, "the cat", "x", 1), (4, "the cat", "x", 1)]
    docs = spark.createDataFrame(rows[::-1], schema).repartition(partitions)
    repair.write(docs, str(tmp_path / "a"), vocabulary())
    got = repair.read(spark, str(tmp_path / "a")).collect()
    made = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in sorted(got, key=lambda r: r.start)]
    assert made == plain(spark, [r[:2] for r in rows])
    repair.write(docs.where("false"), str(tmp_path / "b"), vocabulary())
    assert repair.read(spark, str(tmp_path / "b")).count() == 0


def test_pairs_are_replaced_until_none_pays():
    """Copies become a symbol or two each, whatever their number; no frequent pair is left."""
    rng = np.random.default_rng(6)
    doc = np.append(rng.integers(3, 40000, 511), repair.END).astype(np.uint16)
    grammar = repair.compress([doc] * 500)
    assert len(grammar.symbols) <= 1000 and len(grammar.left) < 600 and grammar.lengths.max() == 511
    docs = [np.append(rng.zipf(1.3, 400) % 5000 + 3, repair.END).astype(np.uint16) for _ in range(60)]
    grammar = repair.compress(docs)
    expanded = repair.Expansions(grammar.left, grammar.right, grammar.lengths).expand(grammar.symbols)
    assert (expanded == np.concatenate(docs)).all()
    counts = {}
    for left, right in zip(grammar.symbols[:-1].tolist(), grammar.symbols[1:].tolist()):
        if repair.END not in (left, right) and left != right:
            counts[left, right] = counts.get((left, right), 0) + 1
    assert max(counts.values()) < 2 * repair.LEAST_USES


def test_rounds_look_only_at_what_may_be_frequent(monkeypatch):
    """The places looked at in all rounds are a few times those of the block."""
    looked = []
    count = repair._Sequence.count
    monkeypatch.setattr(
        repair._Sequence, "count", lambda self, places: looked.append(len(places)) or count(self, places)
    )
    rng = np.random.default_rng(8)
    docs = [np.append(rng.zipf(1.2, 2000) % 30000 + 3, repair.END).astype(np.uint16) for _ in range(50)]
    round_trip(docs)
    assert 0 < sum(looked) < 8 * sum(map(len, docs)), sum(looked) / sum(map(len, docs))
