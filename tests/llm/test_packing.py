import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import packing, queries
from strata.llm.queries import vocabulary

SCALE = "/root/testdata/sf0.001"


def test_level_makes_the_sum_of_squares_smallest():
    rng = np.random.default_rng(7)
    shelf = packing.Shelf(window=32, most_open=10**6)
    for size in rng.integers(1, 32, 500):
        counts = [0, *(len(level) for level in shelf.levels[1:])]

        def squares(level, counts=counts, size=size):
            after = list(counts) + [0]
            after[level] -= level > 0
            after[level + size] += level + size < 32
            return sum(n * n for n in after[1:32])

        usable = [0, *(h for h in range(1, 33 - size) if counts[h])]
        assert squares(shelf.level_for(size)) == min(map(squares, usable))
        list(shelf.add(1, np.zeros(size, np.uint16)))


def check(pieces, expected, window=packing.WINDOW):
    """pieces: (doc_id, start, ids, sequence_id, offset); expected: ids by doc_id."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for doc_id, start, ids, sequence_id, offset in pieces:
        documents[doc_id].append((start, ids))
        sequences[sequence_id].append((offset, len(ids)))
    assert documents.keys() == expected.keys()
    for doc_id, parts in documents.items():
        assert [x for _, ids in sorted(parts) for x in ids] == expected[doc_id]
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= window and at.bit_count() == 1  # full, or a power of two: no padding


def test_query_against_the_tokenizer(spark):
    rows = packing.pack(spark.read.parquet(f"{SCALE}/documents.parquet"), vocabulary()).collect()
    texts = spark.read.parquet(f"{SCALE}/documents.parquet").collect()
    tokenizer = Tokenizer.from_file(vocabulary())
    expected = {
        r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in texts
    }
    check(
        [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist(), r.sequence_id, r.offset) for r in rows],
        expected,
    )
    got = queries.QUERIES["op7_packing"](spark, SCALE).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = np.array(expected[r.doc_id][r.start : r.start + r.length], "<u4")
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(ids.tobytes()), len(expected[r.doc_id]))


def test_many_open_windows_are_drained():
    shelf = packing.Shelf(window=16, most_open=4)
    expected, done = {}, []
    for doc_id in range(200):
        ids = np.arange(doc_id, doc_id + 9 + doc_id % 5, dtype=np.uint16)
        expected[doc_id] = ids.tolist()
        done += shelf.add(doc_id, ids)
        assert shelf.open <= 4
    done += shelf.drain()
    rows, at = [], 0
    for n, pieces in enumerate(done):
        at = 0
        for doc_id, start, ids, _ in pieces:
            rows.append((doc_id, start, ids.tolist(), n, at))
            at += len(ids)
    check(rows, expected, 16)


def test_odd_rows(spark):
    schema = "doc_id long, text string, start string, ids int"
    docs = spark.createDataFrame(
        [(1, None, "x", 1), (2, "", "x", 1), (None, "a b", None, None), (3, "the cat " * 5000, "x", 1),
         (4, "the cat", "x", 1), (4, "the cat", "x", 1)],
        schema,
    )
    rows = packing.pack(docs, vocabulary()).collect()
    lengths = defaultdict(int)
    for r in rows:
        lengths[r.doc_id] += r.length
    assert lengths == {1: 1, 2: 1, None: 3, 3: 10001, 4: 6}
    assert packing.pack(docs.where("false"), vocabulary()).count() == 0
    assert packing.pack(docs.repartition(4), vocabulary()).agg(F.sum("length")).first()[0] == 10012
