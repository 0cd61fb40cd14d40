import duckdb
import numpy as np
import pytest
from test_jaccard import plain_kept
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import oracles, secrets
from strata.llm.common import settle, table
from strata.llm.queries import vocabulary

SCALE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    """Documents, and what each stage makes of them."""
    docs, out = table(spark, SCALE, "documents"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SCALE), name)
        out.append(docs)
    return [df.toPandas() for df in out]


def sql(documents, query):
    connection = duckdb.connect()
    connection.register("documents", documents)
    return connection.execute(query).df()


def test_columns_are_kept(results):
    for df in results[1:-1]:
        assert list(df.columns) == list(results[0].columns)
        assert len(df)


def test_quality(results):
    judged = sql(results[0], oracles.SQL["op8_quality_rules"])
    assert set(results[1].doc_id) == set(judged[judged.kept].doc_id)
    assert len(results[1]) < len(results[0])


def test_near_duplicates(results):
    before, after = results[1].sort_values("doc_id"), results[2]
    assert sorted(after.doc_id) == plain_kept(list(zip(before.doc_id, before.text)))
    assert len(after) < len(before)


def test_secrets(results):
    before, after = (df.set_index("doc_id").text.to_dict() for df in results[2:4])
    assert before.keys() == after.keys()
    assert after == {i: secrets.mask(t, secrets.find(t)) for i, t in before.items()}
    assert before != after
    assert not any(secrets.find(t) for t in after.values())


def test_mixing(results):
    mixed = sql(results[3], oracles.SQL["op2_mixing"])
    sizes = mixed.set_index("doc_id")["size"]
    taken = results[4].groupby("doc_id").size() * sizes
    expected = mixed.set_index("doc_id").taken
    assert taken.dropna().astype(int).to_dict() == expected[expected > 0].to_dict()


def test_packing(results):
    tokenizer = Tokenizer.from_file(vocabulary())
    # A document that is mixed in twice is packed twice; each of its pieces is there twice.
    copies = results[4].groupby("doc_id").size()
    single = results[5][results[5].doc_id.map(copies) == 1]
    expected = {
        i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
        for i, t in results[4].drop_duplicates("doc_id").set_index("doc_id").text.items()
    }
    lengths = results[5].groupby("doc_id").length.sum()
    assert lengths.to_dict() == {i: copies[i] * len(x) for i, x in expected.items()}
    for i, rows in single.groupby("doc_id"):
        ids = b"".join(rows.sort_values("start").ids)
        assert np.frombuffer(ids, "<u4").tolist() == expected[i]
    for _, rows in results[5].groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]]
        assert rows.length.sum() <= 2048 and int(rows.length.sum()).bit_count() == 1


def test_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, q string"
    good = "the cat and the dog of a house in the garden is here and that was it for the day " * 2
    unlike = "one of the other words to be with as by from at this are on in and " * 2
    rows = [(1, None, None, None, None, 1, "q"), (2, "", "en", "a", 0, 1, "q"), (3, good.strip(), "en", None, 9, 1, "q"),
            (3, good.strip(), "en", None, 9, 1, "q"), (4, good.strip(), "en", "a", 9, 1, "q"), (None, unlike, "en", "b", 9, 1, "q")]
    docs = spark.createDataFrame(rows, schema)
    for some in (docs, docs.where("false")):
        now = some
        for name, stage in corpus_pipeline.STAGES:
            now = settle(stage(spark, now, SCALE), name)
            if name != "packing":
                assert now.columns == docs.columns
        assert now.count() == 0 or some is docs
