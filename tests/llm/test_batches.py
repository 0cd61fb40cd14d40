import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import jaccard, packing, secrets
from strata.llm.common import map_batches
from strata.llm.queries import vocabulary

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def batch_bytes(spark):
    """The session with Spark's default, and its own value again afterwards."""
    before = spark.conf.get(BYTES)
    spark.conf.unset(BYTES)
    yield spark.conf
    spark.conf.set(BYTES, before)


def sizes(spark, rows):
    """Rows and bytes of the batches of so many texts of six thousand characters."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    texts = spark.range(0, rows, 1, 1).select("id", F.repeat(F.lit("abcde "), 1000).alias("text"))
    return map_batches(texts, run, "n long, bytes long").collect()


def test_batches_of_long_texts_are_small(spark, batch_bytes):
    got = sizes(spark, 6000)
    assert sum(r.n for r in got) == 6000
    assert max(r.bytes for r in got) < 8 << 20


def test_a_chosen_size_stays(spark, batch_bytes):
    batch_bytes.set(BYTES, "1m")
    got = sizes(spark, 600)
    assert max(r.bytes for r in got) < 2 << 20
    assert batch_bytes.get(BYTES) == "1m"


@pytest.mark.parametrize(
    "stage", [jaccard.deduplicate, secrets.redact, lambda docs: packing.pack(docs, vocabulary())]
)
def test_the_pipeline_reads_texts_in_small_batches(spark, batch_bytes, stage):
    stage(spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string"))
    assert batch_bytes.get(BYTES) == "4m"
