"""What the operators share: tables, the shared scratch folder, and words."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The six ASCII characters that separate words, as characters and as a class of a pattern.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK_CLASS}]+"

#: Bytes of a batch, where the session has Spark's default (64 MB). A batch lies outside the heap,
#: on its way in and out, and in the worker.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES, DEFAULT_BATCH_BYTES = "4m", "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="strata-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is named: the warehouse, or for a session on one
    machine a folder there."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith(("local[", "local-cluster")) or (
        spark.sparkContext.master == "local"
    ):
        return _local_folder()
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is there goes when the application ends."""
    folder = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    jvm_folder = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = jvm_folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(jvm_folder)
    files.deleteOnExit(jvm_folder)
    return f"{folder}/data"


def settle(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and reread.

    Cuts the lineage, so that a lost executor costs no more than its running tasks, and gives the
    planner real sizes.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """mapInArrow over batches of bounded bytes, for rows that hold whole texts.

    Sets the session's batch size, which holds when the frame runs, unless one was chosen.
    """
    spark = df.sparkSession
    if spark.conf.get(_BATCH_BYTES, DEFAULT_BATCH_BYTES) == DEFAULT_BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)
    return df.mapInArrow(function, schema)


def words(text: Column) -> Column:
    """The text's words as an array; a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{BLANK_CLASS}]+")
    )
