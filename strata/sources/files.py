"""Landed files as DataFrames: a path, a directory or a glob, read by Spark's own readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources import csv_types, json_arrays

SUPPORTED_FORMATS = ("csv", "json", "parquet", "delta")


def read_source(
    spark: SparkSession,
    path: str | None,
    fmt: str | None = "csv",
    delim: str | None = ",",
    schema: StructType | str | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Scan landed files.

    CSV has a header; its types are inferred from all rows, for which the text is read once into a
    columnar stage, unless ``schema`` gives them, and then a file whose header has other columns is
    an error. A JSON file holds one document or one array; an array larger than a partition of
    files is cut into its elements by many tasks first. ``scratch`` is a folder for what that
    writes, which the caller removes when the frame is done with; else it goes with the application.
    """
    path = (path or "").strip()
    fmt = (fmt or "").strip().lower() or "csv"
    if not path:
        raise ValueError("This load names no files: its SOURCE_URL is blank.")
    if path.lower().startswith(("http://", "https://")):
        raise ValueError(
            f"'{path}' must be landed on shared storage first; sources are read from there."
        )
    if fmt == "csv":
        # A lone tab is a separator, not padding.
        sep = (delim or "").strip(" ") or ","
        if schema is not None:
            return spark.read.csv(path, schema, header=True, sep=sep, enforceSchema=False)
        texts = spark.read.csv(path, header=True, sep=sep)
        if not texts.columns:
            return texts
        folder = f"{scratch or new_folder(spark)}/texts"
        # Numbered, as a header may have names that a columnar file can't.
        numbered = [f"c{n}" for n in range(len(texts.columns))]
        texts.toDF(*numbered).write.parquet(folder)
        held = spark.read.schema(", ".join(f"{c} STRING" for c in numbered)).parquet(folder)
        return csv_types.typed(held.toDF(*texts.columns))
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "json":
        lines = _large_arrays_as_lines(spark, path, scratch)
        return reader.json(lines) if lines else reader.json(path, multiLine=True)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "delta":
        return spark.read.format("delta").load(path)
    raise ValueError(f"Unsupported format '{fmt}'. Supported: {', '.join(SUPPORTED_FORMATS)}.")


def _large_arrays_as_lines(spark: SparkSession, path: str, scratch: str | None) -> str | None:
    """Where the elements are, if any of the files is too large for one task."""
    most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    # From the listing alone.
    listed = spark.read.text(path)
    if int(listed._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= most:
        return None
    sizes = spark.read.format("binaryFile").load(path).select("length")
    if sizes.where(F.col("length") > most).isEmpty():
        return None
    folder = scratch or new_folder(spark)
    return f"{folder}/lines" if json_arrays.as_lines(spark, listed.inputFiles(), folder) else None


def scratch_folder(spark: SparkSession) -> str:
    """A new name in the shared folder, or the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/source-{uuid.uuid4().hex}"


def new_folder(spark: SparkSession) -> str:
    """A folder that goes with the application."""
    folder = scratch_folder(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder
