"""A site of its own for one query, so that queries do not see each other's tables."""

from __future__ import annotations

import functools
import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from strata import Site, run_group
from strata.plans import config
from strata.schemas import GROUP, LINEAGE_COLUMNS


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="strata-")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is named, the warehouse, or for a session on one
    machine a folder there."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root()
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def _gone_at_exit(spark: SparkSession, folder: str) -> None:
    """Results are read lazily, so a query's tables stay until the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, name: str) -> None:
        unique = f"{name}_{uuid.uuid4().hex[:10]}"
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.scratch = f"{shared_root(spark)}/{unique}"
        _gone_at_exit(spark, self.scratch)
        self.bronze, self.silver, self.gold = (
            f"{unique}_{layer}" for layer in ("bronze", "silver", "gold")
        )
        self.site = Site(
            admin=f"{unique}_admin",
            layers=(self.bronze, self.silver, self.gold),
            root=self.scratch,
        ).on(spark)
        config.install(spark, self.site)

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def l0(self, group: str, *rows: dict[str, Any]) -> None:
        """Register L0 loads; a row is a bronze FULL load of parquet unless it says otherwise."""
        defaults = {
            GROUP: group,
            "TARGET_SCHEMA": self.bronze,
            "FILE_FORMAT": "parquet",
            "LOAD_TYPE": "FULL",
            "IS_ACTIVE": "Y",
        }
        config.upsert_l0(self.spark, [defaults | row for row in rows], self.site)

    def l1(self, group: str, *rows: dict[str, Any]) -> None:
        config.upsert_l1(self.spark, self._sql_rows(group, self.bronze, self.silver, rows), self.site)

    def l2(self, group: str, *rows: dict[str, Any]) -> None:
        config.upsert_l2(self.spark, self._sql_rows(group, self.silver, self.gold, rows), self.site)

    def _sql_rows(
        self, group: str, source: str, target: str, rows: tuple[dict[str, Any], ...]
    ) -> list[dict[str, Any]]:
        defaults = {
            GROUP: group,
            "SOURCE_OBJ_SCHEMA": source,
            "TARGET_SCHEMA": target,
            "LOAD_TYPE": "FULL",
            "IS_ACTIVE": "Y",
        }
        return [defaults | row for row in rows]

    def run(self, group: str, **options: Any) -> None:
        run_group(self.spark, group, site=self.site, **options)

    def land(self, *tables: str) -> None:
        """Bring given tables to bronze unchanged."""
        rows = [{"SOURCE_URL": self.path(table), "TARGET_TABLE": table} for table in tables]
        self.l0("LAND_L0", *rows)
        self.run("LAND_L0", parallelism=len(tables))

    def transform(self, query: str, *sources: str, **row: Any) -> DataFrame:
        """Land the sources, run one query over them as a silver load, return its target."""
        self.land(*sources)
        self.load_silver(query, **row)
        return self.result(self.silver, "result")

    def load_silver(self, query: str, **row: Any) -> None:
        self.l1("TRANSFORM_L1", {"TARGET_TABLE": "result", "TRANSFORMATION_QUERY": query} | row)
        self.run("TRANSFORM_L1")

    def table(self, schema: str, table: str) -> DataFrame:
        return self.spark.table(self.site.table(schema, table))

    def result(self, schema: str, table: str) -> DataFrame:
        return self.table(schema, table).drop(*LINEAGE_COLUMNS)
