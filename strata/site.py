"""Where the control tables and the targets of one installation live."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

# Catalogs tried in this order before the first one listed.
PREFERRED_CATALOGS = ("demo_catalog", "hive_metastore")


def pick_catalog(spark: SparkSession, preferred: tuple[str, ...] = PREFERRED_CATALOGS) -> str:
    """First preferred catalog that exists, else the first one the session lists."""
    try:
        names = [row.catalog for row in spark.sql("SHOW CATALOGS").collect()]
        return next((name for name in preferred if name in names), names[0])
    except Exception:
        return preferred[-1]


def quote(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


@dataclass(frozen=True)
class Site:
    """Names shared by every job of an installation.

    ``catalog=None`` is probed on first use. ``root`` is the shared folder under which
    schemas are created; ``None`` leaves the place to the catalog's warehouse.
    ``table_format`` is the provider of new tables.
    """

    catalog: str | None = None
    admin: str = "admin"
    layers: tuple[str, ...] = field(default=("bronze", "silver", "gold"))
    table_format: str = "parquet"
    root: str | None = None

    def on(self, spark: SparkSession) -> Site:
        return self if self.catalog else replace(self, catalog=pick_catalog(spark))

    def schema(self, schema: str) -> str:
        return quote(self.catalog, schema)

    def table(self, schema: str, table: str) -> str:
        return quote(self.catalog, schema, table)

    def control(self, table: str) -> str:
        return self.table(self.admin, table)

    def create_schema(self, spark: SparkSession, schema: str) -> None:
        place = f" LOCATION '{self.root.rstrip('/')}/{schema}'" if self.root else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema(schema)}{place}")
