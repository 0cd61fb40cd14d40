"""What the catalog knows of a table, and the statements that make and change one."""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from strata.site import Site, quote

#: Properties that loads set. Of a stage: the table that it replaces; the table that it is still
#: being written for; whether it replaces only the partitions that it has. Of a table: the version
#: before, or the list of folders that were replaced.
REPLACES = "strata.replaces"
WRITES = "strata.writes"
SOME_PARTITIONS = "strata.some-partitions"
PREVIOUS = "strata.previous"
REPLACED = "strata.replaced"
#: The rows of a table, and the bytes of the files that hold them.
ROWS = "strata.rows"
_OWN = (REPLACES, WRITES, SOME_PARTITIONS, PREVIOUS, REPLACED, ROWS)

STAGE_MARK = "__strata_stage_"
#: How Spark names the folder of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Buckets(NamedTuple):
    number: int
    columns: list[str]
    sorting: list[str]


class Layout(NamedTuple):
    """What a table keeps when its rows are rewritten, and where it is."""

    provider: str
    columns: StructType = StructType([])
    partitions: list[str] = []
    buckets: Buckets | None = None
    comment: str = ""
    properties: dict[str, str] = {}
    options: dict[str, str] = {}
    location: str = ""
    managed: bool = True
    #: The properties of loads.
    marks: dict[str, str] = {}

    @property
    def in_place(self) -> bool:
        """Whether the table has row-level updates of its own."""
        return self.provider == "delta"


def _class(spark: SparkSession, name: str):
    """A class of the JVM; its whole name at once is one question to the JVM, not one for each part."""
    return getattr(spark._jvm, name)


def _path(spark: SparkSession, location):
    return _class(spark, "org.apache.hadoop.fs.Path")(location)


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _java(spark: SparkSession, scala):
    return _class(spark, "scala.jdk.javaapi.CollectionConverters").asJava(scala)


def _list(names) -> list[str]:
    """A Scala sequence of names, in one call."""
    joined = names.mkString("\x1e")
    return joined.split("\x1e") if joined else []


def _dict(pairs) -> dict[str, str]:
    """A Scala map of texts, in one call."""
    listed = (pair.partition(" -> ") for pair in _list(pairs))
    return {key: value for key, _, value in listed}


def layout_of(spark: SparkSession, site: Site, schema: str, table: str) -> Layout | None:
    """The layout of a table or view, None where there is none. One call of the catalog."""
    if not spark.catalog.tableExists(site.table(schema, table)):
        return None
    names = spark.sparkContext._gateway.new_array(_class(spark, "java.lang.String"), 1)
    names[0] = schema
    named = _class(spark, "org.apache.spark.sql.connector.catalog.Identifier").of(names, table)
    catalog = spark._jsparkSession.sessionState().catalogManager().catalog(site.catalog)
    found = catalog.loadTable(named)
    if not found.getClass().getSimpleName() == "V1Table":
        return Layout((found.properties().get("provider") or "").lower())
    known = found.catalogTable()
    optional = lambda option, default="": option.get() if option.isDefined() else default
    spec = optional(known.bucketSpec(), None)
    properties = _dict(known.properties())
    storage = known.storage()
    location = optional(storage.locationUri(), None)
    return Layout(
        optional(known.provider()).lower(),
        StructType.fromJson(json.loads(known.schema().json())),
        _list(known.partitionColumnNames()),
        Buckets(spec.numBuckets(), _list(spec.bucketColumnNames()), _list(spec.sortColumnNames()))
        if spec
        else None,
        optional(known.comment()),
        {k: v for k, v in properties.items() if k not in _OWN},
        {k: v for k, v in _dict(storage.properties()).items() if k != "path"},
        _path(spark, location).toString() if location else "",
        known.tableType().name() == "MANAGED",
        {k: v for k, v in properties.items() if k in _OWN},
    )


def stages_of(spark: SparkSession, site: Site, schema: str, table: str) -> list[str]:
    """Names of tables that look like stages of this one."""
    state = spark._jsparkSession.sessionState()
    if site.catalog != "spark_catalog" or not state.catalog().databaseExists(schema):
        return []
    found = state.catalog().externalCatalog().listTables(schema, f"*{STAGE_MARK}*")
    start = f"{table}{STAGE_MARK}".lower()
    return [name for name in _list(found) if name.lower().startswith(start)]


def stage_name(table: str) -> str:
    return f"{table}{STAGE_MARK}{uuid.uuid4().hex[:12]}"


def text_literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def type_text(kind: T.DataType) -> str:
    """The type as SQL spells it, with any nested name."""
    if isinstance(kind, T.StructType):
        return "STRUCT<" + ", ".join(f"{quote(f.name)}: {type_text(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{type_text(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"MAP<{type_text(kind.keyType)}, {type_text(kind.valueType)}>"
    return kind.simpleString()


def _field_text(field: T.StructField) -> str:
    comment = field.metadata.get("comment")
    return f"{quote(field.name)} {type_text(field.dataType)}" + (
        f" COMMENT {text_literal(comment)}" if comment else ""
    )


def _pairs(some: dict[str, str]) -> str:
    return ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in some.items())


def _names(names: list[str]) -> str:
    return ", ".join(map(quote, names))


def create(
    spark: SparkSession, name: str, layout: Layout, marks: dict[str, str] = {}, location: str = ""
) -> None:
    """Create a table with the layout's definition; its partition columns come last."""
    chosen = {column.lower(): n for n, column in enumerate(layout.partitions)}
    last = sorted((f for f in layout.columns if f.name.lower() in chosen), key=lambda f: chosen[f.name.lower()])
    fields = [f for f in layout.columns if f.name.lower() not in chosen] + last
    properties, buckets = layout.properties | marks, layout.buckets
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(map(_field_text, fields))}) USING {layout.provider}"
        + (f" OPTIONS ({_pairs(layout.options)})" if layout.options else "")
        + (f" PARTITIONED BY ({_names(layout.partitions)})" if layout.partitions else "")
        + (f" CLUSTERED BY ({_names(buckets.columns)})" if buckets else "")
        + (f" SORTED BY ({_names(buckets.sorting)})" if buckets and buckets.sorting else "")
        + (f" INTO {buckets.number} BUCKETS" if buckets else "")
        + (f" COMMENT {text_literal(layout.comment)}" if layout.comment else "")
        + (f" TBLPROPERTIES ({_pairs(properties)})" if properties else "")
        + (f" LOCATION {text_literal(location)}" if location else "")
    )


def set_location(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION {text_literal(location)}")


def set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_pairs(properties)})")


def unset_properties(spark: SparkSession, name: str, keys: list[str]) -> None:
    listed = ", ".join(map(text_literal, keys))
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({listed})")


# Partitions

#: Values of the partition columns as folders have them, in the order of the columns.
Spec = tuple[str, ...]


def partitions_of(spark: SparkSession, schema: str, table: str, columns: list[str]) -> dict[Spec, str]:
    """The registered partitions of a table and where they are."""
    option = _class(spark, "scala.Option")
    name = _class(spark, "org.apache.spark.sql.catalyst.TableIdentifier")(table, option.apply(schema))
    catalog = spark._jsparkSession.sessionState().catalog()
    found = {}
    for known in _java(spark, catalog.listPartitions(name, option.empty())):
        values = {k.lower(): v for k, v in _dict(known.spec()).items()}
        spec = tuple(values[column.lower()] for column in columns)
        found[spec] = _path(spark, known.location()).toString()
    return found


def spec_text(columns: list[str], spec: Spec) -> str:
    values = ("NULL" if value == NULL_FOLDER else text_literal(value) for value in spec)
    pairs = (f"{quote(column)} = {value}" for column, value in zip(columns, values, strict=True))
    return f"PARTITION ({', '.join(pairs)})"


# Folders


def new_location(spark: SparkSession, site: Site, schema: str, label: str) -> str:
    home = spark.catalog.getDatabase(site.schema(schema)).locationUri
    return f"{home.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def is_own(location: str, table: str) -> bool:
    """Whether the folder is one that new_location named."""
    return location.rstrip("/").rsplit("/", 1)[-1].startswith(f"{table}-")


def remove_folder(spark: SparkSession, location: str) -> None:
    path = _path(spark, location)
    _files(spark, path).delete(path, True)


def folder_exists(spark: SparkSession, location: str) -> bool:
    path = _path(spark, location)
    return _files(spark, path).exists(path)
