"""Replacing the contents of a table without a moment in which they are lost.

A rewrite goes to a fresh folder next to the table, and the table, or those of its partitions that
the rewrite is for, is then pointed at it. The previous contents stay readable while the rewrite
runs, so it may read the table it replaces, and a failed job leaves the table as it was. No file
is ever moved, which matters on object stores where a rename copies. What was replaced stays on
disk until the next rewrite, so that who still reads it can finish.

Where more than one statement must follow, the finished rewrite is registered first, as a stage: a
table with a name of its own whose property says which table it is for. The next load of that
table completes what a lost driver has begun. Only tables with such a property are ever taken for
a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, StructField, StructType

from strata.operators.columns import aligned, by_lower_name
from strata.operators.counts import counted
from strata.operators.tables import (
    NULL_FOLDER,
    PREVIOUS,
    REPLACED,
    REPLACES,
    SOME_PARTITIONS,
    WRITES,
    Layout,
    Spec,
    create,
    folder_exists,
    is_own,
    layout_of,
    new_location,
    partitions_of,
    remove_folder,
    set_location,
    set_properties,
    spec_text,
    stage_name,
    stages_of,
    text_literal,
    unset_properties,
)
from strata.site import Site

#: Partitions that are told apart by a condition; more of them by a join.
LISTED_PARTITIONS = 500


def current(spark: SparkSession, site: Site, schema: str, table: str) -> Layout | None:
    """The table as it is, after completing what a lost driver has begun. None: there is none."""
    finish_interrupted(spark, site, schema, table)
    return layout_of(spark, site, schema, table)


def replace_table(
    df: DataFrame,
    site: Site,
    schema: str,
    table: str,
    keep_layout: bool = False,
    before: Layout | None = None,
) -> int | None:
    """FULL load: rows and schema of the table become those of ``df``.

    With ``keep_layout``, for rewrites of a table's own rows, its format, options, partitions,
    buckets and column comments stay too. Comment and properties always do; partitions and buckets
    stay where ``df`` has their columns. ``before`` is what `current` gave. Returns the rows
    written, where that is known.
    """
    spark, name = df.sparkSession, site.table(schema, table)
    before = before or current(spark, site, schema, table)
    if site.table_format == "delta" or (before and before.in_place):
        writer = df.write.format("delta").mode("overwrite").option("overwriteSchema", "true")
        writer.saveAsTable(name)
        return None
    known = by_lower_name(df.schema)
    layout = before or Layout(site.table_format)
    comments = {f.name.lower(): f.metadata.get("comment") for f in layout.columns} if keep_layout else {}
    columns = StructType([_commented(f, comments.get(f.name.lower())) for f in df.schema])
    layout = layout._replace(columns=columns)
    if before and not keep_layout:
        held = lambda names: all(name.lower() in known for name in names)
        buckets = before.buckets
        layout = layout._replace(
            provider=site.table_format,
            partitions=before.partitions
            if len(known) > len(before.partitions) and held(before.partitions)
            else [],
            buckets=buckets if buckets and held(buckets.columns + buckets.sorting) else None,
            options=before.options if before.provider == site.table_format else {},
        )
    write = Rewrite(spark, site, schema, table, layout)
    try:
        write.add(df)
        write.replace_all(before)
    except Exception:
        write.discard()
        raise
    return write.rows


def _commented(field: StructField, comment: str | None) -> StructField:
    return StructField(field.name, field.dataType, metadata={"comment": comment} if comment else {})


class Rewrite:
    """Rows of a table written anew, not yet seen by anyone.

    Bucketed rows can only be written through a table, so those have their stage from the start,
    marked as unfinished.
    """

    def __init__(
        self, spark: SparkSession, site: Site, schema: str, table: str, layout: Layout, flag: str = ""
    ) -> None:
        """flag: a byte column that the files have besides the table's, in formats that allow it."""
        self.spark, self.site, self.schema, self.table = spark, site, schema, table
        self.layout, self.location = layout, new_location(spark, site, schema, table)
        self._stage, self._done = "", False
        #: Rows written so far.
        self.rows = 0
        self._flag = [StructField(flag, ByteType())] if flag else []

    @property
    def name(self) -> str:
        return self.site.table(self.schema, self.table)

    def _stage_name(self) -> str:
        return self.site.table(self.schema, self._stage)

    def add(self, df: DataFrame) -> None:
        """Write rows of the layout's columns, and the flag where there is one."""
        layout = self.layout
        if not layout.buckets:
            df, rows = counted(df)
            writer = df.write.format(layout.provider).options(**layout.options).mode("append")
            if layout.partitions:
                writer = writer.partitionBy(*layout.partitions)
            writer.save(self.location)
            self.rows += rows()
            return
        if not self._stage:
            wider = StructType([*layout.columns, *self._flag])
            self._register(layout._replace(columns=wider))
        columns = self.spark.table(self._stage_name()).columns
        known = by_lower_name(df.schema)
        rows = df.select(
            *(F.col(f"`{c}`") if c.lower() in known else F.lit(None).alias(c) for c in columns)
        )
        # By the hash that files are bucketed by, so that a task writes one file of a bucket.
        rows = rows.repartition(layout.buckets.number, *(F.col(f"`{c}`") for c in layout.buckets.columns))
        rows, written = counted(rows)
        rows.write.insertInto(self._stage_name())
        self.rows += written()

    def read(self, *columns: str) -> DataFrame:
        """Columns of what is written so far."""
        fields = by_lower_name(StructType([*self.layout.columns, *self._flag]))
        schema = StructType([fields[c.lower()] for c in columns])
        return self.spark.read.format(self.layout.provider).schema(schema).load(self.location)

    def discard(self) -> None:
        if not self._done:
            if self._stage:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._stage_name()}")
            remove_folder(self.spark, self.location)

    def _register(self, layout: Layout) -> None:
        self._stage = stage_name(self.table)
        create(self.spark, self._stage_name(), layout, {WRITES: self.table}, self.location)

    def _finish_stage(self, marks: dict[str, str]) -> None:
        """From here on the next load completes what isn't done."""
        set_properties(self.spark, self._stage_name(), {REPLACES: self.table} | marks)
        self._done = True

    def replace_all(self, before: Layout | None) -> None:
        """The table has these rows, and only these, from now on."""
        spark, layout, name = self.spark, self.layout, self.name
        if before is None:
            create(spark, name, layout)
            set_location(spark, name, self.location)
            self._done = True
            return
        same = _same_columns(before.columns, layout.columns) and before.provider == layout.provider
        if same and before.buckets == layout.buckets and not before.partitions and not layout.partitions:
            set_location(spark, name, self.location)
            self._done = True
            if self._stage:
                spark.sql(f"DROP TABLE {self._stage_name()}")
            if before.managed:
                _forget(spark, before)
                set_properties(spark, name, {PREVIOUS: before.location})
            return
        # Columns and partitions cannot be changed in place. The finished rewrite is registered
        # first, so that a driver lost between the drop and the create loses nothing.
        marks = {}
        if before.managed and not before.partitions and is_own(before.location, self.table):
            marks[PREVIOUS] = before.location
        if not self._stage:
            self._register(layout)
        if before.managed:
            # A table's first folder has the place that the catalog wants for a new one.
            _forget(spark, before)
        self._finish_stage(marks)
        _promote(spark, self.site, self.schema, self.table, self._stage)

    def replace_partitions(self, touched: list[Spec]) -> None:
        """Those partitions have these rows, and only these, from now on; the others stay as they
        are. Touched partitions that got no row are dropped."""
        spark, columns = self.spark, self.layout.partitions
        if not self._stage:
            self._register(self.layout)
        stage = self._stage_name()
        spark.sql(f"ALTER TABLE {stage} RECOVER PARTITIONS")
        written = partitions_of(spark, self.schema, self._stage, columns)
        for spec in written.keys() - set(touched):
            spark.sql(f"ALTER TABLE {stage} DROP IF EXISTS {spec_text(columns, spec)}")
            remove_folder(spark, written[spec])
        for spec in set(touched) - written.keys():
            # Registered without a folder: a partition that has become empty.
            spark.sql(f"ALTER TABLE {stage} ADD IF NOT EXISTS {spec_text(columns, spec)}")
            remove_folder(spark, partitions_of(spark, self.schema, self._stage, columns)[spec])
        self._finish_stage({SOME_PARTITIONS: "true"})
        _promote(spark, self.site, self.schema, self.table, self._stage)


def touched_partitions(values: DataFrame, partitions: list[str]) -> list[Spec]:
    """The partitions that rows are in, as folders name them.

    Each of them costs a statement of its own, so the driver has their list anyway.
    """
    texts = [
        F.coalesce(F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")), F.lit(NULL_FOLDER)).alias(f"c{n}")
        for n, c in enumerate(partitions)
    ]
    return [tuple(row) for row in values.select(*texts).distinct().collect()]


def in_partitions(df: DataFrame, partitions: list[str], touched: list[Spec]) -> DataFrame:
    """The rows of a table in those partitions; the others aren't read."""
    names = [F.coalesce(F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")), F.lit(NULL_FOLDER)) for c in partitions]
    if len(touched) <= LISTED_PARTITIONS:
        if len(names) == 1:
            return df.where(names[0].isin([spec[0] for spec in touched]))
        return df.where(F.struct(*names).isin([F.struct(*map(F.lit, spec)) for spec in touched]))
    columns = [f"__partition_{n}" for n in range(len(names))]
    listed = df.sparkSession.createDataFrame(touched, ", ".join(f"{c} STRING" for c in columns))
    marked = df.withColumns(dict(zip(columns, names, strict=True)))
    # As many rows as the table has partitions, each of which the catalog holds.
    return marked.join(F.broadcast(listed), columns, "left_semi").drop(*columns)


def _forget(spark: SparkSession, before: Layout) -> None:
    """Remove what earlier rewrites have replaced."""
    if PREVIOUS in before.marks:
        remove_folder(spark, before.marks[PREVIOUS])
    if REPLACED in before.marks:
        listed = before.marks[REPLACED]
        if folder_exists(spark, listed):
            for row in spark.read.text(listed).collect():
                remove_folder(spark, row.value)
            remove_folder(spark, listed)


def widen(
    spark: SparkSession, site: Site, schema: str, table: str, columns: StructType, before: Layout
) -> None:
    """Give a table more columns or nested fields; its files stay as they are.

    The wider table is registered over the same files before the old one lets go of them. With
    partitions, whose folders a catalog may delete with the table, or in the place that the catalog
    wants for a new table, the rows are written anew.
    """
    name = site.table(schema, table)
    if before.partitions or (before.managed and not is_own(before.location, table)):
        rows = spark.table(name)
        wider = rows.select(*aligned(rows, columns, fill_missing=True, nested=True))
        replace_table(wider, site, schema, table, keep_layout=True, before=before)
        return
    comments = {f.name.lower(): f.metadata.get("comment") for f in before.columns}
    named = StructType([_commented(f, comments.get(f.name.lower())) for f in columns])
    stage = stage_name(table)
    kept = {k: v for k, v in before.marks.items() if k in (PREVIOUS, REPLACED)}
    marks = {REPLACES: table} | kept
    create(spark, site.table(schema, stage), before._replace(columns=named), marks, before.location)
    if before.managed:
        set_location(spark, name, new_location(spark, site, schema, table))
    else:
        spark.sql(f"DROP TABLE {name}")
    _promote(spark, site, schema, table, stage)


def _promote(spark: SparkSession, site: Site, schema: str, table: str, stage: str) -> None:
    """Give a finished stage's rows to its table. Every step may be repeated."""
    staged = layout_of(spark, site, schema, stage)
    if SOME_PARTITIONS in staged.marks:
        _promote_partitions(spark, site, schema, table, stage, staged)
    else:
        _promote_table(spark, site, schema, table, stage, staged)
    # The stage is an external table: dropping it leaves the files to the new owner.
    spark.sql(f"DROP TABLE {site.table(schema, stage)}")


def _promote_table(
    spark: SparkSession, site: Site, schema: str, table: str, stage: str, staged: Layout
) -> None:
    name, here = site.table(schema, table), layout_of(spark, site, schema, table)
    if here is None or here.location != staged.location:
        apart = _own_partitions(spark, schema, table, here)
        if here and PREVIOUS in staged.marks:
            # Dropped from elsewhere, the version before keeps its files.
            set_location(spark, name, new_location(spark, site, schema, table))
        if here:
            spark.sql(f"DROP TABLE {name}")
        kept = {k: v for k, v in staged.marks.items() if k in (PREVIOUS, REPLACED)}
        create(spark, name, staged, kept)
        set_location(spark, name, staged.location)
        for folder in apart:
            remove_folder(spark, folder)
    if staged.partitions:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _own_partitions(
    spark: SparkSession, schema: str, table: str, layout: Layout | None
) -> list[str]:
    """Folders of partitions that loads have put outside a managed table's own."""
    if not layout or not layout.managed or not layout.partitions:
        return []
    home = f"{layout.location.rstrip('/')}/"
    found = partitions_of(spark, schema, table, layout.partitions).values()
    return [folder for folder in found if not folder.startswith(home)]


def _promote_partitions(
    spark: SparkSession, site: Site, schema: str, table: str, stage: str, staged: Layout
) -> None:
    name, columns = site.table(schema, table), staged.partitions
    here = layout_of(spark, site, schema, table)
    written = partitions_of(spark, schema, stage, columns)
    known = partitions_of(spark, schema, table, columns)
    replaced = sorted(known[spec] for spec in written if spec in known and known[spec] != written[spec])
    listed = f"{staged.location}/_replaced"
    if here.managed and here.marks.get(REPLACED) != listed:
        _forget(spark, here)
        # A list of its own, as properties are short; files that begin so are read by no table.
        spark.createDataFrame([(x,) for x in replaced], "folder STRING").coalesce(1).write.mode(
            "overwrite"
        ).text(listed)
        unset_properties(spark, name, [PREVIOUS])
        set_properties(spark, name, {REPLACED: listed})
    for spec, folder in sorted(written.items()):
        which = spec_text(columns, spec)
        if spec in known and known[spec] == folder:
            continue
        if not folder_exists(spark, folder):
            if spec in known:
                # Pointed elsewhere first, so that the drop leaves the files to their readers.
                where = text_literal(f"{staged.location}/_dropped")
                spark.sql(f"ALTER TABLE {name} {which} SET LOCATION {where}")
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {which}")
        elif spec in known:
            spark.sql(f"ALTER TABLE {name} {which} SET LOCATION {text_literal(folder)}")
        else:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {which} LOCATION {text_literal(folder)}")
    spark.catalog.refreshTable(name)


def drop_with_files(spark: SparkSession, site: Site, schema: str, table: str) -> None:
    """Drop a table with what its loads have left elsewhere."""
    name = site.table(schema, table)
    layout = layout_of(spark, site, schema, table)
    if layout is None:
        return
    apart = _own_partitions(spark, schema, table, layout)
    if layout.managed:
        _forget(spark, layout)
    spark.sql(f"DROP TABLE {name}")
    for folder in apart:
        remove_folder(spark, folder)


def finish_interrupted(spark: SparkSession, site: Site, schema: str, table: str) -> None:
    """Complete a replacement whose driver died after its rewrite was registered, and remove one
    whose driver died before."""
    for stage in stages_of(spark, site, schema, table):
        staged = layout_of(spark, site, schema, stage)
        if staged.marks.get(REPLACES, "").lower() == table.lower():
            _promote(spark, site, schema, table, stage)
        elif staged.marks.get(WRITES, "").lower() == table.lower():
            spark.sql(f"DROP TABLE {site.table(schema, stage)}")
            remove_folder(spark, staged.location)


def _same_columns(left: StructType, right: StructType) -> bool:
    return [(f.name, f.dataType.simpleString()) for f in left] == [
        (f.name, f.dataType.simpleString()) for f in right
    ]
