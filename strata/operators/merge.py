"""Upsert by key into an ordinary Spark table.

The rewrite is two joins instead of one full outer join:

* target LEFT OUTER changes: rows of the target, updated where a change has their key;
* changes LEFT ANTI keys found in the target: rows to insert.

A full outer join can neither broadcast its small side nor have its hot partitions split by
AQE. These two can do both: with few changes the target is not shuffled at all, and with many,
a key that holds a large share of the target is on the left, splittable side, while the changes
that take part hold each key once. Changes whose key is NULL or repeated match nothing and stay
out of the second join. AQE splits a hot partition only where both sides come straight from a
shuffle, so what the joins read is written out first; that also gives the planner real sizes to
choose a broadcast by.

With few changes, a scan of the target's keys first tells which partitions hold matches. Only
those, and those that get new rows, are written anew; where no key is found, rows are only added
and the target's files stay. With many changes the target is read and shuffled once: the rewrite
carries a flag in its files, NULL where nothing matched, that no reader of the table sees. From
the flagged rows, of which only flag and keys are read back, follow the rows to insert, the
partitions that changed, and whether a repeated key was met.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.append import append
from strata.operators.columns import aligned, by_lower_name
from strata.operators.replace import (
    Rewrite,
    current,
    in_partitions,
    replace_table,
    touched_partitions,
)
from strata.operators.tables import Layout, new_location, remove_folder
from strata.site import Site, quote


# Spark chooses a broadcast by file size, and a small file of repeated values can hold very many
# rows. What has more rows than this is joined by sort-merge whatever its size.
BROADCAST_ROWS = 1_000_000
#: Formats that are read by column name, so that files may have a column more.
FLAGGED_FORMATS = ("parquet", "orc")
FLAG = "__strata_matched"
UPDATED, REPEATED = 1, 2


class MergeConflict(ValueError):
    """Several source rows carry a key that the target holds."""


def merge(
    df: DataFrame,
    site: Site,
    schema: str,
    table: str,
    keys: list[str],
    update_columns: list[str] | None = None,
) -> int | None:
    """MERGE load: update matching rows, insert the others.

    Keys compare with plain ``=``, so a NULL key matches nothing and is inserted. Without
    ``update_columns`` every source column that is no key is updated; columns only the target
    has are kept, and are NULL in inserted rows. A source column the target lacks is an error.
    Returns the rows that the table now has, where that is known without counting them.
    """
    spark, name = df.sparkSession, site.table(schema, table)
    if not keys:
        raise ValueError(f"A merge into {name} needs at least one key.")
    before = current(spark, site, schema, table)
    if before.in_place if before else site.table_format == "delta":
        _merge_into(df, site, schema, table, keys, update_columns)
        return None
    if before is None:
        _check_keys(df.schema, keys, "source")
        return replace_table(df, site, schema, table)

    columns = before.columns
    keys = [_check_keys(columns, [key], "target")[0] for key in keys]
    _check_keys(df.schema, keys, "source")
    unknown = [f.name for f in df.schema if f.name.lower() not in by_lower_name(columns)]
    if unknown:
        raise ValueError(f"Columns not in {name}: {', '.join(unknown)}.")
    changes = df.select(*aligned(df, columns, fill_missing=False, narrow=True))
    target = spark.table(name)
    if target.isEmpty():
        return append(changes, site, schema, table, before)

    # Writing the changes once keeps an expensive or nondeterministic source from being
    # evaluated again, and survives lost executors.
    staging = _staging_location(spark, site, schema, table)
    try:
        load = _Merge(site, schema, table, before, keys, update_columns, staging)
        return load.run(target, _staged(changes, f"{staging}/changes"))
    finally:
        remove_folder(spark, staging)


class _Merge:
    """One merge of staged changes into a file table."""

    def __init__(
        self,
        site: Site,
        schema: str,
        table: str,
        before: Layout,
        keys: list[str],
        update_columns: list[str] | None,
        staging: str,
    ) -> None:
        self.site, self.schema, self.table, self.before = site, schema, table, before
        self.keys, self.update_columns, self.staging = keys, update_columns, staging
        self.name = site.table(schema, table)

    def run(self, target: DataFrame, changes: DataFrame) -> int | None:
        keys = self.keys
        has_key = _all(F.col(f"`{key}`").isNotNull() for key in keys)
        keyed, unkeyed = changes.where(has_key), changes.where(~has_key)
        repeated = _repeated_keys(keyed, keys)
        single, unmatched = keyed, unkeyed
        if repeated.isEmpty():
            repeated = None
        else:
            repeated = _staged(repeated, f"{self.staging}/repeated")
            listed = _sized(repeated)
            single = _staged(keyed.join(listed, keys, "left_anti"), f"{self.staging}/single")
            unmatched = unkeyed.unionByName(keyed.join(listed, keys, "left_semi"))
        rows = single.count()
        self.limited = rows > BROADCAST_ROWS
        flagged = self.before.provider in FLAGGED_FORMATS and FLAG not in by_lower_name(self.before.columns)
        if flagged and (self.limited or not _few(single.sparkSession, [single, repeated])):
            return self._in_one_pass(target, changes, single, unmatched, repeated)
        return self._after_a_look(target, changes, single, unmatched, repeated)

    def _sized(self, df: DataFrame) -> DataFrame:
        """Rows of which there are as many as changes with a key of their own, or fewer."""
        return df.hint("merge") if self.limited else df

    def _conflict(self) -> MergeConflict:
        return MergeConflict(f"Several source rows match one row of {self.name} on {', '.join(self.keys)}.")

    def _moves_rows(self, single: DataFrame) -> bool:
        """Whether an update can take a row to another partition."""
        changed = {c.lower() for c in _update_columns(single, self.keys, self.update_columns)}
        return any(c.lower() in changed for c in self.before.partitions)

    def _after_a_look(
        self, target: DataFrame, changes: DataFrame, single: DataFrame, unmatched: DataFrame, repeated: DataFrame | None
    ) -> int | None:
        """A look at the target's keys first, then a rewrite of what it must touch."""
        keys, partitions = self.keys, self.before.partitions
        if repeated is not None and not _present_in(target, _sized(repeated), keys).isEmpty():
            raise self._conflict()
        joinable = self._sized(single)
        looked = list(dict.fromkeys([*keys, *partitions]))
        matched = _staged(
            target.select(*looked).join(joinable.select(*keys), keys, "left_semi").distinct(),
            f"{self.staging}/matched",
        )
        if matched.isEmpty():
            return append(changes, self.site, self.schema, self.table, self.before)
        found = self._sized(matched.select(*keys).distinct())
        inserted = self._inserted(unmatched.unionByName(single.join(found, keys, "left_anti")))
        if partitions:
            touched = matched.select(*partitions).union(inserted.select(*partitions))
            if self._moves_rows(single):
                moved = _updated(target, joinable, keys, self.update_columns)
                touched = touched.union(moved.join(found, keys, "left_semi").select(*partitions))
            touched = touched_partitions(touched, partitions)
            target = in_partitions(target, partitions, touched)
        rewritten = _updated(target, joinable, keys, self.update_columns)
        write = Rewrite(target.sparkSession, self.site, self.schema, self.table, self.before)
        try:
            write.add(rewritten.unionByName(inserted))
            if partitions:
                write.replace_partitions(touched)
            else:
                write.replace_all(self.before)
        except Exception:
            write.discard()
            raise
        return None if partitions else write.rows

    def _inserted(self, rows: DataFrame) -> DataFrame:
        return rows.select(*aligned(rows, self.before.columns, fill_missing=True))

    def _in_one_pass(
        self, target: DataFrame, changes: DataFrame, single: DataFrame, unmatched: DataFrame, repeated: DataFrame | None
    ) -> int | None:
        """One pass over the target, whose result tells what it met."""
        keys, partitions = self.keys, self.before.partitions
        spark = target.sparkSession
        by_key = {key.lower() for key in keys}
        if partitions and all(c.lower() in by_key for c in partitions):
            # Matches and new rows are in the partitions that the changes name.
            target = in_partitions(target, partitions, touched_partitions(changes.select(*partitions), partitions))
        asked = self._sized(single).withColumn(FLAG, F.lit(UPDATED).cast("byte"))
        if repeated is not None:
            met = repeated.withColumn(FLAG, F.lit(REPEATED).cast("byte"))
            asked = asked.unionByName(met, allowMissingColumns=True)
        write = Rewrite(spark, self.site, self.schema, self.table, self.before, FLAG)
        try:
            write.add(_updated(target, asked, keys, self.update_columns, FLAG))
            looked = list(dict.fromkeys([*keys, *partitions]))
            flagged = write.read(*looked, FLAG).where(F.col(FLAG).isNotNull())
            if repeated is not None and not flagged.where(F.col(FLAG) == REPEATED).isEmpty():
                raise self._conflict()
            if flagged.isEmpty():
                write.discard()
                return append(changes, self.site, self.schema, self.table, self.before)
            matched = _staged(flagged.select(*looked).distinct(), f"{self.staging}/matched")
            found = self._sized(matched.select(*keys).distinct())
            inserted = self._inserted(unmatched.unionByName(single.join(found, keys, "left_anti")))
            if partitions:
                inserted = _staged(inserted, f"{self.staging}/inserted")
                touched = matched.select(*partitions).union(inserted.select(*partitions))
                if self._moves_rows(single):
                    # The rows' old partitions aren't in the result any more.
                    old = target.select(*looked).join(found, keys, "left_semi")
                    touched = touched.union(old.select(*partitions))
                touched = touched_partitions(touched, partitions)
            write.add(inserted)
            if partitions:
                write.replace_partitions(touched)
            else:
                write.replace_all(self.before)
        except Exception:
            write.discard()
            raise
        return None if partitions else write.rows


def _few(spark: SparkSession, frames: list[DataFrame | None]) -> bool:
    """Whether staged frames of a limited number of rows are small enough to broadcast."""
    most = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    held = [df for df in frames if df is not None]
    return sum(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for df in held) <= most


def _update_columns(
    single: DataFrame, keys: list[str], update_columns: list[str] | None
) -> list[str]:
    is_key = {key.lower() for key in keys}
    wanted = {c.lower() for c in (update_columns or single.columns)} - is_key
    return [c for c in single.columns if c.lower() in wanted]


def _updated(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    update_columns: list[str] | None,
    flag: str = "",
) -> DataFrame:
    """The target's rows, updated where one of the changes has their key; its flag comes along."""
    wanted = {c.lower() for c in _update_columns(changes, keys, update_columns)}
    matches = _all(F.col(f"t.`{key}`") == F.col(f"s.`{key}`") for key in keys)
    is_matched = F.col(f"s.`{keys[0]}`").isNotNull()
    columns = [
        F.when(is_matched, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c)
        if c.lower() in wanted
        else F.col(f"t.`{c}`")
        for c in target.columns
    ]
    flags = [F.col(f"s.`{flag}`")] if flag else []
    return target.alias("t").join(changes.alias("s"), matches, "left_outer").select(*columns, *flags)


def _sized(df: DataFrame) -> DataFrame:
    """A staged frame that Spark may broadcast only if its rows are few, too."""
    return df.hint("merge") if df.count() > BROADCAST_ROWS else df


def _staged(df: DataFrame, location: str) -> DataFrame:
    df.write.parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)


def conflicting_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on which several rows of ``source`` match rows of ``target``."""
    return _present_in(target, _repeated_keys(source, keys), keys)


def _repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys)


def _present_in(target: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``candidates`` that occur in ``target``, each once.

    The target's keys are made distinct before they are shuffled; Catalyst moves the semi join
    below that aggregation when the candidates are small enough to broadcast.
    """
    return target.select(*keys).distinct().join(candidates.select(*keys), keys, "left_semi")


def _check_keys(columns: StructType, keys: list[str], side: str) -> list[str]:
    fields = by_lower_name(columns)
    missing = [key for key in keys if key.lower() not in fields]
    if missing:
        raise ValueError(f"Merge keys not in the {side}: {', '.join(missing)}.")
    return [fields[key.lower()].name for key in keys]


def _staging_location(spark: SparkSession, site: Site, schema: str, table: str) -> str:
    beside_table = new_location(spark, site, schema, f"{table}-changes")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared.rstrip('/')}/{beside_table.rsplit('/', 1)[1]}" if shared else beside_table


def _merge_into(
    df: DataFrame,
    site: Site,
    schema: str,
    table: str,
    keys: list[str],
    update_columns: list[str] | None,
) -> None:
    """Tables with row-level updates merge in place."""
    spark, name, view = df.sparkSession, site.table(schema, table), f"_changes_{table}"
    if not spark.catalog.tableExists(name):
        df.where("false").write.format("delta").saveAsTable(name)
    df.createOrReplaceTempView(quote(view))
    try:
        spark.sql(_merge_statement(name, view, df.columns, keys, update_columns))
    finally:
        spark.catalog.dropTempView(view)


def _merge_statement(
    name: str, view: str, columns: list[str], keys: list[str], update_columns: list[str] | None
) -> str:
    wanted = {c.lower() for c in (update_columns or columns)} - {key.lower() for key in keys}
    on = " AND ".join(f"t.{quote(key)} = s.{quote(key)}" for key in keys)
    sets = ", ".join(f"t.{quote(c)} = s.{quote(c)}" for c in columns if c.lower() in wanted)
    update = f"WHEN MATCHED THEN UPDATE SET {sets} " if sets else ""
    inserted = ", ".join(quote(c) for c in columns)
    values = ", ".join(f"s.{quote(c)}" for c in columns)
    return (
        f"MERGE INTO {name} t USING {quote(view)} s ON {on} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({inserted}) VALUES ({values})"
    )


def _all(conditions) -> Column:
    return reduce(lambda left, right: left & right, conditions)
