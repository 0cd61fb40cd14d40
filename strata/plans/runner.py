"""Running the loads of a group: read, stamp, write, audit."""

from __future__ import annotations

import logging
import threading
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime
from functools import partial
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.functions import group_key, layer_of
from strata.operators import write_table
from strata.operators.tables import remove_folder
from strata.plans import audit
from strata.plans.config import active_loads, normalise_rows
from strata.schemas import LINEAGE_COLUMNS
from strata.site import Site, quote
from strata.sources import read_source
from strata.sources.files import scratch_folder

log = logging.getLogger(__name__)

#: Characters of an error's text in the audit log; the whole error goes to the program's log.
ERROR_TEXT_LIMIT = 300

# The current catalog and schema belong to the session, so queries are resolved one at a time.
_resolving = threading.RLock()


class LoadResult(NamedTuple):
    layer: str
    table: str
    status: str
    rows: int
    message: str


class LayerFailed(RuntimeError):
    """At least one load of a layer failed; the audit log has the details."""


def run_group(
    spark: SparkSession,
    group_id: str | None,
    table: str | None = None,
    env: str | None = "dev",
    site: Site = Site(),
    parallelism: int = 1,
) -> list[LoadResult]:
    """Run a group's active loads, or the one for ``table``.

    The suffix of the group id names the layer; without one, L0, L1 and L2 run in turn and a
    failed layer stops the ones after it. ``parallelism`` is the number of a layer's targets
    that load at the same time, all in the caller's session; more than one needs targets that do
    not read each other. Rows with the same target load in turn. Each load has a scheduler pool of
    its own, so that with ``spark.scheduler.mode=FAIR`` a small one doesn't wait for a large one.
    """
    group = group_key(group_id)
    site = site.on(spark)
    env = (env or "").strip() or "dev"
    layer = layer_of(group)
    results: list[LoadResult] = []
    for current in ("L0", "L1", "L2") if layer == "ALL" else (layer,):
        results += run_layer(spark, group, current, table, env, site, parallelism)
    return results


def run_layer(
    spark: SparkSession,
    group: str,
    layer: str,
    table: str | None,
    env: str,
    site: Site,
    parallelism: int = 1,
) -> list[LoadResult]:
    """Run one layer. Every load is tried and audited; then any failure is raised."""
    # One row per load to start, so the list is as short as the list of jobs.
    rows = normalise_rows(active_loads(spark, layer, group, table, site)).collect()
    if not rows:
        log.info("No loads for %s in %s", group, layer)
        return []
    load = partial(_load, spark, group=group, layer=layer, env=env, site=site)
    by_target: dict[tuple, list[int]] = {}
    for place, row in enumerate(rows):
        target = ((row.TARGET_SCHEMA or "").lower(), (row.TARGET_TABLE or "").lower())
        by_target.setdefault(target, []).append(place)

    def load_in_turn(places: list[int]) -> list[tuple[int, LoadResult]]:
        return [(place, load(rows[place])) for place in places]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        turn = inheritable_thread_target(spark)(load_in_turn)
        pending = [pool.submit(turn, places) for places in by_target.values()]
        done = sorted(pair for job in pending for pair in job.result())
    results = [result for _, result in done]
    if any(result.status == "FAILED" for result in results):
        failed = ", ".join(r.table for r in results if r.status == "FAILED")
        raise LayerFailed(f"{layer} of {group} had failures ({failed}); see the audit log.")
    return results


def _load(
    spark: SparkSession, row: Row, group: str, layer: str, env: str, site: Site
) -> LoadResult:
    started = datetime.now()
    status, count, message = "FAILED", 0, ""
    scratch = scratch_folder(spark)
    try:
        with fair_share(spark, f"{row.TARGET_SCHEMA}.{row.TARGET_TABLE}"):
            df = add_lineage(resolve_source(spark, row, layer, site, scratch), group, layer, env)
            count = write_table(
                df, row.TARGET_SCHEMA, row.TARGET_TABLE, row.LOAD_TYPE, row.MERGE_KEYS, site
            )
        status, message = "SUCCESS", f"{count:,} rows"
    except Exception as error:
        message = f"{type(error).__name__}: {str(error)[:ERROR_TEXT_LIMIT]}"
        log.warning(
            "%s %s.%s failed", layer, row.TARGET_SCHEMA, row.TARGET_TABLE, exc_info=error
        )
    finally:
        if layer == "L0":
            remove_folder(spark, scratch)
        audit.record(
            spark,
            group,
            row.TARGET_TABLE,
            layer,
            status,
            count,
            message,
            started,
            datetime.now(),
            site,
        )
    return LoadResult(layer, row.TARGET_TABLE, status, count, message)


#: A thread's setting of the pool that its jobs are scheduled in.
_POOL = "spark.scheduler.pool"


@contextmanager
def fair_share(spark: SparkSession, load: str) -> Iterator[None]:
    """Jobs that this thread starts meanwhile are in a pool of the load's own, unless the caller
    has chosen one."""
    context = spark.sparkContext
    chosen = context.getLocalProperty(_POOL)
    context.setLocalProperty(_POOL, chosen or f"load {load}")
    try:
        yield
    finally:
        context.setLocalProperty(_POOL, chosen)


def resolve_source(
    spark: SparkSession, row: Row, layer: str, site: Site, scratch: str | None = None
) -> DataFrame:
    """The frame a normalised control row loads from; scratch: see `read_source`."""
    schema, name = row.SOURCE_OBJ_SCHEMA, row.SOURCE_OBJ_NAME
    if layer == "L0":
        from_table = row.LOAD_TYPE == "DELTA" and not row.SOURCE_URL and schema and name
        if not from_table:
            return read_source(
                spark, row.SOURCE_URL, row.SOURCE_FORMAT, row.DELIMETER, scratch=scratch
            )
    elif row.TRANSFORMATION_QUERY:
        return query_in(spark, row.TRANSFORMATION_QUERY, schema, site)
    return spark.table(site.table(schema, name))


def query_in(spark: SparkSession, query: str, schema: str, site: Site) -> DataFrame:
    """SQL with names resolved in the site's catalog, bare table names in ``schema``."""
    with _namespace(spark, site, schema):
        return spark.sql(query.rstrip().rstrip(";"))


@contextmanager
def _namespace(spark: SparkSession, site: Site, schema: str) -> Iterator[None]:
    """Names resolve here while it holds; a frame that is made meanwhile stays resolved."""
    with _resolving:
        catalog, database = spark.catalog.currentCatalog(), spark.catalog.currentDatabase()
        try:
            spark.catalog.setCurrentCatalog(site.catalog)
            if schema and spark.catalog.databaseExists(site.schema(schema)):
                spark.sql(f"USE {site.schema(schema)}")
            yield
        finally:
            spark.catalog.setCurrentCatalog(catalog)
            spark.sql(f"USE {quote(catalog, database)}")


def add_lineage(df: DataFrame, group: str, layer: str, env: str) -> DataFrame:
    """Stamp the rows; a column of the same name is replaced where it stands."""
    values = (F.lit(group), F.lit(layer), F.lit(env), F.current_timestamp())
    return df.withColumns(dict(zip(LINEAGE_COLUMNS, values)))
