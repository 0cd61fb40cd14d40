"""VIEW rows: datasets defined by a SELECT and rebuilt as a whole."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from graphlib import CycleError, TopologicalSorter

from py4j.java_gateway import is_instance_of
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import group_key, layer_of
from strata.operators import replace_table
from strata.operators.tables import text_literal
from strata.plans.config import active_views
from strata.plans.runner import fair_share, query_in
from strata.site import Site, quote

log = logging.getLogger(__name__)


class PublishFailed(RuntimeError):
    """Some datasets could not be rebuilt; the others were."""


def setting(spark: SparkSession, key: str, default: str = "") -> str:
    """Run setting from the session: ``pipelines.<key>``, else ``<key>``, else the default."""
    for name in (f"pipelines.{key}", key):
        value = (spark.conf.get(name, "") or "").strip()
        if value:
            return value.upper()
    return default.upper()


_PLANS = "org.apache.spark.sql.catalyst.plans.logical"
# Spark's expressions that hold a query.
_SUBQUERIES = ("ScalarSubquery", "ListQuery", "Exists", "LateralSubquery")


def _items(sequence) -> list:
    """The elements of a Scala sequence."""
    return [sequence.apply(k) for k in range(sequence.length())]


def _parsed(spark: SparkSession, query: str):
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(query.strip().rstrip(";"))


def to_select(spark: SparkSession, query: str, name: str) -> str:
    """A row's query, out of its CREATE VIEW where it has one. Spark's parser tells which."""
    plan = _parsed(spark, query)
    kind = plan.getClass().getSimpleName()
    if kind == "CreateView":
        inner = plan.originalText().get()
        columns = [column._1() for column in _items(plan.userSpecifiedColumns())]
        if columns:
            listed = ", ".join(quote(column) for column in columns)
            return f"SELECT * FROM ({inner}) AS `_view` ({listed})"
        return inner
    gateway = spark.sparkContext._gateway
    if any(is_instance_of(gateway, plan, f"{_PLANS}.{name}") for name in ("Command", "ParsedStatement")):
        raise ValueError(f"'{name}' needs a query that returns rows, not {kind}.")
    return query.strip().rstrip(";")


def reads(spark: SparkSession, query: str) -> set[str]:
    """Names that a query reads, lower-case, as they are written (schema.table or table)."""
    found: set[str] = set()
    own: set[str] = set()

    def visit(plan) -> None:
        kind = plan.getClass().getSimpleName()
        if kind == "UnresolvedRelation":
            found.add(".".join(_items(plan.multipartIdentifier())).lower())
        elif kind == "UnresolvedWith":
            for named in _items(plan.cteRelations()):
                own.add(named._1().lower())
                visit(named._2())
        for child in _items(plan.children()):
            visit(child)
        for expression in _items(plan.expressions()):
            visit_expression(expression)

    def visit_expression(expression) -> None:
        if expression.getClass().getSimpleName() in _SUBQUERIES:
            visit(expression.plan())
        for child in _items(expression.children()):
            visit_expression(child)

    visit(_parsed(spark, query))
    return found - own


def plan(spark: SparkSession, group_id: str, site: Site = Site()) -> DataFrame:
    """Layer and schema of a group's view run as one row; no row without active views."""
    counted = active_views(spark, group_id, "ALL", site).agg(
        F.count_if(F.col("layer") == "L1").alias("L1_VIEWS"),
        F.count_if(F.col("layer") == "L2").alias("L2_VIEWS"),
        F.max(F.when(F.col("layer") == "L1", F.col("tgt_schema"))).alias("l1_schema"),
        F.max(F.when(F.col("layer") == "L2", F.col("tgt_schema"))).alias("l2_schema"),
    )
    run_layer = (
        F.when(F.col("L2_VIEWS") == 0, "L1").when(F.col("L1_VIEWS") == 0, "L2").otherwise("ALL")
    )
    schema = F.coalesce(
        F.nullif("l1_schema", F.lit("")), F.nullif("l2_schema", F.lit("")), F.lit("silver")
    )
    return counted.where("L1_VIEWS + L2_VIEWS > 0").select(
        "L1_VIEWS", "L2_VIEWS", run_layer.alias("RUN_LAYER"), schema.alias("TARGET_SCHEMA")
    )


def publish(
    spark: SparkSession,
    group_id: str | None = None,
    run_layer: str | None = None,
    site: Site = Site(),
    parallelism: int = 4,
) -> list[str]:
    """Rebuild the datasets of a group's VIEW rows and return their names.

    Group and layer default to the session's settings. View runs stamp no lineage columns and
    write no audit row. A dataset starts as soon as those that it reads are done, ``parallelism``
    of them at a time; a failure stops only what reads the failed one.
    """
    site = site.on(spark)
    group = group_key(group_id or setting(spark, "GROUP_ID"))
    layers = (run_layer or setting(spark, "RUN_LAYER", "ALL")).strip().upper()
    if layers == "ALL" and layer_of(group) in ("L1", "L2"):
        layers = layer_of(group)
    rows = active_views(spark, group, layers, site).collect()
    if not rows:
        raise LookupError(f"{group} has no active row of load type VIEW.")

    def field(value: str | None, default: str = "") -> str:
        return (value or default).strip()

    # Every query is checked before the first dataset is touched.
    datasets = {}
    for row in rows:
        if field(row.tgt_table) and field(row.query):
            key = f"{field(row.tgt_schema, 'gold')}.{field(row.tgt_table)}".lower()
            datasets[key] = (row, to_select(spark, field(row.query), field(row.tgt_table)))
    needs = {
        key: _needs(spark, select, field(row.src_schema), datasets.keys() - {key})
        for key, (row, select) in datasets.items()
    }
    def rebuild(key: str) -> str:
        row, select = datasets[key]
        source_schema, schema = field(row.src_schema), field(row.tgt_schema, "gold")
        table = field(row.tgt_table)
        with fair_share(spark, f"{schema}.{table}"):
            site.create_schema(spark, schema)
            replace_table(query_in(spark, select, source_schema, site), site, schema, table)
            name = site.table(schema, table)
            source = f"{site.catalog}.{source_schema}.{field(row.src_table)}"
            comment = f"GROUP_ID={group} | {source} -> {site.catalog}.{schema}.{table}"
            spark.sql(f"COMMENT ON TABLE {name} IS :comment", args={"comment": comment})
            quality = text_literal(schema)
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = {quality})")
        return f"{schema}.{table}"

    published, failed = _in_order(needs, inheritable_thread_target(spark)(rebuild), parallelism)
    if failed:
        first = next(error for error in failed.values() if error)
        raise PublishFailed(f"Not rebuilt: {', '.join(failed)}; first cause: {first}") from first
    return published


def _in_order(
    needs: dict[str, set[str]], rebuild: Callable[[str], str], parallelism: int
) -> tuple[list[str], dict[str, Exception | None]]:
    """Rebuild what has all it needs, as places in the pool come free.

    Returns the results, what is read before what reads it, and what failed; with None where
    something that it needs did.
    """
    graph = TopologicalSorter(needs)
    try:
        graph.prepare()
        order = list(TopologicalSorter(needs).static_order())
    except CycleError as error:
        raise ValueError(f"Datasets read each other: {', '.join(error.args[1])}") from error
    done: dict[str, str] = {}
    failed: dict[str, Exception | None] = {}
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        while graph.is_active():
            for key in sorted(graph.get_ready()):
                if needs[key] & failed.keys():
                    failed[key] = None
                    graph.done(key)
                else:
                    running[pool.submit(rebuild, key)] = key
            if not running:
                continue
            for job in wait(running, return_when=FIRST_COMPLETED).done:
                key = running.pop(job)
                error = job.exception()
                if error is None:
                    done[key] = job.result()
                elif isinstance(error, Exception):
                    log.warning("view %s failed", key, exc_info=error)
                    failed[key] = error
                else:
                    raise error
                graph.done(key)
    return [done[key] for key in order if key in done], failed


def _needs(spark: SparkSession, select: str, source_schema: str, known: set[str]) -> set[str]:
    """The datasets among ``known`` that a query reads."""
    written = reads(spark, select)
    names = {name if "." in name else f"{source_schema}.{name}".lower() for name in written}
    return {key for key in known if any(name == key or name.endswith(f".{key}") for name in names)}
