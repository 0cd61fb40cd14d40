"""Removing a group: its targets, its control rows and its audit rows."""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.operators import delete_where
from strata.operators.replace import drop_with_files
from strata.plans import audit
from strata.plans.config import all_targets
from strata.schemas import AUDIT_TABLE, DETAIL_TABLES, GROUP, HEADER_TABLE
from strata.site import Site


def drop_targets(
    spark: SparkSession, layer: str, group_id: str, site: Site = Site()
) -> list[str]:
    """Drop every target that a layer's rows of the group name, active or not."""
    site = site.on(spark)
    dropped = []
    for row in all_targets(spark, layer, group_id, site).distinct().collect():
        if row.TARGET_SCHEMA and row.TARGET_TABLE:
            drop_with_files(spark, site, row.TARGET_SCHEMA, row.TARGET_TABLE)
            dropped.append(f"{row.TARGET_SCHEMA}.{row.TARGET_TABLE}")
    return sorted(dropped)


def delete_config(
    spark: SparkSession, control_table: str, group_id: str, site: Site = Site()
) -> None:
    """Delete the group's rows from one control table. The id is matched as stored."""
    site = site.on(spark)
    if control_table == AUDIT_TABLE:
        audit.delete(spark, group_id, site)
        return
    delete_where(
        spark, site, site.admin, control_table, f"{GROUP} = :group", args={"group": group_id}
    )


def cleanup_group(
    spark: SparkSession,
    group_id: str,
    site: Site = Site(),
    *,
    delete_header: bool = False,
    delete_l0: bool = False,
    delete_l1: bool = False,
    delete_l2: bool = False,
    delete_audit: bool = False,
    drop_bronze: bool = False,
    drop_silver: bool = False,
    drop_gold: bool = False,
) -> list[str]:
    """Do the chosen steps and return the dropped targets.

    Targets go before the detail rows that name them.
    """
    if not (group_id or "").strip():
        raise ValueError("GROUP_ID must not be empty.")
    drops = {"L0": drop_bronze, "L1": drop_silver, "L2": drop_gold}
    deletes = {
        DETAIL_TABLES["L0"]: delete_l0,
        DETAIL_TABLES["L1"]: delete_l1,
        DETAIL_TABLES["L2"]: delete_l2,
        AUDIT_TABLE: delete_audit,
    }
    if not (delete_header or any(drops.values()) or any(deletes.values())):
        raise ValueError("Select at least one action.")

    if delete_header:
        delete_config(spark, HEADER_TABLE, group_id, site)
    dropped: list[str] = []
    for layer, chosen in drops.items():
        if chosen:
            dropped += drop_targets(spark, layer, group_id, site)
    for control_table, chosen in deletes.items():
        if chosen:
            delete_config(spark, control_table, group_id, site)
    return dropped
