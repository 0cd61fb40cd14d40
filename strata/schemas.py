"""Schemas of the control tables and names of the lineage columns."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

GROUP = "DATA_FLOW_GROUP_ID"

HEADER_TABLE = "data_flow_control_header"
DETAIL_TABLES = {
    "L0": "data_flow_l0_detail",
    "L1": "data_flow_l1_detail",
    "L2": "data_flow_l2_detail",
}
AUDIT_TABLE = "audit_log"

LINEAGE_COLUMNS = ("_etl_group_id", "_etl_layer", "_etl_env", "_etl_load_ts")

# Text columns of each control table, in table order.
_HEADER_TEXT = """
    JOB_NAME NOTEBOOK_PATH TRIGGER_TYPE ETL_LAYER COMPUTE_CLASS_DEV COMPUTE_CLASS
    BUSINESS_OBJECT_NAME COST_CENTER DATA_SME BUSINESS_UNIT PRODUCT_OWNER INGESTION_MODE
    INGESTION_BUCKET SPARK_CONFIGS WARNING_THRESHOLD_MINS WARNING_DL_GROUP MIN_VERSION
    MAX_VERSION IS_ACTIVE
"""
_L0_TEXT = """
    SOURCE_URL SOURCE_OBJ_SCHEMA SOURCE_OBJ_NAME LOB TARGET_SCHEMA TARGET_TABLE FILE_FORMAT
    INPUT_FILE_FORMAT LOAD_TYPE STORAGE_TYPE DQ_LOGIC DELIMETER CUSTOM_SCHEMA CDC_LOGIC
    PRESTAG_FLAG LS_FLAG IS_ACTIVE
"""
_SQL_LAYER_TEXT = """
    SOURCE_OBJ_SCHEMA SOURCE_OBJ_NAME TARGET_SCHEMA TARGET_TABLE LOAD_TYPE
    TRANSFORMATION_QUERY MERGE_KEYS PARTITION_BY DQ_LOGIC IS_ACTIVE
"""


def _control(text_columns: str) -> StructType:
    return StructType(
        [StructField(GROUP, StringType(), nullable=False)]
        + [StructField(name, StringType()) for name in text_columns.split()]
        + [StructField(name, TimestampType()) for name in ("CREATED_DATE", "UPDATED_DATE")]
    )


HEADER = _control(_HEADER_TEXT)
L0_DETAIL = _control(_L0_TEXT)
L1_DETAIL = _control(_SQL_LAYER_TEXT)
L2_DETAIL = _control(_SQL_LAYER_TEXT)
AUDIT = StructType(
    [StructField(name, StringType()) for name in (GROUP, "TARGET_TABLE", "ETL_LAYER", "STATUS")]
    + [StructField("ROWS_LOADED", LongType()), StructField("MESSAGE", StringType())]
    + [StructField(name, TimestampType()) for name in ("START_TIME", "END_TIME", "LOAD_TS")]
)

CONTROL_TABLES = {
    HEADER_TABLE: HEADER,
    DETAIL_TABLES["L0"]: L0_DETAIL,
    DETAIL_TABLES["L1"]: L1_DETAIL,
    DETAIL_TABLES["L2"]: L2_DETAIL,
    AUDIT_TABLE: AUDIT,
}
