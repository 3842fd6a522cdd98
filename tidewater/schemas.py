"""Column names and types of every feed and table.

Each table is an ordered mapping of column to type. ``varchar(n)`` is stored as a string and its
length is checked by ``operators.constraints``; times are stored as ``HH:mm:ss`` text, since
Parquet has no time type in Spark.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import column

Table = dict[str, str]
# Column for the whole text of a record that its reader could not parse, or whose number of
# values is wrong.
UNREADABLE = "unreadable_record"
# Struct of a checked row's numbers, so that accepted text is not parsed again.
PARSED = "parsed_numbers"
NUMBER_TYPES = ("double", "int", "bigint")

# The feeds' and tables' columns, in their order, with their types.

WAREHOUSE_FEED: Table = {
    "order_id": "string",
    "order_date": "date",
    "region": "string",
    "shift": "string",
    "throughput_uph": "double",
    "dock_delay_hrs": "double",
    "defect_rate_pct": "double",
    "inventory_accuracy_pct": "double",
    "sla_hours": "double",
    "units_processed": "int",
    "cost_per_unit": "double",
}

FINANCE_FEED: Table = {
    "record_id": "string",
    "month": "string",
    "business_unit": "string",
    "cost_center": "string",
    "amount": "double",
    "record_type": "string",
}

# A saved response of the operations API, and where a record of it holds the warehouse feed's
# columns. Our own layout, since only the source's name is given.
API_PAGE: Table = {
    "request_id": "string",
    "page": "string",
    "total_pages": "string",
    "data": "array<string>",
}
API_RECORD = (
    "id string, date string, site struct<region: string, shift: string>,"
    " metrics struct<throughput_uph: string, dock_delay_hrs: string, defect_rate_pct: string,"
    " inventory_accuracy_pct: string, units_processed: string>,"
    " sla struct<hours: string>, cost struct<per_unit: string>"
)
API_PATHS = {
    "order_id": "id",
    "order_date": "date",
    "region": "site.region",
    "shift": "site.shift",
    "throughput_uph": "metrics.throughput_uph",
    "dock_delay_hrs": "metrics.dock_delay_hrs",
    "defect_rate_pct": "metrics.defect_rate_pct",
    "inventory_accuracy_pct": "metrics.inventory_accuracy_pct",
    "sla_hours": "sla.hours",
    "units_processed": "metrics.units_processed",
    "cost_per_unit": "cost.per_unit",
}

STAGING_OPERATIONS: Table = {
    "order_id": "varchar(20)",
    "order_date": "date",
    "region": "varchar(60)",
    "shift": "varchar(20)",
    "throughput_uph": "decimal(8,2)",
    "dock_delay_hrs": "decimal(8,2)",
    "defect_rate_pct": "decimal(6,2)",
    "inventory_accuracy_pct": "decimal(6,2)",
    "sla_hours": "decimal(8,2)",
    "sla_met": "boolean",
    "units_processed": "int",
    "cost_per_unit": "decimal(8,2)",
    "record_source": "varchar(40)",
}

DIM_DATE: Table = {
    "date_key": "int",
    "full_date": "date",
    "year": "int",
    "quarter": "int",
    "month_num": "int",
    "month_name": "varchar(10)",
    "week_num": "int",
    "day_of_week": "varchar(10)",
    "is_weekday": "boolean",
}

DIM_REGION: Table = {
    "region_key": "int",
    "region_name": "varchar(60)",
    "region_short": "varchar(20)",
    "zone": "varchar(30)",
    "manager": "varchar(60)",
}

DIM_SHIFT: Table = {
    "shift_key": "int",
    "shift_name": "varchar(20)",
    "start_time": "varchar(8)",
    "end_time": "varchar(8)",
}

DIM_COST_CENTER: Table = {
    "cost_center_key": "int",
    "cost_center_name": "varchar(60)",
    "category": "varchar(30)",
    "is_controllable": "boolean",
}

DIM_SOURCE: Table = {
    "source_key": "int",
    "source_name": "varchar(40)",
    "source_type": "varchar(20)",
    "ingestion_frequency": "varchar(20)",
}

FACT_OPERATIONS: Table = {
    "fact_key": "bigint",
    "date_key": "int",
    "region_key": "int",
    "shift_key": "int",
    "source_key": "int",
    "throughput_uph": "decimal(8,2)",
    "dock_delay_hrs": "decimal(8,2)",
    "defect_rate_pct": "decimal(6,2)",
    "inventory_accuracy_pct": "decimal(6,2)",
    "sla_hours": "decimal(8,2)",
    "sla_met": "boolean",
    "units_processed": "int",
    "cost_per_unit": "decimal(8,2)",
    "total_cost": "decimal(12,2)",
    "record_source": "varchar(40)",
    "load_timestamp": "timestamp_ntz",
    "pipeline_run_date": "date",
}

FACT_FINANCE: Table = {
    "fact_key": "bigint",
    "date_key": "int",
    "region_key": "int",
    "cost_center_key": "int",
    "source_key": "int",
    "revenue": "decimal(14,2)",
    "cogs": "decimal(14,2)",
    "gross_profit": "decimal(14,2)",
    "budget_amount": "decimal(14,2)",
    "actual_amount": "decimal(14,2)",
    "variance_amount": "decimal(14,2)",
    "record_source": "varchar(40)",
    "load_timestamp": "timestamp_ntz",
    "pipeline_run_date": "date",
}

AUDIT_LOG: Table = {
    "log_id": "bigint",
    "run_date": "date",
    "run_timestamp": "timestamp_ntz",
    "pipeline_step": "varchar(60)",
    "source_system": "varchar(40)",
    "status": "varchar(10)",
    # Counts are long here: one day can hold more rows than an int can count.
    "records_in": "bigint",
    "records_out": "bigint",
    "records_rejected": "bigint",
    "rejection_rate_pct": "decimal(6,2)",
    "duration_sec": "decimal(8,2)",
    "error_message": "varchar(500)",
    "inserted_at": "timestamp_ntz",
}

RUN_LOG: Table = {
    "run_date": "date",
    "run_timestamp": "timestamp_ntz",
    "step": "string",
    "status": "string",
    "records_in": "bigint",
    "records_out": "bigint",
    "records_rejected": "bigint",
    "duration_sec": "double",
    "error": "string",
}

# Keys, mandatory columns and references, checked by audit jobs instead of at write time.
PRIMARY_KEYS = {
    "dim_date": "date_key",
    "dim_region": "region_key",
    "dim_shift": "shift_key",
    "dim_cost_center": "cost_center_key",
    "dim_source": "source_key",
    "fact_operations": "fact_key",
    "fact_finance": "fact_key",
    "pipeline_audit_log": "log_id",
}
MANDATORY = {
    "dim_date": ("full_date",),
    "dim_region": ("region_name",),
    "dim_shift": ("shift_name",),
    "dim_cost_center": ("cost_center_name",),
    "dim_source": ("source_name",),
    "pipeline_audit_log": ("run_date", "run_timestamp"),
}
# Fact column to the dimension whose key it holds.
REFERENCES = {
    "fact_operations": {
        "date_key": "dim_date",
        "region_key": "dim_region",
        "shift_key": "dim_shift",
        "source_key": "dim_source",
    },
    "fact_finance": {
        "date_key": "dim_date",
        "region_key": "dim_region",
        "cost_center_key": "dim_cost_center",
        "source_key": "dim_source",
    },
}


def spark_type(declared: str) -> str:
    return "string" if declared.startswith("varchar") else declared


def ddl(table: Table) -> str:
    """The table as a schema string for readers and ``createDataFrame``."""
    return ", ".join(f"`{name}` {spark_type(kind)}" for name, kind in table.items())


def text_limits(table: Table) -> dict[str, int]:
    """Longest allowed text per ``varchar`` column."""
    found = {name: re.fullmatch(r"varchar\((\d+)\)", kind) for name, kind in table.items()}
    return {name: int(m.group(1)) for name, m in found.items() if m}


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Cast to the table's columns in its order; columns that ``df`` lacks become null.

    Values that do not fit a declared type raise, as they would on insert into a typed table.
    """
    present = set(df.columns)
    return df.select(
        *[
            (column(name) if name in present else F.lit(None)).cast(spark_type(kind)).alias(name)
            for name, kind in table.items()
        ]
    )
