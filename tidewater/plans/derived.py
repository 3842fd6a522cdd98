"""The pipeline's feeds and tables, derived from the given order tables.

The given tables come from another domain, so each view maps them to a feed with every kind of
fault that the rules look for. The oracle queries hold the same views as SQL text.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import quality
from tidewater.operators.dimensions import calendar_rows, date_dimension, resolve_operations
from tidewater.operators.enrich import enrich_finance, enrich_warehouse
from tidewater.operators.rules import RULES
from tidewater.operators.upsert import MERGE_KEY, keep_one
from tidewater.plans.load import stage_operations

RUN_DATE = date(2024, 7, 1)
OLDER_RUN = date(2024, 6, 30)
# First and last day that the warehouse feed can have.
FIRST_DAY = date(2024, 1, 1)
LAST_DAY = FIRST_DAY + timedelta(181)
# Keys that the target holds for the run.
HELD_KEYS = "date_key % 3 = 0"
OLD_FACT = (
    "4 AS source_key",
    "CAST(1 AS DECIMAL(8,2)) AS throughput_uph",
    "CAST(0.01 AS DECIMAL(8,2)) AS dock_delay_hrs",
    "CAST(77.5 AS DECIMAL(6,2)) AS defect_rate_pct",
    "CAST(1.5 AS DECIMAL(6,2)) AS inventory_accuracy_pct",
    "CAST(99.5 AS DECIMAL(8,2)) AS sla_hours",
    "CAST(NULL AS BOOLEAN) AS sla_met",
    "1 AS units_processed",
    "CAST(0.01 AS DECIMAL(8,2)) AS cost_per_unit",
    "'legacy' AS record_source",
    "CAST(0.01 AS DECIMAL(12,2)) AS total_cost",
)


# Types of the given tables' columns that the views read. Declared, so that opening a table
# costs no job that reads file footers.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_discount double, l_tax double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}

# Every fault that the rules look for: nulls, bad signs and values out of range.
WAREHOUSE_COLUMNS = (
    "CASE WHEN l_orderkey % 100 <> 0 THEN concat('ORD-', l_orderkey, '-', l_linenumber) END"
    " AS order_id",
    "date_add(DATE '2024-01-01', CAST(l_orderkey % 182 AS INT)) AS order_date",
    "r_name AS region",
    "CASE WHEN l_linenumber % 2 = 1 THEN 'Day' ELSE 'Night' END AS shift",
    "CASE WHEN l_orderkey % 53 = 0 THEN -99D ELSE CAST(80 + l_partkey % 71 AS DOUBLE) END"
    " AS throughput_uph",
    "CASE WHEN l_partkey % 97 = 0 THEN 60D ELSE (l_quantity - 1) / 8 END AS dock_delay_hrs",
    "CASE WHEN l_orderkey % 31 = 0 THEN 150D WHEN l_suppkey % 41 = 0 THEN NULL"
    " ELSE rint(l_discount * 100) END AS defect_rate_pct",
    "CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN 120D"
    " ELSE 100 - rint(l_tax * 100) END AS inventory_accuracy_pct",
    "CASE WHEN l_suppkey % 37 <> 0 THEN 12 + l_quantity / 2 END AS sla_hours",
    "CASE WHEN l_partkey % 101 = 0 THEN 0 WHEN l_partkey % 103 = 0 THEN NULL"
    " ELSE CAST(l_quantity AS INT) * 9 END AS units_processed",
    "CAST(300 + l_partkey % 300 AS DOUBLE) / 100 AS cost_per_unit",
)

# The same feed as a text reader delivers it, with missing-value markers and odd numbers.
WAREHOUSE_TEXT_COLUMNS = (
    "CASE WHEN l_orderkey % 100 = 0 THEN 'None'"
    " ELSE concat('ORD-', l_orderkey, '-', l_linenumber) END AS order_id",
    "CAST(date_add(DATE '2024-01-01', CAST(l_orderkey % 182 AS INT)) AS STRING) AS order_date",
    "CASE WHEN l_orderkey % 101 = 0 THEN '' ELSE r_name END AS region",
    "CASE WHEN l_linenumber % 2 = 1 THEN 'Day' ELSE 'Night' END AS shift",
    "CASE WHEN l_orderkey % 53 = 0 THEN '1d' WHEN l_orderkey % 59 = 0 THEN 'n/a'"
    " WHEN l_orderkey % 61 = 0 THEN 'abc' WHEN l_orderkey % 67 = 0 THEN ' 1.2e2 '"
    " ELSE CAST(80 + l_partkey % 71 AS STRING) END AS throughput_uph",
    "CASE WHEN l_partkey % 97 = 0 THEN '60' WHEN l_partkey % 91 = 0 THEN 'late'"
    " ELSE CAST((l_quantity - 1) / 8 AS STRING) END AS dock_delay_hrs",
    "CASE WHEN l_orderkey % 31 = 0 THEN 'inf' WHEN l_orderkey % 37 = 0 THEN 'abc'"
    " WHEN l_orderkey % 41 = 0 THEN '1e400' WHEN l_orderkey % 43 = 0 THEN '-0.5'"
    " ELSE CAST(CAST(rint(l_discount * 100) AS INT) AS STRING) END AS defect_rate_pct",
    "CASE WHEN l_partkey % 89 = 0 THEN 'NA' WHEN l_partkey % 83 = 0 THEN '120'"
    " ELSE CAST(CAST(100 - rint(l_tax * 100) AS INT) AS STRING) END AS inventory_accuracy_pct",
    "CASE WHEN l_suppkey % 37 = 0 THEN 'n/a' WHEN l_suppkey % 43 = 0 THEN 'soon'"
    " ELSE CAST(12 + l_quantity / 2 AS STRING) END AS sla_hours",
    "CASE WHEN l_partkey % 101 = 0 THEN '0' WHEN l_partkey % 103 = 0 THEN '<NA>'"
    " WHEN l_partkey % 107 = 0 THEN concat(CAST(l_quantity AS INT) * 9, '.7')"
    " ELSE CAST(CAST(l_quantity AS INT) * 9 AS STRING) END AS units_processed",
    "CAST(CAST(300 + l_partkey % 300 AS DOUBLE) / 100 AS STRING) AS cost_per_unit",
)

RECORD_SOURCE = (
    "CASE WHEN units_processed % 99 = 0 THEN 'api' WHEN units_processed % 207 = 0 THEN 'upload'"
    " ELSE 'warehouse_csv' END"
)

FINANCE_COLUMNS = (
    "CASE WHEN o_orderkey % 97 <> 0 THEN concat('FIN-', o_orderkey) END AS record_id",
    "concat('2024-0', 1 + o_orderkey % 6) AS month",
    "r_name AS business_unit",
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Labor' WHEN '2-HIGH' THEN 'Freight'"
    " WHEN '3-MEDIUM' THEN 'Facilities' WHEN '4-NOT SPECIFIED' THEN 'SG&A'"
    " ELSE 'Technology' END AS cost_center",
    "CASE WHEN o_orderkey % 59 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount",
    "CASE WHEN o_orderkey % 7 < 4 THEN 'actual' ELSE 'budget' END AS record_type",
)

AUDIT_COLUMNS = (
    "event_id AS log_id",
    "date_add(DATE '2024-04-01', CAST(event_id % 91 AS INT)) AS run_date",
    "ts AS run_timestamp",
    "event_type AS pipeline_step",
    "CASE user_id % 3 WHEN 0 THEN 'warehouse_csv' WHEN 1 THEN 'finance_json' ELSE 'api' END"
    " AS source_system",
    "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status",
    "CASE WHEN user_id % 7 <> 0 THEN 1800 + event_id % 400 END AS records_in",
    "1800 + event_id % 400 - event_id % 83 AS records_out",
    "CASE WHEN user_id % 7 <> 0 THEN event_id % 83 END AS records_rejected",
    "value AS duration_sec",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def _regions_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return nations.join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))


def _supplied_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    located = lines.join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
    return located.join(_regions_of(spark, sf_dir), F.expr("s_nationkey = n_nationkey"))


def warehouse_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One warehouse row per order line."""
    return _supplied_lines(spark, sf_dir).selectExpr(*WAREHOUSE_COLUMNS)


def warehouse_text_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplied_lines(spark, sf_dir).selectExpr(*WAREHOUSE_TEXT_COLUMNS)


def keyed_lines(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> DataFrame:
    """A feed's columns with the numbers of the order line that each row comes from."""
    return _supplied_lines(spark, sf_dir).selectExpr("l_orderkey", "l_linenumber", "l_partkey", *columns)


def lines_by_order(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> DataFrame:
    """``keyed_lines`` with the lines of an order in one task; the given columns move, not the feed's."""
    lines = _supplied_lines(spark, sf_dir).repartition("l_orderkey")
    return lines.selectExpr("l_orderkey", "l_linenumber", "l_partkey", *columns)


def finance_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One finance row per order."""
    orders = table(spark, sf_dir, "orders")
    placed = orders.join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    located = placed.join(_regions_of(spark, sf_dir), F.expr("c_nationkey = n_nationkey"))
    return located.selectExpr(*FINANCE_COLUMNS)


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per event."""
    return table(spark, sf_dir, "events").selectExpr(*AUDIT_COLUMNS)


def checked_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check(warehouse_feed(spark, sf_dir), RULES["warehouse"])


def checked_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check(finance_feed(spark, sf_dir), RULES["finance"])


def accepted_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_warehouse(quality.passed(checked_warehouse(spark, sf_dir)))


def accepted_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_finance(quality.passed(checked_finance(spark, sf_dir)))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows as if some had come by other ways, one of them unknown to the dimension."""
    accepted = accepted_warehouse(spark, sf_dir)
    return stage_operations(accepted.withColumn("record_source", F.expr(RECORD_SOURCE)))


def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All regions but one, so that the inner dimension join has rows to drop."""
    regions = table(spark, sf_dir, "region").filter("r_name <> 'MIDDLE EAST'")
    return regions.select(
        (F.col("r_regionkey") + 1).alias("region_key"), F.col("r_name").alias("region_name")
    )


def sales_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar from the first to the last order date; it spans several years."""
    day = F.col("o_orderdate").cast("date")
    bounds = table(spark, sf_dir, "orders").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    return calendar_rows(bounds)


def _named(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    """Literal rows, so that Spark knows how small they are."""
    return spark.sql(f"SELECT * FROM VALUES {rows} t({columns})")


def dimension_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimensions that lack a region and a source, so that lookups have rows to report."""
    sources = "(1, 'warehouse_csv'), (2, 'finance_json'), (3, 'api')"
    return {
        "dim_date": date_dimension(spark, FIRST_DAY, LAST_DAY),
        "dim_region": dim_region(spark, sf_dir),
        "dim_shift": _named(spark, "(1, 'Day'), (2, 'Night')", "shift_key, shift_name"),
        "dim_source": _named(spark, sources, "source_key, source_name"),
    }


def complete_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimensions that hold every name of the feed."""
    regions = table(spark, sf_dir, "region")
    sources = "(1, 'warehouse_csv'), (2, 'finance_json'), (3, 'api'), (4, 'upload')"
    return dimension_tables(spark, sf_dir) | {
        "dim_region": regions.selectExpr("r_regionkey + 1 AS region_key", "r_name AS region_name"),
        "dim_source": _named(spark, sources, "source_key, source_name"),
    }


def resolved_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged rows that the incomplete dimensions know, with their keys, for one run date."""
    dims = dimension_tables(spark, sf_dir)
    return resolve_operations(staging(spark, sf_dir), dims, RUN_DATE)


def all_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staged row with its dimension keys, for one run date."""
    dims = complete_dimensions(spark, sf_dir)
    return resolve_operations(staging(spark, sf_dir), dims, RUN_DATE)


def operations_source(rows: DataFrame) -> DataFrame:
    """A load's rows: one per key that the target holds, and every copy of all other keys."""
    held = F.expr(HELD_KEYS)
    order = [F.asc_nulls_last(c) for c in rows.columns if c not in MERGE_KEY]
    return rows.filter(~held).unionByName(keep_one(rows.filter(held), MERGE_KEY, order))


def operations_target(rows: DataFrame) -> DataFrame:
    """Facts from before the load: of a third of the days for this run, of a fifth for an older one.

    Source, lineage and all measures differ from what the load brings.
    """
    keys = rows.select(*MERGE_KEY).distinct()
    older = keys.filter("date_key % 5 = 0").withColumn("pipeline_run_date", F.lit(OLDER_RUN))
    held = keys.filter(HELD_KEYS).unionByName(older)
    return held.select(
        "date_key", "region_key", "shift_key", *[F.expr(c) for c in OLD_FACT], "pipeline_run_date"
    )


def daily_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage columns of both sources' accepted rows; each was loaded the day after its date."""
    operations = accepted_warehouse(spark, sf_dir).select(
        "record_source", F.date_add("order_date", 1).alias("pipeline_run_date")
    )
    finance = accepted_finance(spark, sf_dir).select(
        "record_source", F.date_add(F.last_day("month_dt"), 1).alias("pipeline_run_date")
    )
    return operations.unionByName(finance)


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A loaded star schema with faults of every kind: loaded without lookups or checks.

    Facts are numbered by their order, so lines of one order share a key; the dimensions lack a
    region, a source and the last days, and a shift has no name.
    """
    dims = dimension_tables(spark, sf_dir)
    known = complete_dimensions(spark, sf_dir)
    facts = resolve_operations(staging(spark, sf_dir), known, RUN_DATE)
    return {
        "dim_date": date_dimension(spark, FIRST_DAY, LAST_DAY - timedelta(30)),
        "dim_region": dims["dim_region"],
        "dim_shift": _named(spark, "(1, 'Day'), (2, NULL)", "shift_key, shift_name"),
        "dim_source": dims["dim_source"],
        "fact_operations": facts.withColumn(
            "fact_key", F.expr("CAST(split_part(order_id, '-', 2) AS BIGINT)")
        ),
    }


def reader_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation as a reader that may see its own region."""
    return _regions_of(spark, sf_dir).select(
        F.col("n_name").alias("reader"), F.col("r_name").alias("region")
    )
