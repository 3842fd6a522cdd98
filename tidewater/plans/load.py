"""Load of accepted rows into the star schema."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.numbers import money
from tidewater.operators import constraints, dimensions, finance, upsert
from tidewater.operators.audit import LOG_PARTITION, LogEntry, append_log
from tidewater.operators.keys import kept_with_places
from tidewater.schemas import (
    AUDIT_LOG,
    DIM_COST_CENTER,
    DIM_DATE,
    DIM_REGION,
    DIM_SHIFT,
    DIM_SOURCE,
    FACT_FINANCE,
    FACT_OPERATIONS,
    STAGING_OPERATIONS,
    Table,
    conform,
)
from tidewater.sources.catalog import open_run_table, replace_run_at_once
from tidewater.sources.checkpoint import settled
from tidewater.sources.readers import read_csv
from tidewater.sources.tables import (
    append_rows,
    open_table,
    read_table,
    replace_run,
    write_staging,
)

DIMENSIONS: dict[str, Table] = {
    "dim_date": DIM_DATE,
    "dim_region": DIM_REGION,
    "dim_shift": DIM_SHIFT,
    "dim_cost_center": DIM_COST_CENTER,
    "dim_source": DIM_SOURCE,
}
FACTS: dict[str, Table] = {"fact_operations": FACT_OPERATIONS, "fact_finance": FACT_FINANCE}
RUN_PARTITION = ("pipeline_run_date",)
STAGED: Table = {**STAGING_OPERATIONS, "total_cost": "decimal(12,2)"}
# Dimension, its name column and key, and the staging column that brings new names.
SEEDED = (
    ("dim_region", "region_name", "region_key", "region"),
    ("dim_shift", "shift_name", "shift_key", "shift"),
    ("dim_source", "source_name", "source_key", "record_source"),
)


# Fixed value: the step name that audit reports know the operations load by.
LOAD_STEP = "usp_load_fact_operations"
FINANCE_STEP = "Load: Finance"


class RepeatedKeyError(RuntimeError):
    """The staging rows repeat a merge key that the fact table already holds."""


def stage_operations(accepted: DataFrame) -> DataFrame:
    """Enriched rows with the staging table's types, plus the cost computed from them."""
    staged = conform(accepted, STAGING_OPERATIONS)
    return staged.withColumn("total_cost", money(F.col("cost_per_unit"), F.col("units_processed")))


def read_dimensions(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: open_table(spark, f"{root}/{name}", table) for name, table in DIMENSIONS.items()}


def create_star_schema(spark: SparkSession, root: str) -> None:
    """Create every table that does not exist yet, empty; the jobs also do so on first use."""
    read_dimensions(spark, root)
    for name, table in FACTS.items():
        open_table(spark, f"{root}/{name}", table, RUN_PARTITION)
    open_table(spark, f"{root}/pipeline_audit_log", AUDIT_LOG, LOG_PARTITION)


def populate_dim_date(
    spark: SparkSession,
    root: str,
    start: date = dimensions.CALENDAR_START,
    end: date = dimensions.CALENDAR_END,
) -> DataFrame:
    """Append the days that the calendar table lacks; returns how many days it then holds."""
    existing = open_table(spark, f"{root}/dim_date", DIM_DATE)
    days = dimensions.date_dimension(spark, start, end)
    fresh = settled(dimensions.absent(existing, days, "date_key"))
    if not fresh.isEmpty():
        append_rows(fresh, f"{root}/dim_date", DIM_DATE)
    held = read_table(spark, f"{root}/dim_date", DIM_DATE)
    return held.agg(F.count(F.lit(1)).alias("dates_populated"))


def _seed(spark: SparkSession, root: str, dim: str, name: str, key: str, names: DataFrame) -> None:
    """Append the members that a dimension lacks. Rows that it holds are never written again."""
    table = DIMENSIONS[dim]
    existing = open_table(spark, f"{root}/{dim}", table)
    fresh = dimensions.new_members(existing, names, name, key)
    if not fresh.isEmpty():
        append_rows(fresh, f"{root}/{dim}", table)


def seed_dimensions(spark: SparkSession, staging_path: str, root: str) -> None:
    """Add regions, shifts and sources that staging names and the dimensions lack."""
    columns = [column for *_, column in SEEDED]
    # Few combinations, found in one pass over three columns.
    combos = settled(read_table(spark, staging_path, STAGED).select(*columns).distinct())
    for dim, name, key, column in SEEDED:
        _seed(spark, root, dim, name, key, combos.select(F.col(column).alias(name)))


def read_staging_csv(spark: SparkSession, path: str) -> DataFrame:
    """A clean CSV that holds the staging columns, header skipped and values cast.

    A row of another length than the header, or a value that does not fit its column's type, fails
    the read. Columns that staging does not
    have are left out, and the cost is computed here again.
    """
    return stage_operations(read_csv(spark, path, strict=True))


def write_operations_staging(accepted: DataFrame, path: str) -> None:
    """Keep the day's typed staging rows, which the load then reads more than once."""
    write_staging(stage_operations(accepted), path)


def load_operations(
    spark: SparkSession,
    staging_path: str,
    root: str,
    run_ts: datetime,
    run_date: date | None = None,
    repeats: str = "fail",
    ignore_case: bool = False,
    catalog_table: str | None = None,
) -> DataFrame:
    """Upsert a staging table into ``fact_operations`` for one run date; returns the row count.

    Only the run date's partition is read and replaced. With ``catalog_table`` the facts are that
    table of the session's catalog, below the same path, and the date is replaced in one step, which
    a driver crash cannot break in two. ``repeats`` says what to do when staging
    repeats a key that the table holds: ``fail`` (nothing is written), or ``latest``, which
    loads only the row with the highest order id of each key. Without ``run_date`` the run
    counts for the day of ``run_ts``.
    """
    if repeats not in ("fail", "latest"):
        raise ValueError(f"repeats must be 'fail' or 'latest', not {repeats!r}")
    run_date = run_date or run_ts.date()
    path = f"{root}/fact_operations"

    def work() -> int:
        if catalog_table:
            target = open_run_table(spark, catalog_table, path, FACT_OPERATIONS)
        else:
            target = open_table(spark, path, FACT_OPERATIONS, RUN_PARTITION)
        target = target.filter(F.col("pipeline_run_date") == F.lit(run_date))
        staging = read_table(spark, staging_path, STAGED)
        dims = read_dimensions(spark, root)
        source = dimensions.resolve_operations(staging, dims, run_date, ignore_case)
        if repeats == "latest":
            source = latest_per_key(source)
        seen = Observation()
        merged = upsert.with_fact_keys(upsert.merge(target, source), target, run_date)
        counted = upsert.stamped(merged, run_ts).observe(
            seen, F.count_if(F.col("action") != "keep").alias("records_loaded")
        )
        if catalog_table:
            replace_run_at_once(counted, catalog_table, path, FACT_OPERATIONS, run_date)
        else:
            replace_run(counted, path, FACT_OPERATIONS, run_date)
        return seen.get["records_loaded"]

    try:
        loaded = _logged(spark, root, run_date, run_ts, LOAD_STEP, "warehouse_csv", work)
    except Exception as e:
        # A task's error reaches the driver as whatever wraps it, so it is known by its text.
        if upsert.REPEATED_KEY in str(e):
            raise RepeatedKeyError(f"{upsert.REPEATED_KEY}, run date {run_date}") from e
        raise
    return spark.createDataFrame([(loaded,)], "records_loaded bigint")


def _logged(
    spark: SparkSession,
    root: str,
    run_date: date,
    run_ts: datetime,
    step: str,
    source: str,
    work: Callable[[], int],
) -> int:
    """Run a load step and log its outcome, a failure too; returns the rows that it loaded."""

    def log(status: str, loaded: int | None = None, error: str | None = None) -> None:
        entry = LogEntry(
            run_date, run_ts, step, status, records_out=loaded, error=error, source_system=source
        )
        append_log(spark, [entry], f"{root}/pipeline_audit_log")

    try:
        loaded = work()
    except Exception as e:
        log("FAILED", error=str(e))
        raise
    log("SUCCESS", loaded)
    return loaded


def latest_per_key(source: DataFrame) -> DataFrame:
    """The row with the highest order id per merge key; equal ids by their measures."""
    order = [F.desc_nulls_last("order_id")]
    order += [F.desc_nulls_last(c) for c in (*upsert.UPDATED, "record_source")]
    return upsert.keep_one(source, upsert.MERGE_KEY, order)


def load_finance(
    spark: SparkSession,
    accepted: DataFrame,
    unit_regions: DataFrame,
    root: str,
    run_ts: datetime,
    run_date: date | None = None,
) -> DataFrame:
    """Replace one run date's finance facts; returns the cells that found no place in them.

    The finance source, the regions of the mapped units and new cost centres are added to their
    dimensions first. A cell whose unit is not mapped, or without a cost centre, is returned with
    its amounts, so that loaded and returned sums make the accepted sums. The run is logged, a
    failure too.
    """
    run_date = run_date or run_ts.date()
    lost = []

    def work() -> int:
        # One row per cell from here on, so the feed is read once.
        cells = settled(finance.finance_cells(accepted))
        sources = spark.createDataFrame([(finance.SOURCE,)], "source_name string")
        _seed(spark, root, "dim_source", "source_name", "source_key", sources)
        regions = unit_regions.select(F.col("region").alias("region_name"))
        _seed(spark, root, "dim_region", "region_name", "region_key", regions)
        names = cells.select(F.col("cost_center").alias("cost_center_name"))
        _seed(spark, root, "dim_cost_center", "cost_center_name", "cost_center_key", names)

        dims = read_dimensions(spark, root)
        known = (dims["dim_region"], dims["dim_cost_center"])
        lost.append(settled(finance.finance_unmatched(cells, *known, unit_regions)))
        rows = finance.finance_fact(cells, *known, dims["dim_source"], unit_regions)
        numbered = kept_with_places(rows, "_place")
        none = F.lit(None).cast("bigint")
        stamped = numbered.withColumns(
            {
                "fact_key": upsert.new_fact_keys(run_date, none, F.col("_place")),
                "load_timestamp": F.lit(run_ts.isoformat()).cast("timestamp_ntz"),
                "pipeline_run_date": F.lit(run_date),
            }
        )
        open_table(spark, f"{root}/fact_finance", FACT_FINANCE, RUN_PARTITION)
        replace_run(stamped, f"{root}/fact_finance", FACT_FINANCE, run_date)
        return numbered.count()

    _logged(spark, root, run_date, run_ts, FINANCE_STEP, finance.SOURCE, work)
    return lost[0]


def audit_star_schema(spark: SparkSession, root: str) -> DataFrame:
    """Every broken constraint of the loaded tables: (table_name, rule, column_name, records).

    Repeated keys, missing mandatory values and references to absent members, over all tables
    with all their rows; empty when everything holds. Facts are reduced in the scanning tasks.
    """
    tables = {**DIMENSIONS, **FACTS, "pipeline_audit_log": AUDIT_LOG}
    partitions = {**dict.fromkeys(FACTS, RUN_PARTITION), "pipeline_audit_log": LOG_PARTITION}
    held = {
        name: open_table(spark, f"{root}/{name}", table, partitions.get(name, ()))
        for name, table in tables.items()
    }
    return constraints.star_schema_faults(held)
