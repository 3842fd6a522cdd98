"""Queries through files and tables: each writes what a job writes and reads it back.

The steps before the last read run while the query is built. Files lie in the cluster's shared
folder, one folder per query and session run.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import audit, dimensions, quality, upsert
from tidewater.operators.rules import rules_for
from tidewater.plans import daily, load
from tidewater.plans import derived as d
from tidewater.schemas import AUDIT_LOG, FACT_OPERATIONS, STAGING_OPERATIONS, WAREHOUSE_FEED, Table
from tidewater.sources import api
from tidewater.sources.checkpoint import new_folder, settled
from tidewater.sources.readers import landing_paths, read_csv, read_landing_csv
from tidewater.sources.tables import (
    export_csv,
    read_checked,
    read_run_log,
    read_table,
    write_checked,
    write_staging,
)

LANDED = (date(2024, 7, 1), date(2024, 7, 2), date(2024, 7, 3))
READ_DAYS = LANDED[1:]
EARLIER, FIRST_LOAD, SECOND_LOAD = (datetime(2024, m, day, 5, 30) for m, day in ((6, 30), (7, 1), (7, 2)))
LOG_DAY = date(2024, 6, 30)
API_METRICS = ("throughput_uph", "dock_delay_hrs", "defect_rate_pct", "inventory_accuracy_pct", "units_processed")


def _write_lines(df: DataFrame, line: Column, header: str, path: str) -> None:
    """One text per row below a header, a file per task, as a foreign system may write them."""
    options = {"header": True, "sep": "\x02", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.select(line.alias(header)).write.options(**options).csv(path)


def _csv_line(columns: list[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in columns])


def uneven_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The text feed as CSV files in which some rows lack their last value or have one too many."""
    names = list(WAREHOUSE_FEED)
    rows = d.keyed_lines(spark, sf_dir, d.WAREHOUSE_TEXT_COLUMNS)
    line = (
        F.when(F.expr("l_orderkey % 71 = 0"), _csv_line(names[:-1]))
        .when(F.expr("l_orderkey % 73 = 0"), F.concat(_csv_line(names), F.lit(",extra")))
        .otherwise(_csv_line(names))
    )
    _write_lines(rows, line, ",".join(names), path)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of a CSV feed after check and split, uneven rows with their whole text."""
    folder = new_folder(spark, "csv")
    uneven_csv(spark, sf_dir, f"{folder}/in")
    checked = quality.check(read_csv(spark, f"{folder}/in"), rules_for("warehouse"))
    write_checked(checked, f"{folder}/checked")
    return read_checked(spark, f"{folder}/checked", checked.schema)


def landed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checked rows of two of three landing days; the third day's files are not listed."""
    root = new_folder(spark, "landing")
    rows = settled(d.keyed_lines(spark, sf_dir, d.WAREHOUSE_TEXT_COLUMNS))
    names = list(WAREHOUSE_FEED)
    for i, path in enumerate(landing_paths(root, "warehouse", LANDED)):
        _write_lines(rows.filter(f"l_orderkey % {len(LANDED)} = {i}"), _csv_line(names), ",".join(names), path)
    return quality.check(read_landing_csv(spark, root, "warehouse", READ_DAYS), rules_for("warehouse"))


def landing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = landed_feed(spark, sf_dir).groupBy("landing_date", "rejected")
    return counted.agg(F.count(F.lit(1)).alias("records"))


def staged_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows of one source, read back from a staging area partitioned by source."""
    path = new_folder(spark, "staging")
    write_staging(d.staging(spark, sf_dir), path, ("record_source",))
    staged: Table = {**STAGING_OPERATIONS, "total_cost": "decimal(12,2)"}
    return read_table(spark, path, staged).filter("record_source = 'api'")


def run_log_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's run log, exported to its dated file and read back."""
    path = f"{new_folder(spark, 'logs')}/pipeline_run_log_{LOG_DAY:%Y%m%d}.csv"
    entries = d.audit_log(spark, sf_dir).filter(F.col("run_date") == F.lit(LOG_DAY))
    export_csv(audit.run_log(entries.withColumn("error_message", F.lit(None).cast("string"))), path)
    return read_run_log(spark, path)


def audit_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows per run date after two appends, and the distinct ids among them.

    The first append logs a step per run date of the events, the second another two steps each.
    """
    path = new_folder(spark, "audit")
    days = d.audit_log(spark, sf_dir).groupBy("run_date").agg(F.count(F.lit(1)).alias("n"))
    # One row per run date, made by the driver's own log.
    held = days.orderBy("run_date").collect()
    at = EARLIER
    entry = lambda r, step: audit.LogEntry(r.run_date, at, step, "SUCCESS", r.n, r.n, 0)
    audit.append_log(spark, [entry(r, "first") for r in held], path)
    audit.append_log(spark, [entry(r, step) for r in held for step in ("second", "third")], path)
    log = read_table(spark, path, AUDIT_LOG)
    epoch = F.lit(upsert.KEY_EPOCH)
    return log.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_distinct("log_id").alias("distinct_ids"),
        F.sum("records_in").alias("records_in"),
        F.count_if(
            F.shiftright("log_id", upsert.DAY_SHIFT) == F.date_diff("run_date", epoch).cast("bigint")
        ).alias("ids_of_the_day"),
    )


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as saved API responses: a page per order, eight to a request.

    Some pages are cut off, some are empty, and some records have another shape than declared.
    Order lines are grouped before they are written as text, which is several times as long.
    """
    rows = d.lines_by_order(spark, sf_dir, d.WAREHOUSE_COLUMNS)
    record = lambda r: F.to_json(
        F.struct(
            r["order_id"].alias("id"),
            r["order_date"].cast("string").alias("date"),
            F.struct(*[r[c].alias(c) for c in ("region", "shift")]).alias("site"),
            F.struct(*[r[c].alias(c) for c in API_METRICS]).alias("metrics"),
            F.struct(r["sla_hours"].alias("hours")).alias("sla"),
            F.struct(r["cost_per_unit"].alias("per_unit")).alias("cost"),
        )
    )
    other = F.concat(F.lit('{"id":"'), F.col("l_orderkey"), F.lit('","metrics":"down"}'))
    text = lambda r: F.when(r["l_partkey"] % 113 == 0, other).otherwise(record(r))
    orders = rows.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", *WAREHOUSE_FEED)).alias("lines"))
    pages = orders.select("l_orderkey", F.array_join(F.transform("lines", text), ",").alias("records"))
    head = F.expr(
        """concat('{"request_id":"REQ-', l_orderkey div 8, '","page":', l_orderkey % 8 + 1, ',"total_pages":8,"data":[')"""
    )
    whole = F.concat(head, F.expr("IF(l_orderkey % 223 = 0, '', records)"), F.lit("]}"))
    return pages.select("l_orderkey", F.when(F.expr("l_orderkey % 211 = 0"), head).otherwise(whole).alias("value"))


def _save_responses(responses: DataFrame, path: str) -> None:
    """Compressed, since the records repeat every field's name."""
    responses.select("value").write.option("compression", "gzip").text(path)


def _saved_api(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "api")
    _save_responses(api_responses(spark, sf_dir), path)
    return path


def api_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of saved API responses, unfolded and checked, both halves."""
    checked = quality.check(api.read_api(spark, _saved_api(spark, sf_dir)), rules_for("api"))
    return checked.drop("unreadable_record")


def api_missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.missing_pages(api.read_api_pages(spark, _saved_api(spark, sf_dir)))


def load_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts per run date and load time after two loads onto older facts.

    The first load brings the even days, the second the odd ones and no more copies of what is held.
    """
    rows = settled(d.all_operations(spark, sf_dir).drop("order_id"))
    source = settled(d.operations_source(rows))
    old = F.lit(EARLIER.isoformat()).cast("timestamp_ntz")
    facts = settled(d.operations_target(rows).withColumn("load_timestamp", old))
    for day_of, run_ts in ((0, FIRST_LOAD), (1, SECOND_LOAD)):
        merged = upsert.merge(facts, source.filter(f"date_key % 2 = {day_of}"))
        facts = settled(upsert.stamped(merged, run_ts).drop("action", "insert_no"))
    return facts.groupBy("pipeline_run_date", "load_timestamp").agg(
        F.count(F.lit(1)).alias("records"), F.sum("units_processed").alias("units")
    )


def run_day(spark: SparkSession, sf_dir: str) -> str:
    """A whole day over the given tables, from raw files of three sources to loaded facts.

    Odd orders come as CSV and even ones through the API. Returns the warehouse's folder.
    """
    folder = new_folder(spark, "day")
    lines = d.keyed_lines(spark, sf_dir, d.WAREHOUSE_COLUMNS)
    feed = lines.filter("l_orderkey % 2 = 1").select(*WAREHOUSE_FEED)
    feed.write.option("header", True).csv(f"{folder}/warehouse.csv")
    d.finance_feed(spark, sf_dir).write.json(f"{folder}/finance.json")
    _save_responses(api_responses(spark, sf_dir).filter("l_orderkey % 2 = 0"), f"{folder}/api.json")
    paths = daily.DailyPaths(
        f"{folder}/warehouse.csv",
        f"{folder}/finance.json",
        f"{folder}/checked",
        f"{folder}/dw",
        f"{folder}/logs",
        api_json=f"{folder}/api.json",
    )
    _, checked = daily.run_daily(spark, paths, FIRST_LOAD)
    load.create_star_schema(spark, paths.warehouse)
    load.populate_dim_date(spark, paths.warehouse, d.FIRST_DAY, d.LAST_DAY)
    accepted = daily.accepted_warehouse(checked["warehouse"], FIRST_LOAD).unionByName(
        daily.accepted_api(checked["api"], FIRST_LOAD)
    )
    load.write_operations_staging(accepted, f"{folder}/staging")
    load.seed_dimensions(spark, f"{folder}/staging", paths.warehouse)
    load.load_operations(spark, f"{folder}/staging", paths.warehouse, FIRST_LOAD)
    units = d.table(spark, sf_dir, "region").selectExpr("r_name AS business_unit", "r_name AS region")
    load.load_finance(spark, daily.accepted_finance(checked["finance"]), units, paths.warehouse, FIRST_LOAD)
    return paths.warehouse


def day_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's operations facts without their numbers, with the names behind their keys."""
    root = run_day(spark, sf_dir)
    facts = read_table(spark, f"{root}/fact_operations", FACT_OPERATIONS)
    dims = load.read_dimensions(spark, root)
    named = facts
    for _, dim, name, key in dimensions.OPERATIONS_LOOKUPS:
        named = named.join(dims[dim].select(key, F.col(name)), key)
    return named.select(
        "full_date", "region_name", "shift_name", "source_name", *upsert.UPDATED, "load_timestamp", "pipeline_run_date"
    )


def day_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_table(spark, f"{run_day(spark, sf_dir)}/pipeline_audit_log", AUDIT_LOG)
    return log.select(
        "run_date",
        "run_timestamp",
        "pipeline_step",
        "source_system",
        "status",
        "records_in",
        "records_out",
        "records_rejected",
        "rejection_rate_pct",
        "error_message",
    )
