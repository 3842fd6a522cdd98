"""Whole jobs over files: the daily run and the warehouse load."""

import dataclasses
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators import audit, constraints, finance, quality, upsert
from tidewater.plans import daily, derived, load
from tidewater.schemas import (
    AUDIT_LOG,
    DIM_COST_CENTER,
    DIM_DATE,
    DIM_REGION,
    FACT_FINANCE,
    FACT_OPERATIONS,
    STAGING_OPERATIONS,
    WAREHOUSE_FEED,
    conform,
    text_limits,
)
from tidewater.sources.tables import append_rows, read_table, write_staging

RUN_TS = dt.datetime(2024, 7, 1, 2, 30)
LATER = dt.datetime(2024, 7, 1, 5, 0)
NEXT_DAY = dt.datetime(2024, 7, 2, 2, 30)
DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))


def write_feeds(tmp_path, prices=(4.5, 5.0), bad=True):
    rows = [
        f"ORD-{d}{s[0]},2024-01-0{d},Region {r},{s},115.5,2.5,2.8,95.5,20.1,100,{price}"
        for d, r, price in ((1, 1, prices[0]), (2, 2, prices[1]))
        for s in ("Day", "Night")
    ]
    if bad:
        rows.append("NA,2024-01-03,Region 1,Day,-99,2.5,150,95.5,20.1,100,4.5")
    (tmp_path / "w.csv").write_text("\n".join([",".join(WAREHOUSE_FEED), *rows]) + "\n")
    finance = [
        {"record_id": f"FIN-{i}", "month": "2024-01", "business_unit": unit, "cost_center": center,
         "amount": amount, "record_type": kind}
        for i, (unit, center, amount, kind) in enumerate(
            [("NE", "Labor", 100.5, "actual"), ("NE", "Labor", 80.25, "budget"),
             ("NE", "Labor", 10, "actual"), ("SE", "Freight", 5, "actual"), ("NE", "Labor", -1, "actual")]
        )
    ]
    (tmp_path / "f.json").write_text(json.dumps(finance))
    return daily.DailyPaths(
        str(tmp_path / "w.csv"),
        str(tmp_path / "f.json"),
        str(tmp_path / "staging"),
        str(tmp_path / "dw"),
        str(tmp_path / "logs"),
        finance_is_array=True,
    )


def test_daily_run(spark, tmp_path):
    paths = write_feeds(tmp_path)
    summary, checked = daily.run_daily(spark, paths, RUN_TS)
    row = summary.first()
    assert (row.steps, row.failures) == (4, 0)
    assert (row.records_in, row.records_out, row.records_rejected) == (10, 8, 2)
    assert row.rejected_pct == 20.0
    (bad,) = quality.rejected(checked["warehouse"]).collect()
    assert bad.rejection_reason == (
        "null:order_id non_positive:throughput_uph out_of_range:defect_rate_pct"
    )
    log = read_table(spark, paths.audit, AUDIT_LOG).orderBy("log_id").collect()
    first = (RUN_TS.date() - upsert.KEY_EPOCH).days << upsert.DAY_SHIFT
    assert sorted(r.log_id - first for r in log) == [0, 1, 2, 3]
    by_step = {r.pipeline_step: r for r in log}
    wh = by_step["Quality Check: Warehouse"]
    assert (wh.records_in, wh.records_out, wh.records_rejected) == (5, 4, 1)
    assert float(wh.rejection_rate_pct) == 20.0 and wh.duration_sec > 0
    assert wh.run_date == RUN_TS.date() and wh.status == "SUCCESS"
    (saved,) = (tmp_path / "logs" / "pipeline_run_log_20240701.csv").glob("*.csv")
    assert saved.read_text().startswith("run_date,run_timestamp,step,status,records_in,")

    # A rerun of the day without bad rows leaves no rejects of the first run.
    _, checked = daily.run_daily(spark, write_feeds(tmp_path, bad=False), LATER)
    assert quality.rejected(checked["warehouse"]).count() == 0
    assert read_table(spark, paths.audit, AUDIT_LOG).agg(F.max("log_id")).first()[0] == first + 7


def test_failed_run_is_logged(spark, tmp_path):
    paths = write_feeds(tmp_path)
    (tmp_path / "w.csv").write_text("order_id,region\nORD-1,Region 1\n")
    with pytest.raises(quality.MissingColumnsError):
        daily.run_daily(spark, paths, RUN_TS)
    log = {r.pipeline_step: r for r in read_table(spark, paths.audit, AUDIT_LOG).collect()}
    assert len(log) == 3  # the run stops at the failing step
    failed = log["Quality Check: Warehouse"]
    assert failed.status == "FAILED"
    assert failed.error_message.startswith("The feed lacks required columns: ['order_date'")
    assert not (tmp_path / "staging" / "warehouse").exists()


def staged(spark, tmp_path, run_ts, **feeds):
    paths = write_feeds(tmp_path, **feeds)
    _, checked = daily.run_daily(spark, paths, run_ts)
    path = str(tmp_path / "staging" / "operations")
    load.write_operations_staging(daily.accepted_warehouse(checked["warehouse"], run_ts), path)
    return path, checked


def facts(spark, root):
    return read_table(spark, f"{root}/fact_operations", FACT_OPERATIONS)


def test_load(spark, tmp_path):
    root = str(tmp_path / "dw")
    load.create_star_schema(spark, root)
    assert load.populate_dim_date(spark, root, *DAYS).first().dates_populated == 31
    staging, _ = staged(spark, tmp_path, RUN_TS)
    load.seed_dimensions(spark, staging, root)
    assert load.load_operations(spark, staging, root, RUN_TS).first().records_loaded == 4
    first = {(r.date_key, r.region_key, r.shift_key): r for r in facts(spark, root).collect()}
    row = first[20240101, 1, 1]
    assert (float(row.total_cost), row.sla_met, row.record_source) == (450.0, True, "warehouse_csv")
    assert row.load_timestamp == RUN_TS and row.pipeline_run_date == RUN_TS.date()
    assert len({r.fact_key for r in first.values()}) == 4

    # The same day again with other prices: updates in place.
    staging, _ = staged(spark, tmp_path, LATER, prices=(6.0, 5.0))
    assert load.load_operations(spark, staging, root, LATER).first().records_loaded == 4
    second = {(r.date_key, r.region_key, r.shift_key): r for r in facts(spark, root).collect()}
    assert {k: r.fact_key for k, r in second.items()} == {k: r.fact_key for k, r in first.items()}
    assert float(second[20240101, 1, 1].total_cost) == 600.0
    assert {r.load_timestamp for r in second.values()} == {LATER}

    # Another run date: inserted next to the old rows, whose files stay.
    folder = tmp_path / "dw" / "fact_operations" / "pipeline_run_date=2024-07-01"
    before = {p.name: p.stat().st_mtime_ns for p in folder.iterdir()}
    staging, _ = staged(spark, tmp_path, NEXT_DAY)
    load.seed_dimensions(spark, staging, root)
    assert load.load_operations(spark, staging, root, NEXT_DAY).first().records_loaded == 4
    assert {p.name: p.stat().st_mtime_ns for p in folder.iterdir()} == before
    assert facts(spark, root).count() == 8
    assert facts(spark, root).select("fact_key").distinct().count() == 8
    assert load.populate_dim_date(spark, root, *DAYS).first().dates_populated == 31
    audit = read_table(spark, f"{root}/pipeline_audit_log", AUDIT_LOG)
    loads = audit.filter("pipeline_step = 'usp_load_fact_operations'")
    assert loads.count() == 3
    assert loads.filter("records_in IS NULL AND duration_sec IS NULL AND records_out = 4").count() == 3


def test_staging_from_csv(spark, tmp_path):
    columns = [c for c in STAGING_OPERATIONS]
    row = "ORD-1,2024-01-05,Region 1,Day,115.5,0.125,2.8,95.5,20.1,True,100,4.555,warehouse_csv"
    path = tmp_path / "clean.csv"
    path.write_text(",".join([*columns, "year"]) + "\n" + row + ",2024\n")
    (out,) = load.read_staging_csv(spark, str(path)).collect()
    assert (out.order_date, out.sla_met, out.units_processed) == (dt.date(2024, 1, 5), True, 100)
    # Two decimals, halves up; the cost follows the staged price.
    assert [str(x) for x in (out.dock_delay_hrs, out.cost_per_unit, out.total_cost)] == [
        "0.13", "4.56", "456.00",
    ]
    path.write_text(",".join(columns) + "\n" + row.replace("115.5", "1234567") + "\n")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        load.read_staging_csv(spark, str(path)).collect()


def test_load_with_repeated_keys(spark, tmp_path):
    root = str(tmp_path / "dw")
    load.populate_dim_date(spark, root, *DAYS)
    staging, _ = staged(spark, tmp_path, RUN_TS)
    load.seed_dimensions(spark, staging, root)
    rows = read_table(spark, staging, load.STAGED)
    copies = rows.withColumn("order_id", F.concat("order_id", F.lit("-2")))
    twice = str(tmp_path / "staging" / "twice")
    write_staging(rows.unionAll(copies), twice)
    # Nothing is held yet, so every copy is inserted; the next load of the day cannot match them.
    assert load.load_operations(spark, twice, root, RUN_TS).first().records_loaded == 8
    before = sorted(map(str, facts(spark, root).collect()))
    with pytest.raises(load.RepeatedKeyError):
        load.load_operations(spark, twice, root, LATER)
    assert sorted(map(str, facts(spark, root).collect())) == before
    again = load.load_operations(spark, twice, root, LATER, repeats="latest")
    assert again.first().records_loaded == 8
    assert {r.load_timestamp for r in facts(spark, root).collect()} == {LATER}
    with pytest.raises(ValueError, match="repeats"):
        load.load_operations(spark, twice, root, LATER, repeats="some")


def test_lossy_values_are_logged(spark, tmp_path):
    paths = write_feeds(tmp_path)
    feed = (tmp_path / "w.csv").read_text().replace(",2.8,", ",abc,", 1).replace(",100,4.5", ",12.7,4.5", 1)
    (tmp_path / "w.csv").write_text(feed)
    daily.run_daily(spark, paths, RUN_TS)
    log = {r.pipeline_step: r for r in read_table(spark, paths.audit, AUDIT_LOG).collect()}
    told = log["Quality Check: Warehouse"].error_message
    assert told.endswith("defect_rate_pct 1, units_processed 1")
    assert log["Quality Check: Finance"].error_message is None


def test_long_errors_stay_whole(spark, tmp_path):
    text = "x" * 2000
    entry = audit.LogEntry(RUN_TS.date(), RUN_TS, "step", "FAILED", error=text)
    path = str(tmp_path / "log")
    audit.append_log(spark, [entry], path)
    log = read_table(spark, path, AUDIT_LOG)
    assert log.first().error_message == text
    over = constraints.too_long(log, text_limits(AUDIT_LOG)).filter("too_long_records > 0")
    assert [(r.column_name, r.too_long_records) for r in over.collect()] == [("error_message", 1)]


def test_failed_load_is_logged(spark, tmp_path):
    root = str(tmp_path / "dw")
    load.create_star_schema(spark, root)
    with pytest.raises(Exception):
        load.load_operations(spark, str(tmp_path / "absent"), root, RUN_TS)
    (row,) = read_table(spark, f"{root}/pipeline_audit_log", AUDIT_LOG).collect()
    assert (row.pipeline_step, row.status) == (load.LOAD_STEP, "FAILED") and row.error_message


def test_members_are_only_appended(spark, tmp_path):
    """A run broken off at any point leaves the members that facts refer to as they are."""
    root = str(tmp_path / "dw")
    staging, _ = staged(spark, tmp_path, RUN_TS)
    load.seed_dimensions(spark, staging, root)
    load.populate_dim_date(spark, root, *DAYS)
    files = {p: p.stat().st_mtime_ns for d in ("dim_region", "dim_date") for p in (tmp_path / "dw" / d).glob("*.parquet")}
    rows = read_table(spark, staging, load.STAGED)
    more = str(tmp_path / "staging" / "more")
    write_staging(rows.withColumn("region", F.lit("Another")), more)
    load.seed_dimensions(spark, more, root)
    load.populate_dim_date(spark, root, DAYS[0], dt.date(2024, 2, 2))
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    regions = {r.region_name: r.region_key for r in read_table(spark, f"{root}/dim_region", DIM_REGION).collect()}
    assert regions == {"Region 1": 1, "Region 2": 2, "Another": 3}
    assert read_table(spark, f"{root}/dim_date", DIM_DATE).count() == 33
    before = set((tmp_path / "dw" / "dim_region").glob("*.parquet"))
    load.seed_dimensions(spark, more, root)
    assert set((tmp_path / "dw" / "dim_region").glob("*.parquet")) == before


def test_finance_load(spark, tmp_path):
    root = str(tmp_path / "dw")
    load.create_star_schema(spark, root)
    staging, checked = staged(spark, tmp_path, RUN_TS)
    load.seed_dimensions(spark, staging, root)
    load.load_operations(spark, staging, root, RUN_TS)
    units = spark.createDataFrame([("NE", "Region 1")], "business_unit string, region string")
    accepted = daily.accepted_finance(checked["finance"])
    for run_ts in (RUN_TS, LATER):
        (lost,) = load.load_finance(spark, accepted, units, root, run_ts).collect()
    assert (lost.business_unit, lost.unmatched, float(lost.actual_amount)) == ("SE", "business_unit", 5.0)
    (row,) = read_table(spark, f"{root}/fact_finance", FACT_FINANCE).collect()
    assert (row.date_key, row.region_key, row.revenue) == (20240101, 1, None)
    assert [float(x) for x in (row.actual_amount, row.budget_amount, row.variance_amount)] == [
        110.5, 80.25, 30.25,
    ]
    assert row.load_timestamp == LATER
    centers = read_table(spark, f"{root}/dim_cost_center", DIM_COST_CENTER).collect()
    assert {r.cost_center_name for r in centers} == {"Labor", "Freight"}
    audit_rows = read_table(spark, f"{root}/pipeline_audit_log", AUDIT_LOG).filter("source_system = 'finance_json'")
    assert audit_rows.filter("pipeline_step = 'Load: Finance' AND records_out = 1 AND status = 'SUCCESS'").count() == 2

    # A mapping to a region that no staging row named adds it; a missing cost centre is reported.
    units = units.unionByName(spark.createDataFrame([("SE", "Elsewhere")], units.schema))
    null_center = accepted.withColumn("cost_center", F.when(F.col("business_unit") == "NE", F.col("cost_center")))
    (lost,) = load.load_finance(spark, null_center, units, root, LATER).collect()
    assert (lost.business_unit, lost.unmatched) == ("SE", "cost_center")
    assert load.load_finance(spark, accepted, units, root, LATER).count() == 0
    assert read_table(spark, f"{root}/fact_finance", FACT_FINANCE).count() == 2

    # A rerun without any accepted row leaves no old facts.
    load.load_finance(spark, accepted.limit(0), units, root, LATER)
    assert read_table(spark, f"{root}/fact_finance", FACT_FINANCE).count() == 0


def test_sums_loaded_and_reported_make_the_accepted_sum(spark, sf_dir, tmp_path):
    root = str(tmp_path / "dw")
    accepted = derived.accepted_finance(spark, sf_dir)
    units = derived.table(spark, sf_dir, "region").filter("r_name <> 'ASIA'").selectExpr("r_name AS business_unit", "r_name AS region")
    lost = load.load_finance(spark, accepted, units, root, RUN_TS)
    held = read_table(spark, f"{root}/fact_finance", FACT_FINANCE)

    def total(df):
        return df.agg(F.sum(F.coalesce("budget_amount", F.lit(0)) + F.coalesce("actual_amount", F.lit(0)))).first()[0]

    whole = accepted.agg(F.sum(F.col("amount").cast("decimal(18,2)"))).first()[0]
    assert lost.count() > 0 and total(held) + total(lost) == whole


def test_unknown_source_is_an_error(spark):
    none = spark.createDataFrame([], "source_key int, source_name string")
    with pytest.raises(finance.UnknownSourceError):
        finance.finance_fact(none, none, none, none, none)


def test_audit_of_the_star_schema(spark, tmp_path):
    root = str(tmp_path / "dw")
    load.create_star_schema(spark, root)
    assert load.audit_star_schema(spark, root).count() == 0
    load.populate_dim_date(spark, root, *DAYS)
    staging, checked = staged(spark, tmp_path, RUN_TS)
    load.seed_dimensions(spark, staging, root)
    load.load_operations(spark, staging, root, RUN_TS)
    units = spark.createDataFrame([("NE", "Region 1"), ("SE", "Region 2")], "business_unit string, region string")
    load.load_finance(spark, daily.accepted_finance(checked["finance"]), units, root, RUN_TS)
    assert load.audit_star_schema(spark, root).count() == 0
    append_rows(spark.createDataFrame([(1, None)], "region_key int, region_name string"), f"{root}/dim_region", DIM_REGION)
    lost = [(5, 20240101, 9, 1, 1, RUN_TS.date())]
    columns = "fact_key long, date_key int, region_key int, shift_key int, source_key int, pipeline_run_date date"
    lost = conform(spark.createDataFrame(lost, columns), FACT_OPERATIONS)
    lost.write.mode("append").partitionBy("pipeline_run_date").parquet(f"{root}/fact_operations")
    faults = {(r.table_name, r.rule, r.column_name): r.records for r in load.audit_star_schema(spark, root).collect()}
    assert faults == {
        ("dim_region", "primary_key", "region_key"): 2,
        ("dim_region", "not_null", "region_name"): 1,
        ("fact_operations", "foreign_key", "region_key"): 1,
    }


def test_log_appends_ask_their_own_date_only(spark, tmp_path):
    path = str(tmp_path / "log")
    days = [dt.date(2024, 7, d) for d in (1, 2, 3)]
    entry = lambda day, step: audit.LogEntry(day, RUN_TS, step, "SUCCESS", 1, 1, 0)
    audit.append_log(spark, [entry(d, "a") for d in days], path)
    audit.append_log(spark, [entry(days[1], "b"), entry(days[1], "a")], path)
    audit.append_log(spark, [], path)
    log = read_table(spark, path, AUDIT_LOG)
    rows = log.orderBy("log_id").collect()
    assert [(r.run_date, r.pipeline_step) for r in rows] == [
        (days[0], "a"), (days[1], "a"), (days[1], "a"), (days[1], "b"), (days[2], "a")
    ]
    assert len({r.log_id for r in rows}) == 5
    plan = audit.logged_on(spark, path, days[1:2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan and "InMemoryFileIndex(1 paths)" in plan
    # Two appends of one date that run after each other stay unique, whatever other dates hold.
    assert log.filter(F.col("run_date") == days[1]).agg(F.count_distinct("log_id")).first()[0] == 3
    assert {p.name for p in (tmp_path / "log").glob("run_date=*")} == {f"run_date={d}" for d in days}


def api_pages(rows, per_page=2):
    pages = [rows[i : i + per_page] for i in range(0, len(rows), per_page)]
    return [
        {"request_id": "r1", "page": n, "total_pages": len(pages), "data": page} for n, page in enumerate(pages, 1)
    ]


def api_record(n, shift="Day", **metrics):
    held = {"throughput_uph": 120.5, "dock_delay_hrs": 0.5, "defect_rate_pct": 1, "inventory_accuracy_pct": 99,
            "units_processed": 10 + n}
    return {
        "id": f"API-{n}", "date": f"2024-01-0{n}", "site": {"region": "Region 1", "shift": shift},
        "metrics": held | metrics, "sla": {"hours": 20}, "cost": {"per_unit": 4.5},
    }


def test_day_with_three_sources(spark, tmp_path):
    paths = write_feeds(tmp_path)
    records = [api_record(1), api_record(2, "Night"), api_record(3, throughput_uph=-1), {"id": "API-4", "site": "down"}]
    lines = [json.dumps(p) for p in api_pages(records)] + ['{"request_id": "r2", "page": 1, "da']
    (tmp_path / "api.json").write_text("\n".join(lines) + "\n")
    paths = dataclasses.replace(paths, api_json=str(tmp_path / "api.json"))
    summary, checked = daily.run_daily(spark, paths, RUN_TS)
    assert summary.first().steps == 6
    bad = {r.unreadable_record: r.rejection_reason for r in quality.rejected(checked["api"]).collect()}
    assert len(bad) == 3 and bad[None] == "non_positive:throughput_uph"
    assert all(why.startswith("unreadable_record null:order_id") for text, why in bad.items() if text)

    root, staging = paths.warehouse, str(tmp_path / "stage")
    both = daily.accepted_warehouse(checked["warehouse"], RUN_TS).unionByName(daily.accepted_api(checked["api"], RUN_TS))
    load.write_operations_staging(both, staging)
    load.populate_dim_date(spark, root, *DAYS)
    load.seed_dimensions(spark, staging, root)
    # The API's first record has the key of a CSV row: one of them has to be chosen.
    assert load.load_operations(spark, staging, root, RUN_TS, repeats="latest").first()[0] == 5
    loaded = {r.record_source: r["count"] for r in facts(spark, root).groupBy("record_source").count().collect()}
    assert loaded == {"warehouse_csv": 4, "api": 1}
    log = {r.pipeline_step: r for r in read_table(spark, paths.audit, AUDIT_LOG).collect()}
    told = log["Quality Check: API"]
    assert (told.records_in, told.records_out, told.records_rejected, told.source_system) == (5, 2, 3, "api")


def test_load_replaces_a_date_in_one_step(spark, tmp_path, monkeypatch):
    """A load that breaks off before the switch leaves readers with the old rows, and can be rerun."""
    from tidewater.sources import catalog

    root = str(tmp_path / "dw")
    path, _ = staged(spark, tmp_path, RUN_TS)
    load.populate_dim_date(spark, root, *DAYS)
    load.seed_dimensions(spark, path, root)
    name = "facts_at_once"
    run = dict(catalog_table=name, run_date=RUN_TS.date())
    assert load.load_operations(spark, path, root, RUN_TS, **run).first()[0] == 4
    old = sorted(map(str, spark.table(name).collect()))

    path, _ = staged(spark, tmp_path, LATER, prices=(9.0, 9.5), bad=False)
    with monkeypatch.context() as broken:
        broken.setattr(catalog, "publish_version", lambda *a: (_ for _ in ()).throw(RuntimeError("driver gone")))
        with pytest.raises(RuntimeError, match="driver gone"):
            load.load_operations(spark, path, root, LATER, **run)
    assert sorted(map(str, spark.table(name).collect())) == old
    day = tmp_path / "dw" / "fact_operations" / f"pipeline_run_date={RUN_TS.date()}"
    assert len(list(day.iterdir())) == 2  # the old rows and the ones that were never published

    assert load.load_operations(spark, path, root, LATER, **run).first()[0] == 4
    rows = catalog.run_rows(spark, name, RUN_TS.date())
    assert {float(r.cost_per_unit) for r in rows.collect()} == {9.0, 9.5}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan
    # Another date is a partition of its own; a date without rows is empty.
    other = dict(run, run_date=NEXT_DAY.date())
    load.load_operations(spark, path, root, NEXT_DAY, **other)
    assert spark.table(name).count() == 8
    catalog.replace_run_at_once(rows.limit(0), name, f"{root}/fact_operations", FACT_OPERATIONS, RUN_TS.date())
    assert spark.table(name).count() == 4
    spark.sql(f"DROP TABLE {name}")
