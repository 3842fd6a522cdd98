import datetime as dt

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.operators.enrich import (
    EnrichConfig,
    dock_category,
    enrich_finance,
    enrich_warehouse,
    preview,
)

SCHEMA = (
    "order_date string, throughput_uph double, dock_delay_hrs double, defect_rate_pct double,"
    " sla_hours double, units_processed int, cost_per_unit double"
)


GOOD = {
    "order_date": "2024-05-17",
    "throughput_uph": 119.9,
    "dock_delay_hrs": 1.5,
    "defect_rate_pct": 3.6,
    "sla_hours": 24.0,
    "units_processed": 100,
    "cost_per_unit": 4.55,
}


def enriched(spark, changes, config=EnrichConfig(), run_ts=None):
    """One enriched row per change to a good row, in order."""
    rows = [(i, *{**GOOD, **change}.values()) for i, change in enumerate(changes)]
    df = spark.createDataFrame(rows, "i int, " + SCHEMA)
    return enrich_warehouse(df, config, run_ts).orderBy("i").collect()


def test_labels(spark):
    run_ts = dt.datetime(2024, 7, 1, 2, 30, 5, 250000)
    row, missing = enriched(spark, [{}, {"order_date": None}], run_ts=run_ts)
    assert (row.order_date, row.year, row.month, row.quarter) == (
        dt.date(2024, 5, 17), 2024, "2024-05", "Q2",
    )
    assert row.record_source == "warehouse_csv"
    assert float(row.total_cost) == 455.0
    assert row.load_ts == run_ts
    assert (missing.year, missing.month, missing.quarter) == (None, None, None)


def test_flags(spark):
    cases = [
        ({"sla_hours": 24.0}, "sla_met", True),
        ({"sla_hours": 24.1}, "sla_met", False),
        ({"sla_hours": None}, "sla_met", False),
        ({"sla_hours": float("nan")}, "sla_met", False),
        ({"defect_rate_pct": 3.5}, "high_defect", False),
        ({"defect_rate_pct": 3.51}, "high_defect", True),
        ({"defect_rate_pct": float("nan")}, "high_defect", False),
        ({"throughput_uph": 120.0}, "below_benchmark", False),
        ({"throughput_uph": 119.99}, "below_benchmark", True),
        ({"throughput_uph": None}, "below_benchmark", False),
    ]
    rows = enriched(spark, [change for change, *_ in cases])
    for row, (change, flag, value) in zip(rows, cases, strict=True):
        assert row[flag] is value, change


def test_dock_classes_match_pandas(spark):
    delays = [0.0, 0.01, 1.0, 1.01, 2.0, 2.5, 4.0, 4.01, 100.0, 100.1, -1.0, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(delays)], "i int, x double")
    classes = EnrichConfig().dock_classes
    labelled = df.select("i", dock_category(F.col("x"), classes).alias("c")).orderBy("i")
    bins = [0] + [upper for upper, _ in classes]
    theirs = pd.cut(pd.Series(delays, dtype=float), bins=bins, labels=[name for _, name in classes])
    assert [r.c for r in labelled.collect()] == [None if v != v else v for v in theirs.tolist()]


def test_binary_money_matches_pandas(spark):
    pairs = [(4.55, 3), (1.015, 1), (2.675, 1), (0.125, 1), (0.375, 1), (3.335, 7)]
    expected = [(pd.Series([price]) * units).round(2).iloc[0] for price, units in pairs]
    changes = [{"cost_per_unit": price, "units_processed": units} for price, units in pairs]
    rows = enriched(spark, changes, EnrichConfig(exact_money=False))
    assert [r.total_cost for r in rows] == expected


def test_bad_dates(spark):
    bad = [{"order_date": "not a date"}]
    with pytest.raises(PySparkException):
        enriched(spark, bad)
    assert enriched(spark, bad, EnrichConfig(strict_dates=False))[0].order_date is None


def test_finance(spark):
    df = spark.createDataFrame([("FIN-1", "2024-11"), ("FIN-2", None)], "record_id string, month string")
    first, second = enrich_finance(df).collect()
    assert (first.month_dt, first.year, first.quarter) == (dt.date(2024, 11, 1), 2024, "Q4")
    assert first.record_source == "finance_json"
    assert second.month_dt is None
    with pytest.raises(PySparkException):
        enrich_finance(df.withColumn("month", F.lit("2024-13"))).collect()


def test_preview(spark):
    rows = preview(spark.range(10).withColumn("x", F.lit(1)), ["id"], 3)
    assert rows.columns == ["id"] and rows.count() == 3
