import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import audit, constraints, measures

AUDIT = (
    "run_date date, run_timestamp timestamp_ntz, pipeline_step string, source_system string,"
    " status string, records_in int, records_out int, records_rejected int, duration_sec double"
)


def day(n):
    return dt.date(2024, 4, 1) + dt.timedelta(n - 1)


@pytest.fixture(scope="module")
def log(spark):
    def at(hour):
        return dt.datetime(2024, 4, 1, hour, 59)

    return spark.createDataFrame(
        [
            (day(1), at(2), "check", "a", "SUCCESS", 100, 90, 10, 60.0),
            (day(1), at(6), "load", "a", "SUCCESS", None, 90, None, None),
            (day(30), at(5), "check", "b", "FAILED", 100, 0, 0, 720.0),
            (day(31), at(7), "check", "a", "SUCCESS", 200, 198, 2, 900.0),
        ],
        AUDIT,
    ).cache()


def test_measures(log):
    row = measures.evaluate(log, *measures.AUDIT_MEASURES).first()
    assert row.records_ingested == 378
    assert row.success_rate_pct == 75.0
    assert row.rejection_rate_pct == 3.0
    assert row.completeness_pct == 97.0
    assert row.avg_duration_min == pytest.approx(1680 / 3 / 60)
    assert row.on_time_pct == 50.0
    by = measures.evaluate(log, "rejection_rate_pct", by=["source_system"], where="records_in > 0")
    assert {r.source_system: r.rejection_rate_pct for r in by.collect()} == {"a": 4.0, "b": 0.0}
    assert measures.records_ingested_on(log, day(1)).first().records_ingested == 180
    card = measures.quality_scorecard(log).filter("source_system = 'b'").first()
    assert (card.completeness_pct, card.on_time_pct) == (100.0, 100.0)


def test_measures_over_nothing(log):
    row = measures.evaluate(log, *measures.AUDIT_MEASURES, where=F.lit(False)).first()
    assert row.records_ingested is None and row.avg_duration_min is None
    assert (row.success_rate_pct, row.rejection_rate_pct, row.completeness_pct) == (0.0, 0.0, 100.0)


def test_rolling_rate_counts_days(log):
    rates = {r.run_date: r.rejection_rate_30d for r in measures.rejection_rate_30d(log).collect()}
    assert rates == {day(1): 10.0, day(30): 5.0, day(31): pytest.approx(2 / 300 * 100)}
    per_source = measures.rejection_rate_30d(log, by=["source_system"])
    assert per_source.filter("source_system = 'a'").orderBy("run_date").collect()[1][-1] == 1.0


def test_operations_measures(spark):
    rows = spark.createDataFrame(
        [("N", 100.0, True, 2.5, 10), ("N", 120.0, None, 1.0, 3), ("S", None, False, 1.0, None)],
        "region_name string, throughput_uph double, sla_met boolean, cost_per_unit double, units_processed int",
    )
    report = {r.region_name: r for r in measures.regional_performance(rows).collect()}
    assert (report["N"].avg_throughput_uph, report["N"].sla_pct) == (110.0, 50.0)
    assert float(report["N"].total_cost) == 28.0
    assert report["S"].total_cost is None and report["S"].avg_throughput_uph is None
    grants = spark.createDataFrame([("ann", "N"), ("ann", "N"), ("bob", "S")], "reader string, region string")
    seen = measures.visible_to(rows, grants, "ann", "region_name")
    assert [r.region_name for r in seen.collect()] == ["N", "N"]


def test_summary_and_trend(log):
    row = audit.run_summary(log).first()
    assert (row.steps, row.failures, row.records_in, row.records_rejected) == (4, 1, 400, 12)
    assert (row.duration_sec, row.rejected_pct) == (1680.0, 3.0)
    empty = audit.run_summary(log.filter("false")).first()
    assert (empty.steps, empty.records_in, empty.rejected_pct) == (0, 0, 0.0)
    trend = audit.trend_alerts(audit.daily_trend(log)).orderBy("run_date").collect()
    assert [r.records_out for r in trend] == [180, 0, 198]
    assert [r.rejection_alert for r in trend] == [True, False, False]
    assert [r.duration_alert for r in trend] == [False, True, True]
    total = audit.trend_summary(audit.daily_trend(log)).first()
    assert total.avg_rejection_rate == pytest.approx(11 / 3)
    assert total.pct_under_target == pytest.approx(100 / 3)


def test_constraints(spark):
    rows = spark.createDataFrame(
        [(1, "abc", 5), (1, None, None), (None, "abcdef", 9), (None, "x", 5)], "k int, t string, f int"
    )
    assert {r.k: r.copies for r in constraints.duplicate_keys(rows, ["k"]).collect()} == {1: 2, None: 2}
    nulls = constraints.null_counts(rows, ["k", "t"]).collect()
    assert {r.column_name: r.null_records for r in nulls} == {"k": 2, "t": 1}
    long = constraints.too_long(rows, {"t": 3, "absent": 1}).collect()
    assert [(r.column_name, r.too_long_records) for r in long] == [("t", 1)]
    dim = spark.createDataFrame([(5,), (6,)], "id int")
    lost = constraints.orphans(rows, {"f": (dim, "id"), "k": (spark.range(2), "id")}).collect()
    assert [tuple(r) for r in lost] == [("f", 9, 1)]
