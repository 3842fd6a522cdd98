"""Derived columns of accepted rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.calendar import month_label, month_start, quarter_label
from tidewater.functions.numbers import money, number


@dataclass(frozen=True)
class EnrichConfig:
    """Thresholds of the warehouse flags."""

    # Service level, defect limit, throughput benchmark and dock delay classes
    # (upper bound inclusive, label).
    sla_hours: float = 24
    high_defect_pct: float = 3.5
    benchmark_uph: float = 120
    dock_classes: tuple[tuple[float, str], ...] = (
        (1, "<1hr"),
        (2, "1-2hrs"),
        (4, "2-4hrs"),
        (100, ">4hrs"),
    )
    # True: decimal money. False: binary product rounded to cents, ties to even.
    exact_money: bool = True
    # False: unreadable dates become null instead of raising.
    strict_dates: bool = True


def _holds(condition: Column) -> Column:
    """A comparison with a missing value does not hold."""
    return F.coalesce(condition, F.lit(False))


def dock_category(delay: Column, classes: tuple[tuple[float, str], ...]) -> Column:
    """Class of a delay; null at or below zero and above the last bound."""
    branch = F.when(delay <= 0, F.lit(None))
    for upper, label in classes:
        branch = branch.when(delay <= upper, label)
    return branch


def _stamped(df: DataFrame, source: str, run_ts: datetime | None) -> DataFrame:
    df = df.withColumn("record_source", F.lit(source))
    if run_ts is None:
        return df
    return df.withColumn("load_ts", F.lit(run_ts.isoformat()).cast("timestamp_ntz"))


def enrich_warehouse(
    df: DataFrame,
    config: EnrichConfig = EnrichConfig(),
    run_ts: datetime | None = None,
    source: str = "warehouse_csv",
) -> DataFrame:
    """Calendar labels, flags, dock class, total cost and lineage of warehouse rows.

    ``run_ts`` is the run's timestamp, given by the caller so that a rerun agrees; without it
    the rows carry no ``load_ts``.
    """
    to_date = F.to_date if config.strict_dates else F.try_to_date
    df = df.withColumn("order_date", to_date("order_date"))
    day = F.col("order_date")
    price, units = number(df, "cost_per_unit"), number(df, "units_processed")
    if config.exact_money:
        cost = money(price, units)
    else:
        cost = F.rint(price * units * 100) / 100
    enriched = df.withColumns(
        {
            "year": F.year(day),
            "month": month_label(day),
            "quarter": quarter_label(day),
            "sla_met": _holds(number(df, "sla_hours") <= config.sla_hours),
            "total_cost": cost,
            "dock_category": dock_category(number(df, "dock_delay_hrs"), config.dock_classes),
            "high_defect": _holds(number(df, "defect_rate_pct") > config.high_defect_pct),
            "below_benchmark": _holds(number(df, "throughput_uph") < config.benchmark_uph),
        }
    )
    return _stamped(enriched, source, run_ts)


def enrich_finance(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """First day of the month, its year and quarter, and lineage of finance rows."""
    month = month_start(F.col("month"))
    enriched = df.withColumns(
        {"month_dt": month, "year": F.year(month), "quarter": quarter_label(month)}
    )
    return _stamped(enriched, "finance_json", run_ts)


def preview(df: DataFrame, columns: list[str] | None = None, n: int = 4) -> DataFrame:
    """A few rows of some columns, for a look at the data."""
    return df.select(*(columns or ["*"])).limit(n)
