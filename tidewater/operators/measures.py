"""Report measures, evaluated under any filter and grouping."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewater.functions.numbers import ratio_pct

ON_TIME_BEFORE_HOUR = 6
ROLLING_DAYS = 30


def _share(condition: Column) -> Column:
    return ratio_pct(F.count_if(condition), F.count(F.lit(1)))


def _rejection_rate() -> Column:
    return ratio_pct(F.sum("records_rejected"), F.sum("records_in"))


def _total_cost() -> Column:
    return F.sum(F.col("cost_per_unit").cast("decimal(8,2)") * F.col("units_processed"))


# Aggregates by measure name. The first group reads the audit table, the second operations rows.
AUDIT_MEASURES: dict[str, Callable[[], Column]] = {
    "records_ingested": lambda: F.sum("records_out"),
    "success_rate_pct": lambda: _share(F.col("status") == "SUCCESS"),
    "rejection_rate_pct": _rejection_rate,
    "avg_duration_min": lambda: F.avg("duration_sec") / 60,
    "completeness_pct": lambda: 100 - _rejection_rate(),
    "on_time_pct": lambda: _share(F.hour("run_timestamp") < ON_TIME_BEFORE_HOUR),
}
OPERATIONS_MEASURES: dict[str, Callable[[], Column]] = {
    "avg_throughput_uph": lambda: F.avg("throughput_uph"),
    "sla_pct": lambda: _share(F.coalesce(F.col("sla_met"), F.lit(False))),
    "total_cost": _total_cost,
}
MEASURES = {**AUDIT_MEASURES, **OPERATIONS_MEASURES}


def evaluate(
    df: DataFrame,
    *measures: str,
    by: Sequence[str] = (),
    where: Column | str | None = None,
) -> DataFrame:
    """The named measures in one pass, over all rows that satisfy ``where`` or per group.

    Rates over no rows are 0; sums and means over no rows are null.
    """
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*by).agg(*[MEASURES[name]().alias(name) for name in measures])


def records_ingested_on(audit: DataFrame, as_of: date, by: Sequence[str] = ()) -> DataFrame:
    """Records written by the steps of one run date."""
    return evaluate(audit, "records_ingested", by=by, where=F.col("run_date") == F.lit(as_of))


def rejection_rate_30d(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rejection rate over the 30 days that end at each run date, by days and not by rows.

    The window runs over daily sums, one row per date and group, however large the table is.
    """
    daily = audit.groupBy(*by, "run_date").agg(
        F.sum("records_in").alias("_in"), F.sum("records_rejected").alias("_rejected")
    )
    span = W.partitionBy(*by).orderBy(F.unix_date("run_date")).rangeBetween(1 - ROLLING_DAYS, 0)
    rate = ratio_pct(F.sum("_rejected").over(span), F.sum("_in").over(span))
    return daily.select(*by, "run_date", rate.alias("rejection_rate_30d"))


def lineage(facts: DataFrame) -> DataFrame:
    """Rows per source and run date."""
    return facts.groupBy("record_source", "pipeline_run_date").agg(
        F.count(F.lit(1)).alias("records")
    )


def regional_performance(operations: DataFrame, by: Sequence[str] = ("region_name",)) -> DataFrame:
    """Throughput, service level and cost per region."""
    return evaluate(operations, *OPERATIONS_MEASURES, by=by)


def quality_scorecard(audit: DataFrame, by: Sequence[str] = ("source_system",)) -> DataFrame:
    """Rejection, completeness and timeliness per source."""
    return evaluate(audit, "rejection_rate_pct", "completeness_pct", "on_time_pct", by=by)


def visible_to(rows: DataFrame, grants: DataFrame, reader: str, region: str = "region") -> DataFrame:
    """Rows of the regions that ``grants`` (reader, region) opens to one reader."""
    allowed = grants.filter(F.col("reader") == reader).select(F.col("region").alias(region))
    return rows.join(allowed, region, "left_semi")
