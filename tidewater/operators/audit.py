"""Run log rows and the reports over the audit table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewater.functions.numbers import ratio_pct
from tidewater.operators.upsert import new_keys
from tidewater.schemas import AUDIT_LOG, ddl
from tidewater.sources.tables import append_rows, open_table

# Lines of the trend report.
REJECTION_ALERT_PCT = 2.0
DURATION_TARGET_MIN = 12.0


@dataclass(frozen=True)
class LogEntry:
    """Outcome of one step of a run; counts that a step does not have stay None."""

    run_date: date
    run_timestamp: datetime
    step: str
    status: str
    records_in: int | None = None
    records_out: int | None = None
    records_rejected: int | None = None
    duration_sec: float | None = None
    error: str | None = None
    source_system: str | None = None

    def rejection_rate(self) -> float | None:
        if self.records_in is None or self.records_rejected is None:
            return None
        return 100.0 * self.records_rejected / self.records_in if self.records_in else 0.0


def log_frame(spark: SparkSession, entries: Sequence[LogEntry]) -> DataFrame:
    """The run's log entries in the audit table's shape, not numbered yet.

    Error texts stay whole; the length audit reports those beyond the declared limit.
    """
    rows = [
        (
            None,
            e.run_date,
            e.run_timestamp,
            e.step,
            e.source_system,
            e.status,
            e.records_in,
            e.records_out,
            e.records_rejected,
            e.rejection_rate(),
            e.duration_sec,
            e.error,
            e.run_timestamp,
        )
        for e in entries
    ]
    loose = ddl({**AUDIT_LOG, "rejection_rate_pct": "double", "duration_sec": "double"})
    # A handful of rows that the driver itself made, so one task has them all.
    made = spark.createDataFrame(rows, loose).coalesce(1)
    return made.withColumn("duration_sec", F.round("duration_sec", 2))


def run_log(log: DataFrame) -> DataFrame:
    """Log entries in the shape of the dated run log file."""
    return log.selectExpr(
        "run_date",
        "run_timestamp",
        "pipeline_step AS step",
        "status",
        "records_in",
        "records_out",
        "records_rejected",
        "duration_sec",
        "error_message AS error",
    )


# The audit table is kept by run date, so that an append asks its own date only.
LOG_PARTITION = ("run_date",)


def logged_on(spark: SparkSession, path: str, days: Sequence[date]) -> DataFrame:
    """The log entries of some run dates; other dates' files are not read."""
    return open_table(spark, path, AUDIT_LOG, LOG_PARTITION).filter(F.col("run_date").isin(*days))


def append_log(spark: SparkSession, entries: Sequence[LogEntry], path: str) -> None:
    """Append log entries to the audit table, numbered on from their run date's highest id.

    Ids lead with the run day, so dates never meet and the table's other dates are not read.
    """
    if not entries:
        return
    days = sorted({e.run_date for e in entries})
    held = logged_on(spark, path, days).groupBy("run_date").agg(F.max("log_id").alias("held"))
    # A handful of rows that the driver itself made, numbered date by date.
    order = W.partitionBy("run_date").orderBy("run_timestamp", "pipeline_step")
    ids = new_keys(F.col("run_date"), F.col("held"), F.row_number().over(order) - 1)
    numbered = log_frame(spark, entries).join(held, "run_date", "left").withColumn("log_id", ids)
    append_rows(numbered, path, AUDIT_LOG, LOG_PARTITION)


def step_log(ingested: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Log of a run from the statistics of its sources: one row per step.

    ``ingested`` maps a source's title to its kind and its one-row ``quality.stats``. Each
    source has an ingest step with its counts and a quality step that passes on what was
    accepted; the load step takes in what all sources passed on.
    """
    parts = []
    for title, (kind, stats) in ingested.items():
        kept = F.col("records_out")
        none = F.lit(0).cast("bigint")
        steps = F.array(
            *[
                F.struct(
                    F.lit(step).alias("step"),
                    came.alias("records_in"),
                    kept.alias("records_out"),
                    lost.alias("records_rejected"),
                )
                for step, came, lost in (
                    (f"Ingest: {title} {kind}", F.col("records_in"), F.col("records_rejected")),
                    (f"Quality: {title}", kept, none),
                    ("Load: Star Schema", kept, none),
                )
            ]
        )
        parts.append(stats.select(F.explode(steps).alias("s")).select("s.*"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    counts = ("records_in", "records_out", "records_rejected")
    totals = rows.groupBy("step").agg(*[F.sum(c).alias(c) for c in counts])
    return totals.select(
        "step",
        F.lit("SUCCESS").alias("status"),
        *counts,
        ratio_pct(F.col("records_rejected"), F.col("records_in")).alias("rejection_rate"),
    )


def run_summary(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Steps, failures, record totals, time and rejection share, over all rows or per group.

    A record counts once per step that it passes, so totals over several steps count it often.
    """
    taken = F.coalesce(F.sum("records_in"), F.lit(0))
    lost = F.coalesce(F.sum("records_rejected"), F.lit(0))
    return audit.groupBy(*by).agg(
        F.count(F.lit(1)).alias("steps"),
        F.count_if(F.col("status") == "FAILED").alias("failures"),
        taken.alias("records_in"),
        F.coalesce(F.sum("records_out"), F.lit(0)).alias("records_out"),
        lost.alias("records_rejected"),
        F.coalesce(F.sum("duration_sec"), F.lit(0)).cast("double").alias("duration_sec"),
        (lost / F.greatest(taken, F.lit(1)) * 100).alias("rejected_pct"),
    )


def daily_trend(audit: DataFrame) -> DataFrame:
    """Records in and out, rejection rate and minutes per run date."""
    return audit.groupBy("run_date").agg(
        F.coalesce(F.sum("records_in"), F.lit(0)).alias("records_in"),
        ratio_pct(F.sum("records_rejected"), F.sum("records_in")).alias("rejection_rate"),
        (F.coalesce(F.sum("duration_sec"), F.lit(0)).cast("double") / 60).alias("pipeline_min"),
        F.coalesce(F.sum("records_out"), F.lit(0)).cast("bigint").alias("records_out"),
    )


def trend_summary(trend: DataFrame) -> DataFrame:
    """Mean rejection rate, mean minutes and the share of days under the time target."""
    in_time = F.when(F.col("pipeline_min") < DURATION_TARGET_MIN, 1.0).otherwise(0.0)
    return trend.agg(
        F.avg("rejection_rate").alias("avg_rejection_rate"),
        F.avg("pipeline_min").alias("avg_pipeline_min"),
        (F.avg(in_time) * 100).alias("pct_under_target"),
    )


def trend_alerts(trend: DataFrame) -> DataFrame:
    """The trend with its alert lines as flags."""
    return trend.withColumns(
        {
            "rejection_alert": F.col("rejection_rate") > REJECTION_ALERT_PCT,
            "duration_alert": F.col("pipeline_min") >= DURATION_TARGET_MIN,
        }
    )
