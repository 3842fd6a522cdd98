"""The daily run: read both feeds, check and enrich them, keep both halves, log every step."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators import quality
from tidewater.operators.audit import LogEntry, append_log, log_frame, run_log, run_summary
from tidewater.operators.enrich import EnrichConfig, enrich_finance, enrich_warehouse
from tidewater.operators.rules import rules_for
from tidewater.schemas import FINANCE_FEED, WAREHOUSE_FEED, Table
from tidewater.sources.api import read_api
from tidewater.sources.readers import lossy_values, read_csv, read_json, typed
from tidewater.sources.tables import checked_dir, export_csv, read_checked, write_checked


@dataclass(frozen=True)
class DailyPaths:
    """Where a run reads its feeds and leaves its tables."""

    warehouse_csv: str
    finance_json: str
    staging: str
    warehouse: str
    run_logs: str | None = None
    finance_is_array: bool = False
    # Saved responses of the operations API, if the day has any.
    api_json: str | None = None
    api_is_files: bool = False

    @property
    def audit(self) -> str:
        return f"{self.warehouse}/pipeline_audit_log"


def accepted_warehouse(
    checked: DataFrame, run_ts: datetime | None = None, config: EnrichConfig = EnrichConfig()
) -> DataFrame:
    """Accepted warehouse rows, typed and enriched."""
    return enrich_warehouse(typed(quality.passed(checked), WAREHOUSE_FEED), config, run_ts)


def accepted_api(
    checked: DataFrame, run_ts: datetime | None = None, config: EnrichConfig = EnrichConfig()
) -> DataFrame:
    """Accepted records of the operations API; they have the warehouse rows' columns."""
    return enrich_warehouse(typed(quality.passed(checked), WAREHOUSE_FEED), config, run_ts, "api")


def accepted_finance(checked: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Accepted finance rows, typed and enriched."""
    return enrich_finance(typed(quality.passed(checked), FINANCE_FEED), run_ts)


def run_daily(
    spark: SparkSession,
    paths: DailyPaths,
    run_ts: datetime,
    run_date: date | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Run the day's steps in order; the first failure stops the run and is raised.

    Returns the run's summary and the checked rows per source, read back from the staging area.
    Every step that ran is logged, the failed one too. Each feed is read once: reading and
    checking are one pass that writes both halves, so a transform step only opens its feed and
    its time is small.
    """
    run_date = run_date or run_ts.date()
    entries: list[LogEntry] = []

    def step(name: str, source: str, work: Callable[[], tuple[dict, DataFrame]]) -> DataFrame:
        start = time.monotonic()
        try:
            counts, result = work()
        except Exception as e:
            spent = time.monotonic() - start
            entries.append(
                LogEntry(
                    run_date, run_ts, name, "FAILED", 0, 0, 0, spent, str(e), source_system=source
                )
            )
            raise
        entries.append(
            LogEntry(
                run_date,
                run_ts,
                name,
                "SUCCESS",
                counts.get("records_in", 0),
                counts.get("records_out", 0),
                counts.get("records_rejected", 0),
                time.monotonic() - start,
                lossy(counts),
                source_system=source,
            )
        )
        return result

    def check_and_write(raw: DataFrame, source: str, feed: Table) -> tuple[dict, DataFrame]:
        checked = quality.check(raw, rules_for(source), feed=feed)
        target = checked_dir(paths.staging, source, run_date)
        counts = write_checked(checked, target, lossy_values(checked, feed))
        return counts, read_checked(spark, target, checked.schema)

    def lossy(counts: dict) -> str | None:
        """What the log says of accepted values that their column's type cannot hold."""
        found = {k.removeprefix("lossy:"): n for k, n in counts.items() if k.startswith("lossy:") and n}
        told = ", ".join(f"{name} {n}" for name, n in found.items())
        return f"Accepted values that do not fit their type: {told}" if told else None

    try:
        warehouse = step(
            "Transform: Warehouse CSV",
            "warehouse_csv",
            lambda: ({}, read_csv(spark, paths.warehouse_csv)),
        )
        finance = step(
            "Transform: Finance JSON",
            "finance_json",
            lambda: (
                {},
                read_json(spark, paths.finance_json, FINANCE_FEED, paths.finance_is_array),
            ),
        )
        api = paths.api_json and step(
            "Transform: API JSON",
            "api",
            lambda: ({}, read_api(spark, paths.api_json, paths.api_is_files)),
        )
        checked = {
            "warehouse": step(
                "Quality Check: Warehouse",
                "warehouse_csv",
                lambda: check_and_write(warehouse, "warehouse", WAREHOUSE_FEED),
            ),
            "finance": step(
                "Quality Check: Finance",
                "finance_json",
                lambda: check_and_write(finance, "finance", FINANCE_FEED),
            ),
        }
        if api:
            checked["api"] = step(
                "Quality Check: API", "api", lambda: check_and_write(api, "api", WAREHOUSE_FEED)
            )
    finally:
        append_log(spark, entries, paths.audit)
        log = log_frame(spark, entries)
        if paths.run_logs:
            export_csv(run_log(log), f"{paths.run_logs}/pipeline_run_log_{run_date:%Y%m%d}.csv")
    return run_summary(log), checked
