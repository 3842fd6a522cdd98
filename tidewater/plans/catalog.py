"""The registered queries: each takes a session and the directory of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewater.functions.text import markers_to_null
from tidewater.operators import audit, constraints, dimensions, finance, measures, quality, upsert
from tidewater.operators.enrich import enrich_warehouse
from tidewater.operators.rules import RULES, RuleSet
from tidewater.operators.upsert import MERGE_KEY
from tidewater.plans import derived as d
from tidewater.plans import roundtrips
from tidewater.schemas import (
    PRIMARY_KEYS,
    REFERENCES,
    STAGING_OPERATIONS,
    WAREHOUSE_FEED,
    conform,
    text_limits,
)
from tidewater.sources.checkpoint import settled
from tidewater.sources.readers import lossy_values, typed

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 6, 30)
READER = "NATION_3"


def _plain(df: DataFrame, places: int | None = None) -> DataFrame:
    """Decimals as doubles, and doubles rounded where asked for, so results compare by value."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DoubleType) and places is not None:
            c = F.round(c, places)
        out.append(c.alias(f.name))
    return df.select(*out)


def _rejected_by(rules: RuleSet) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.rejected(quality.check(d.warehouse_feed(spark, sf_dir), rules))

    return query


def _measure(name: str, by: tuple[str, ...] = ()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = (d.audit_log if name in measures.AUDIT_MEASURES else _operations)(spark, sf_dir)
        return _plain(measures.evaluate(rows, name, by=by), 6)

    return query


def _operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows as the measures read them."""
    rows = d.staging(spark, sf_dir)
    return rows.withColumn("throughput_uph", F.col("throughput_uph").cast("double"))


def qc_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = {"warehouse": d.checked_warehouse, "finance": d.checked_finance}
    rows = [
        quality.stats(checked(spark, sf_dir)).select(F.lit(name).alias("source"), "*")
        for name, checked in both.items()
    ]
    return _plain(rows[0].unionByName(rows[1]), 6)


def qc_text_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole checked text feed, both halves, as the daily run writes it."""
    feed = markers_to_null(d.warehouse_text_feed(spark, sf_dir))
    return quality.check(feed, RULES["warehouse"], require=False)


def _checked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checked text feed with its numbers, kept as the daily run keeps it before it splits it."""
    feed = markers_to_null(d.warehouse_text_feed(spark, sf_dir))
    return settled(quality.check(feed, RULES["warehouse"], feed=WAREHOUSE_FEED))


def text_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text dates and numbers through check, cast and enrichment."""
    accepted = quality.passed(_checked_text(spark, sf_dir))
    return _plain(enrich_warehouse(typed(accepted, WAREHOUSE_FEED)))


def text_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted values per column that hold more than their type keeps."""
    accepted = quality.passed(_checked_text(spark, sf_dir))
    flags = lossy_values(accepted, WAREHOUSE_FEED)
    counts = accepted.agg(*[F.count_if(flag).alias(c) for c, flag in flags.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("records")) for c in flags])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def audit_varchar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.too_long(d.accepted_warehouse(spark, sf_dir), text_limits(STAGING_OPERATIONS))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(d.accepted_warehouse(spark, sf_dir))


def dock_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.accepted_warehouse(spark, sf_dir)
    return rows.groupBy("dock_category").agg(F.count(F.lit(1)).alias("records"))


def stage_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(d.staging(spark, sf_dir))


def dim_date_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.sales_calendar(spark, sf_dir).agg(F.count(F.lit(1)).alias("dates_populated"))


def dim_date_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with a fulfilled order exist already, marked by a missing weekday flag."""
    calendar = d.sales_calendar(spark, sf_dir)
    orders = d.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    days = orders.select(F.col("o_orderdate").cast("date").alias("full_date")).distinct()
    existing = calendar.join(days, "full_date", "left_semi").withColumn(
        "is_weekday", F.lit(None).cast("boolean")
    )
    return dimensions.add_absent(existing, calendar, "date_key")


def dim_region_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = d.warehouse_feed(spark, sf_dir).select(F.col("region").alias("region_name"))
    existing = d.dim_region(spark, sf_dir)
    return dimensions.seed_members(existing, names, "region_name", "region_key")


def load_ops_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(d.resolved_operations(spark, sf_dir))


def unmatched_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.unmatched_names(d.staging(spark, sf_dir), d.dimension_tables(spark, sf_dir))


def load_ops_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All staged rows, none of which the dimensions lack."""
    return _plain(d.all_operations(spark, sf_dir))


def _load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The target and its rows after the load of every staged row."""
    rows = settled(d.all_operations(spark, sf_dir).drop("order_id"))
    target = d.operations_target(rows)
    return target, upsert.merge(target, d.operations_source(rows))


def upsert_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_load(spark, sf_dir)[1].drop("insert_no"))


def upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(upsert.action_counts(_load(spark, sf_dir)[1]))


def load_ops_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.records_loaded(_load(spark, sf_dir)[1])


def load_fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts per run date and action, their distinct keys, and those beyond the keys held before."""
    target, merged = _load(spark, sf_dir)
    place = F.row_number().over(W.partitionBy("pipeline_run_date").orderBy("date_key", "region_key", "shift_key"))
    held = target.select(
        *[c for c in MERGE_KEY], (F.lit(1000) + place).cast("bigint").alias("old_key")
    )
    run = held.filter(F.col("pipeline_run_date") == F.lit(d.RUN_DATE)).select(
        F.expr(f"{(d.RUN_DATE - upsert.KEY_EPOCH).days << upsert.DAY_SHIFT}L + old_key").alias("fact_key")
    )
    highest = run.agg(F.max("fact_key")).first()[0]
    numbered = upsert.with_fact_keys(
        merged.join(held, list(MERGE_KEY), "left").withColumnRenamed("old_key", "fact_key"),
        run,
        d.RUN_DATE,
    )
    return numbered.groupBy("pipeline_run_date", "action").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("fact_key").alias("distinct_keys"),
        F.count_if(F.col("fact_key") > highest).alias("new_keys"),
    )


def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staged order against a table that holds a third of the keys."""
    keys = settled(d.all_operations(spark, sf_dir).select(*MERGE_KEY))
    return upsert.repeated_keys(d.operations_target(keys), keys)


def audit_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = d.star_tables(spark, sf_dir)
    references = REFERENCES["fact_operations"]
    return constraints.orphans(
        tables["fact_operations"], {c: (tables[dim], PRIMARY_KEYS[dim]) for c, dim in references.items()}
    )


def audit_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.star_schema_faults(d.star_tables(spark, sf_dir))


def _finance(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """Cells, dimensions and the mapping of units; units are region names here, one not held."""
    dims = d.dimension_tables(spark, sf_dir)
    cells = settled(finance.finance_cells(d.accepted_finance(spark, sf_dir)))
    none = conform(spark.range(0), {"cost_center_key": "int", "cost_center_name": "string"})
    names = cells.select(F.col("cost_center").alias("cost_center_name"))
    dims["dim_cost_center"] = dimensions.seed_members(none, names, "cost_center_name", "cost_center_key")
    units = d.table(spark, sf_dir, "region").select(
        F.col("r_name").alias("business_unit"), F.col("r_name").alias("region")
    )
    return cells, dims, units


def finance_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, dims, units = _finance(spark, sf_dir)
    return _plain(finance.finance_unmatched(cells, dims["dim_region"], dims["dim_cost_center"], units))


def finance_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, dims, units = _finance(spark, sf_dir)
    return _plain(
        finance.finance_fact(
            cells, dims["dim_region"], dims["dim_cost_center"], dims["dim_source"], units
        )
    )


def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {
        "Warehouse": ("CSV", quality.stats(d.checked_warehouse(spark, sf_dir))),
        "Finance": ("JSON", quality.stats(d.checked_finance(spark, sf_dir))),
    }
    return _plain(audit.step_log(sources), 6)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(audit.run_summary(d.audit_log(spark, sf_dir)), 4)


def run_summary_by_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(audit.run_summary(d.audit_log(spark, sf_dir), by=["pipeline_step"]), 4)


def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(audit.daily_trend(d.audit_log(spark, sf_dir)), 6)


def trend_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(audit.trend_summary(audit.daily_trend(d.audit_log(spark, sf_dir))), 6)


def trend_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(audit.trend_alerts(audit.daily_trend(d.audit_log(spark, sf_dir))), 6)


def records_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.records_ingested_on(d.audit_log(spark, sf_dir), AS_OF)


def regional_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _operations(spark, sf_dir).withColumnRenamed("region", "region_name")
    return _plain(measures.regional_performance(rows), 6)


def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operations report as one reader sees it."""
    grants = d.reader_grants(spark, sf_dir)
    rows = measures.visible_to(_operations(spark, sf_dir), grants, READER)
    return _plain(measures.regional_performance(rows, by=["region", "shift"]), 6)


QUERIES: dict[str, Query] = {
    # Quality checks
    "qc_non_null": _rejected_by(RuleSet(non_null=RULES["warehouse"].non_null)),
    "qc_positive": _rejected_by(RuleSet(positive=RULES["warehouse"].positive)),
    "qc_range": _rejected_by(RuleSet(ranges=RULES["warehouse"].ranges)),
    "qc_reasons": lambda s, p: quality.reason_counts(d.checked_warehouse(s, p)),
    "qc_passed": lambda s, p: quality.passed(d.checked_warehouse(s, p)),
    "qc_rejected": lambda s, p: quality.rejected(d.checked_warehouse(s, p)),
    "qc_stats": qc_stats,
    "qc_top_reasons": lambda s, p: quality.top_reasons(d.checked_warehouse(s, p)),
    "qc_finance_passed": lambda s, p: quality.passed(d.checked_finance(s, p)),
    "qc_finance_rejected": lambda s, p: quality.rejected(d.checked_finance(s, p)),
    "qc_text_feed": qc_text_feed,
    "audit_varchar": audit_varchar,
    # Enrichment and staging
    "enrich_warehouse": enriched,
    "text_chain": text_chain,
    "text_lossy": text_lossy,
    "enrich_finance": lambda s, p: d.accepted_finance(s, p),
    "dock_category_counts": dock_category_counts,
    "stage_ops": stage_ops,
    # Dimensions
    "dim_date": lambda s, p: d.sales_calendar(s, p),
    "dim_date_count": dim_date_count,
    "dim_date_incremental": dim_date_incremental,
    "dim_region_seed": dim_region_seed,
    # Load
    "load_ops_source": load_ops_source,
    "load_ops_all": load_ops_all,
    "unmatched_dims": unmatched_dims,
    "upsert_ops": upsert_ops,
    "upsert_actions": upsert_actions,
    "load_ops_count": load_ops_count,
    "load_fact_keys": load_fact_keys,
    "merge_conflicts": merge_conflicts,
    "finance_fact": finance_fact,
    "finance_unmatched": finance_unmatched,
    # Constraint audits
    "audit_pk": lambda s, p: constraints.duplicate_keys(d.warehouse_feed(s, p), ["order_id"]),
    "audit_fk": audit_fk,
    "audit_star": audit_star,
    "audit_not_null": lambda s, p: constraints.null_counts(
        d.warehouse_feed(s, p), d.warehouse_feed(s, p).columns
    ),
    # Run log
    "step_log": step_log,
    "run_summary": run_summary,
    "run_summary_by_step": run_summary_by_step,
    "daily_trend": daily_trend,
    "trend_summary": trend_summary,
    "trend_alerts": trend_alerts,
    # Measures
    "records_ingested": records_ingested,
    "success_rate": _measure("success_rate_pct"),
    "rejection_rate": _measure("rejection_rate_pct"),
    "rejection_rate_by_source": _measure("rejection_rate_pct", by=("source_system",)),
    "avg_duration_min": _measure("avg_duration_min"),
    "avg_throughput": _measure("avg_throughput_uph"),
    "sla_pct": _measure("sla_pct"),
    "total_cost": _measure("total_cost"),
    "completeness": _measure("completeness_pct"),
    "on_time_pct": _measure("on_time_pct"),
    "rejection_rate_30d": lambda s, p: _plain(measures.rejection_rate_30d(d.audit_log(s, p)), 6),
    "rejection_rate_30d_by_source": lambda s, p: _plain(
        measures.rejection_rate_30d(d.audit_log(s, p), by=["source_system"]), 6
    ),
    "lineage": lambda s, p: measures.lineage(d.daily_facts(s, p)),
    "regional_performance": regional_performance,
    "quality_scorecard": lambda s, p: _plain(measures.quality_scorecard(d.audit_log(s, p)), 6),
    "region_filter": region_filter,
    # Through files and tables
    "csv_round_trip": roundtrips.csv_round_trip,
    "landing_days": roundtrips.landing_days,
    "staged_by_source": lambda s, p: _plain(roundtrips.staged_by_source(s, p)),
    "run_log_file": roundtrips.run_log_file,
    "audit_appends": roundtrips.audit_appends,
    "api_feed": roundtrips.api_feed,
    "api_missing_pages": roundtrips.api_missing_pages,
    "load_stamps": roundtrips.load_stamps,
    "day_fact": lambda s, p: _plain(roundtrips.day_fact(s, p)),
    "day_log": lambda s, p: _plain(roundtrips.day_log(s, p)),
}
