"""Upsert of one run's rows into a fact table, and its surrogate keys."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewater.operators.keys import kept_with_places
from tidewater.sources.checkpoint import settled

# The key that a load matches rows by.
MERGE_KEY = ("date_key", "region_key", "shift_key", "pipeline_run_date")
# Measures that an update overwrites; keys and lineage of the old row stay.
UPDATED = (
    "throughput_uph",
    "dock_delay_hrs",
    "defect_rate_pct",
    "inventory_accuracy_pct",
    "sla_hours",
    "sla_met",
    "units_processed",
    "cost_per_unit",
    "total_cost",
)
REPEATED_KEY = "Upsert source repeats a key that the target holds"

# A fact key is the run day, counted from here, above a row number of 48 bits.
KEY_EPOCH = date(2000, 1, 1)
DAY_SHIFT = 48


def merge(target: DataFrame, source: DataFrame, key: tuple[str, ...] = MERGE_KEY) -> DataFrame:
    """All rows of ``target`` after the upsert, plus ``action`` and ``insert_no``.

    A source row whose key the target holds updates every target row of that key; all others
    are inserted, every copy of them, and numbered in ``insert_no`` (unique, with gaps). Null keys
    match nothing. A key that the target holds and the source repeats is an error, raised here.

    One path for any size. The target's keys are reduced to distinct ones, and the source, marked
    by them, is computed once and kept; its matching rows are reduced to one per key. So each join
    has a side without repeats that is kept before, and Spark broadcasts it if it is small or else
    splits a hot key of the other side. It could not do so in a full outer join, nor if the
    reduced side were still being aggregated in the join's own stage.
    """
    source = source.select(*[c for c in target.columns if c in source.columns])
    updated = [c for c in UPDATED if c in source.columns]
    held = settled(target.select(*key).dropna().distinct().withColumn("_held", F.lit(True)))
    marked = kept_with_places(source.join(held, list(key), "left"), "insert_no")
    fresh = marked.filter(F.col("_held").isNull()).drop("_held")
    inserts = fresh.withColumn("action", F.lit("insert"))

    message = F.concat(F.lit(REPEATED_KEY + ": "), F.to_json(F.struct(*key)))
    hits = (
        marked.filter(F.col("_held"))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_copies"), *[F.first(c).alias(f"_new_{c}") for c in updated])
        .filter(F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean")).otherwise(True))
    )
    hit = F.col("_copies").isNotNull()
    merged = target.join(settled(hits), list(key), "left").select(
        *[
            F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in target.columns
        ],
        F.when(hit, "update").otherwise("keep").alias("action"),
    )
    return merged.unionByName(inserts, allowMissingColumns=True)


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows and total cost per action."""
    return merged.groupBy("action").agg(
        F.count(F.lit(1)).alias("records"), F.sum("total_cost").alias("total_cost")
    )


def records_loaded(merged: DataFrame) -> DataFrame:
    """One row: inserted plus updated rows."""
    return merged.agg(F.count_if(F.col("action") != "keep").alias("records_loaded"))


def repeated_keys(
    target: DataFrame, source: DataFrame, key: tuple[str, ...] = MERGE_KEY
) -> DataFrame:
    """Keys, with their copies, that would make ``merge`` fail."""
    repeats = source.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return repeats.join(target.select(*key).dropna().distinct(), list(key), "left_semi")


def keep_one(rows: DataFrame, key: tuple[str, ...], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark keeps only the first row of each key per task before the shuffle, so a hot key sends
    one row per task and not its whole group.
    """
    first = W.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def new_keys(run_date: Column, held: Column, place: Column) -> Column:
    """Unique keys for the rows that one run date gains, ``place`` being unique among them.

    The run day leads, so keys of different days never meet and only the run's own partition has
    to be asked for the highest key ``held`` so far (null when there is none): no pass over the
    whole table. Numbers go on from it; gaps are normal.
    """
    start = F.coalesce(held.bitwiseAND(F.lit((1 << DAY_SHIFT) - 1)) + 1, F.lit(0).cast("bigint"))
    day = F.date_diff(run_date, F.lit(KEY_EPOCH)).cast("bigint")
    return F.shiftleft(day, DAY_SHIFT) + start + place


def new_fact_keys(run_date: date, held: Column, place: Column) -> Column:
    """``new_keys`` of one run date."""
    return new_keys(F.lit(run_date), held, place)


def with_fact_keys(merged: DataFrame, target: DataFrame, run_date: date) -> DataFrame:
    """Number the inserted rows of ``merge``; updated and kept rows keep their keys.

    ``target`` is the run's partition.
    """
    held = target.select(F.max("fact_key").alias("held")).scalar()
    fresh = new_fact_keys(run_date, held, F.col("insert_no"))
    return merged.withColumn(
        "fact_key", F.when(F.col("action") == "insert", fresh).otherwise(F.col("fact_key"))
    )


def stamped(merged: DataFrame, run_ts: datetime) -> DataFrame:
    """Set the load time of inserted and updated rows; kept rows keep theirs."""
    now = F.lit(run_ts.isoformat()).cast("timestamp_ntz")
    return merged.withColumn(
        "load_timestamp", F.when(F.col("action") == "keep", F.col("load_timestamp")).otherwise(now)
    )
