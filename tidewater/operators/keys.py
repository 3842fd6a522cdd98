"""Consecutive numbers for rows that many tasks hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewater.sources.checkpoint import settled


def kept_with_places(df: DataFrame, place: str) -> DataFrame:
    """``df``, kept, with every row's number from 0 in ``place``, in the order of its tasks.

    Each task numbers its own rows; the tasks' row counts, one small row each, give where a task
    starts. No row leaves its task to be numbered, and any number of tasks and rows will do. The
    rows are kept first, so that a task that runs again cannot number them anew.
    """
    kept = settled(
        df.withColumns({"_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    )
    sizes = kept.groupBy("_task").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("_task", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    # One small row per task; sent out, else Spark, which guesses it large, shuffles all kept rows.
    numbered = kept.join(F.broadcast(starts), "_task").withColumn(place, F.col("_row") + F.col("_shift"))
    return numbered.drop("_task", "_row", "_shift")
