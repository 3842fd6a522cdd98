"""Writers and readers of the tables that the jobs keep as Parquet."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.schemas import RUN_LOG, Table, conform, ddl


def checked_dir(root: str, source: str, run_date: date) -> str:
    """Directory of one source's checked rows of one run."""
    return f"{root}/{source}/{run_date:%Y-%m-%d}"


def write_checked(
    checked: DataFrame, path: str, lossy: dict[str, Column] | None = None
) -> dict[str, int | float]:
    """Write accepted and rejected rows in one pass and return the counts of that pass.

    ``lossy`` has a flag per column for values that their type cannot hold; accepted rows with
    one are counted under ``lossy:<column>``.

    The rows go to ``rejected=false`` and ``rejected=true`` below ``path``; the second directory
    exists only when something was rejected. The whole directory is replaced, so a rerun leaves
    no rejects of an earlier run behind. The counts come from the writing tasks themselves: the
    check is a narrow stage, so a lost task is counted once, when its retry is committed.
    """
    seen = Observation()
    counted = checked.observe(
        seen,
        F.count(F.lit(1)).alias("records_in"),
        F.count_if(F.col("rejected")).alias("records_rejected"),
        *[F.count_if(~F.col("rejected") & flag).alias(f"lossy:{c}") for c, flag in (lossy or {}).items()],
    )
    counted.write.mode("overwrite").partitionBy("rejected").parquet(path)
    records_in, bad = seen.get["records_in"], seen.get["records_rejected"]
    return {
        "records_in": records_in,
        "records_out": records_in - bad,
        "records_rejected": bad,
        "rejection_rate": bad / records_in * 100 if records_in else 0.0,
        **{f"lossy:{c}": seen.get[f"lossy:{c}"] for c in lossy or {}},
    }


def read_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Checked rows as written; ``schema`` is the checked frame's schema.

    Filters on ``rejected`` prune the other half's files.
    """
    return spark.read.schema(schema).parquet(path)


def write_staging(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Compressed Parquet staging output, split into directories by ``partition_by``."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """A kept table with its declared types."""
    return spark.read.schema(ddl(table)).parquet(path)


def open_table(
    spark: SparkSession, path: str, table: Table, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """A kept table, created empty when it does not exist yet."""
    writer = conform(spark.range(0), table).write.mode("ignore")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return read_table(spark, path, table)


def append_rows(df: DataFrame, path: str, table: Table, partition_by: tuple[str, ...] = ()) -> None:
    writer = conform(df, table).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_run(df: DataFrame, path: str, table: Table, run_date: date) -> None:
    """Replace the rows of one run date; other dates' files stay as they are.

    ``df`` holds rows of that date only, or none: then the date's old rows go. The old files are
    readable until the job commits, so ``df`` may be built from them. Rows are ordered by date
    and region inside each file, which keeps the column statistics narrow. One writer at a time;
    after a driver crash, run the load again. ``sources.catalog`` replaces a date in one step.
    """
    seen = Observation()
    other = F.raise_error(F.lit(f"Row of another run date than {run_date}")).cast("date")
    own = F.when(F.col("pipeline_run_date") == F.lit(run_date), F.col("pipeline_run_date"))
    (
        conform(df, table)
        .withColumn("pipeline_run_date", own.otherwise(other))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .sortWithinPartitions("date_key", "region_key")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("pipeline_run_date")
        .parquet(path)
    )
    if not seen.get["rows"]:
        # A dynamic overwrite leaves partitions alone that get no row.
        empty = conform(df.sparkSession.range(0), {k: v for k, v in table.items() if k != "pipeline_run_date"})
        empty.write.mode("overwrite").parquet(f"{path}/pipeline_run_date={run_date}")


# Times in exported files keep their microseconds.
TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV directory with a header, a file per task; a run log has a single task's rows."""
    df.write.mode("overwrite").options(header=True, escape='"', **TIMES).csv(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """An exported run log with its types; a value that does not fit fails the read."""
    options = {"header": True, "enforceSchema": False, "escape": '"', "multiLine": True, "mode": "FAILFAST"}
    return spark.read.options(**options, **TIMES).schema(ddl(RUN_LOG)).csv(path)
