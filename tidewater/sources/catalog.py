"""Run-partitioned tables of the session's catalog, replaced in one step.

The catalog says in which folder a run date's rows lie. A load writes a folder of its own and then
points the catalog to it. Until then readers see the old rows, from then on the new ones, and a
load that breaks off in between changes nothing. The catalog has to outlive the session, as a
metastore does, for other sessions to see the same.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.numbers import column
from tidewater.schemas import Table, conform, ddl
from tidewater.sources.checkpoint import delete_folder

RUN = "pipeline_run_date"


def open_run_table(spark: SparkSession, name: str, root: str, table: Table) -> DataFrame:
    """The catalog's table ``name``, created below ``root`` when it does not exist yet."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(table)}) USING parquet PARTITIONED BY ({RUN}) LOCATION '{root}'")
    return spark.table(name)


def _location(spark: SparkSession, name: str, run_date: date) -> str | None:
    """Where the catalog finds a run date's rows, None for a date without rows."""
    shown = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({RUN} = '{run_date}')")
    if shown.isEmpty():
        return None
    told = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION ({RUN} = '{run_date}')")
    return told.filter("col_name = 'Location'").first()["data_type"]


def write_version(df: DataFrame, root: str, table: Table, run_date: date) -> str:
    """Write a run date's rows to a new folder below ``root`` and return the folder.

    Rows of another date fail the write. Nobody reads the folder before it is published.
    """
    folder = f"{root}/{RUN}={run_date}/{uuid.uuid4()}"
    other = F.raise_error(F.lit(f"Row of another run date than {run_date}")).cast("boolean")
    rows = conform(df, table).filter(F.when(F.col(RUN) == F.lit(run_date), True).otherwise(other))
    rows.sortWithinPartitions("date_key", "region_key").drop(RUN).write.parquet(folder)
    return folder


def publish_version(spark: SparkSession, name: str, run_date: date, folder: str) -> str | None:
    """Make a written folder the run date's rows; returns the folder that was it before."""
    before = _location(spark, name, run_date)
    partition = f"PARTITION ({RUN} = '{run_date}')"
    if before is None:
        spark.sql(f"ALTER TABLE {name} ADD {partition} LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {name} {partition} SET LOCATION '{folder}'")
    return before


def replace_run_at_once(df: DataFrame, name: str, root: str, table: Table, run_date: date, keep_old: bool = False) -> None:
    """Replace one run date's rows of a catalog table; a rerun without rows empties the date.

    ``df`` may be built from the old rows. Their folder is deleted after the switch; ``keep_old``
    leaves it for queries that still read it.
    """
    spark = df.sparkSession
    before = publish_version(spark, name, run_date, write_version(df, root, table, run_date))
    if before and not keep_old:
        delete_folder(spark, before)


def run_rows(spark: SparkSession, name: str, run_date: date) -> DataFrame:
    """One run date's rows; other dates' folders are not listed."""
    return spark.table(name).filter(column(RUN) == F.lit(run_date))
