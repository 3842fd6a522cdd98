"""Incremental ingest of the dated landing area.

The daily run names the days that it reads. This job instead picks up whatever files have arrived
since it last ran, late days included, checks them with the same expressions and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.text import markers_to_null
from tidewater.operators import quality
from tidewater.operators.rules import rules_for
from tidewater.schemas import UNREADABLE, Table
from tidewater.sources.readers import with_landing_date

FORMATS = ("csv", "json")
# Older than any file.
ALL_AGES = "100000d"


def landing_stream(
    spark: SparkSession,
    root: str,
    source: str,
    table: Table,
    file_format: str = "csv",
    files_per_batch: int = 10_000,
    remember: str = ALL_AGES,
) -> DataFrame:
    """All files below ``root/<source>/YYYY/MM/DD`` as a stream of text rows with their day.

    A run takes all new files, in batches of ``files_per_batch``, so that a failure repeats one
    batch and not the whole backlog. No file is too old to be read; ``remember`` may name an age
    against the newest file beyond which files are not looked at.
    """
    if file_format not in FORMATS:
        raise ValueError(f"file_format must be one of {FORMATS}, not {file_format!r}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*table, UNREADABLE)])
    options = {"columnNameOfCorruptRecord": UNREADABLE}
    if file_format == "csv":
        options |= {"header": True, "escape": '"', "enforceSchema": False}
    options |= {"maxFilesPerTrigger": files_per_batch, "maxFileAge": remember}
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    return markers_to_null(with_landing_date(reader.load(f"{root}/{source}/*/*/*")))


def ingest_new_files(
    spark: SparkSession,
    root: str,
    source: str,
    table: Table,
    out: str,
    checkpoint: str,
    file_format: str = "csv",
) -> StreamingQuery:
    """Check every file that is new since the last call and append both halves to ``out``.

    ``checkpoint`` must lie on storage that all machines share: it remembers the files that were
    read, so each file's rows are written once, whatever fails in between. Rows carry no state,
    so memory does not grow with the stream.
    """
    checked = quality.check(
        landing_stream(spark, root, source, table, file_format), rules_for(source)
    )
    query = (
        checked.writeStream.format("parquet")
        .partitionBy("landing_date", "rejected")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
