"""Readers for raw CSV, JSON and the dated landing area.

Every feed is read as text, so that a row with an odd value still reaches the quality check and,
if rejected, keeps the text that was sent. ``typed`` casts the accepted rows afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.numbers import column, number
from tidewater.functions.text import markers_to_null
from tidewater.schemas import NUMBER_TYPES, PARSED, UNREADABLE, Table, spark_type

LANDING_DAY = r"/(\d{4}/\d{2}/\d{2})/"

Paths = str | list[str]


def csv_header(spark: SparkSession, path: Paths, multiline: bool = False) -> T.StructType:
    """The header's names as text columns; reads one line."""
    return spark.read.options(header=True, escape='"', multiLine=multiline).csv(path).schema


def _csv_text(spark: SparkSession, path: Paths, multiline: bool, strict: bool) -> DataFrame:
    header = csv_header(spark, path, multiline)
    options = {"header": True, "escape": '"', "multiLine": multiline, "enforceSchema": False}
    options |= {"columnNameOfCorruptRecord": UNREADABLE}
    options["mode"] = "FAILFAST" if strict else "PERMISSIVE"
    schema = header if strict else T.StructType([*header, T.StructField(UNREADABLE, T.StringType())])
    return spark.read.options(**options).schema(schema).csv(path)


def _json_text(spark: SparkSession, path: Paths, table: Table, array: bool) -> DataFrame:
    fields = [T.StructField(name, T.StringType()) for name in (*table, UNREADABLE)]
    options = {"multiLine": array, "columnNameOfCorruptRecord": UNREADABLE}
    return spark.read.options(**options).schema(T.StructType(fields)).json(path)


def read_csv(
    spark: SparkSession, path: Paths, multiline: bool = False, strict: bool = False
) -> DataFrame:
    """A CSV feed as text columns named by its header, missing-value markers as null.

    Only the header line is read here: no type inference, so no extra pass and no column that
    changes type because of one odd value. Every further file must carry the same header; one
    that does not fails the read instead of shifting its columns. Keep ``multiline`` off unless
    quoted values hold line breaks, since it makes files unsplittable. The whole text of a row with
    more or fewer values than the header goes to ``unreadable_record``, which the check rejects;
    with ``strict`` such a row fails the read and that column is left out.
    """
    return markers_to_null(_csv_text(spark, path, multiline, strict))


def read_json(spark: SparkSession, path: Paths, table: Table, array: bool = False) -> DataFrame:
    """A JSON feed as text columns: one record per line, or one array per file.

    Array files cannot be split, so large feeds should come as lines or as many files. A line
    that is not JSON becomes a row of nulls with its text in ``unreadable_record``, so the check
    rejects it and the reject table shows it.
    """
    return markers_to_null(_json_text(spark, path, table, array))


def landing_paths(root: str, source: str, days: Iterable[date]) -> list[str]:
    """Directories of the landing area ``root/<source>/YYYY/MM/DD`` for the given days."""
    return [f"{root}/{source}/{day:%Y/%m/%d}" for day in days]


def with_landing_date(df: DataFrame) -> DataFrame:
    """Add the day of the landing directory that a row's file lies in, null if it is in none."""
    day = F.regexp_extract(F.col("_metadata.file_path"), LANDING_DAY, 1)
    return df.select("*", F.try_to_date(day, "yyyy/MM/dd").alias("landing_date"))


def read_landing_csv(
    spark: SparkSession,
    root: str,
    source: str,
    days: Iterable[date],
    multiline: bool = False,
    strict: bool = False,
) -> DataFrame:
    """CSV feed of the given landing days; other days are never listed."""
    text = _csv_text(spark, landing_paths(root, source, days), multiline, strict)
    return markers_to_null(with_landing_date(text))


def read_landing_json(
    spark: SparkSession,
    root: str,
    source: str,
    days: Iterable[date],
    table: Table,
    array: bool = False,
) -> DataFrame:
    """JSON feed of the given landing days; other days are never listed."""
    text = _json_text(spark, landing_paths(root, source, days), table, array)
    return markers_to_null(with_landing_date(text))


def _numbers(df: DataFrame, table: Table) -> dict[str, Column]:
    """The feed's number columns as numbers: those that the check parsed, else parsed here."""
    held = set(df.schema[PARSED].dataType.names) if PARSED in df.columns else set()
    names = [c for c in df.columns if spark_type(table.get(c, "string")) in NUMBER_TYPES]
    return {c: F.col(PARSED)[c] if c in held else number(df, c) for c in names}


def typed(df: DataFrame, table: Table) -> DataFrame:
    """Accepted text rows cast to the feed's types; columns the feed does not name are kept.

    A range rule lets text pass, so a number column may still hold words: they become null, and
    a fraction of a whole number is cut off. ``lossy_values`` flags both, and the daily run counts
    and logs them. Dates raise when they cannot be read.
    """
    casts = {}
    numbers = _numbers(df, table)
    for name in df.columns:
        kind = spark_type(table.get(name, "string"))
        if name in numbers:
            casts[name] = numbers[name].cast(kind)
        elif name in table:
            casts[name] = column(name).cast(kind)
        elif name != PARSED:
            casts[name] = column(name)
    return df.select(*[c.alias(name) for name, c in casts.items()])


def lossy_values(df: DataFrame, table: Table) -> dict[str, Column]:
    """Per number column of the feed, whether a row's text holds more than ``typed`` keeps of it."""
    flags = {}
    for name, value in _numbers(df, table).items():
        lost = column(name).isNotNull() & value.isNull()
        if spark_type(table[name]) != "double":
            lost |= F.coalesce(value != F.floor(value), F.lit(False))
        flags[name] = lost
    return flags
