"""Audit jobs for the rules that a Parquet table does not enforce."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import column
from tidewater.schemas import MANDATORY, PRIMARY_KEYS, REFERENCES


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, nulls as a value of their own."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def _one_row_each(counts: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """Turn one row of per-column counts into a row per column."""
    pairs = [F.struct(F.lit(c).alias("column_name"), column(c).alias(value)) for c in columns]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def null_counts(df: DataFrame, mandatory: Sequence[str]) -> DataFrame:
    """Missing values per mandatory column, in one pass."""
    counts = df.agg(*[F.count_if(column(c).isNull()).alias(c) for c in mandatory])
    return _one_row_each(counts, mandatory, "null_records")


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Values longer than the column's limit per limited column, in one pass."""
    checked = [c for c in limits if c in df.columns]
    counts = df.agg(*[F.count_if(F.length(column(c)) > limits[c]).alias(c) for c in checked])
    return _one_row_each(counts, checked, "too_long_records")


def orphans(facts: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows per foreign key value that the referenced table lacks; null keys are allowed.

    ``references`` maps a fact column to the dimension and its key. The facts are read once and
    reduced to their distinct key combinations, so a hot key crosses the shuffle as one row per
    task.
    """
    keys = list(references)
    combos = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))
    pairs = [
        F.struct(F.lit(k).alias("column_name"), F.col(k).cast("bigint").alias("value"))
        for k in keys
    ]
    used = (
        combos.select("records", F.explode(F.array(*pairs)).alias("p"))
        .select("records", "p.*")
        .filter("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(F.sum("records").alias("records"))
    )
    known = None
    for k, (dim, dim_key) in references.items():
        part = dim.select(F.lit(k).alias("column_name"), F.col(dim_key).cast("bigint").alias("value"))
        known = part if known is None else known.unionByName(part)
    return used.join(known, ["column_name", "value"], "left_anti")


def star_schema_faults(tables: dict[str, DataFrame]) -> DataFrame:
    """Broken keys, mandatory columns and references of the given tables, by table name.

    Rows (table_name, rule, column_name, records) with at least one record. A reference is
    checked where both of its tables are given; null references are allowed.
    """
    parts = []

    def add(table: str, rule: str, counts: DataFrame) -> None:
        named = counts.filter("records > 0").select(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            "column_name",
            F.col("records").cast("bigint").alias("records"),
        )
        parts.append(named)

    for table, key in PRIMARY_KEYS.items():
        if table in tables:
            copies = duplicate_keys(tables[table], [key]).agg(F.sum("copies").alias("records"))
            add(table, "primary_key", copies.select(F.lit(key).alias("column_name"), "records"))
            mandatory = [key, *MANDATORY.get(table, ())]
            nulls = null_counts(tables[table], mandatory).withColumnRenamed("null_records", "records")
            add(table, "not_null", nulls)
    for fact, columns in REFERENCES.items():
        held = {c: d for c, d in columns.items() if d in tables}
        if fact in tables and held:
            lost = orphans(tables[fact], {c: (tables[d], PRIMARY_KEYS[d]) for c, d in held.items()})
            counts = lost.groupBy("column_name").agg(F.sum("records").alias("records"))
            add(fact, "foreign_key", counts)
    return reduce(DataFrame.unionByName, parts)
