"""Dimension tables: the calendar, member seeding and name resolution."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.calendar import date_key, is_weekday, week_of_year
from tidewater.operators.keys import kept_with_places

# The default calendar span.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)

# Staging column, dimension, the dimension's name column and its key.
OPERATIONS_LOOKUPS = (
    ("order_date", "dim_date", "full_date", "date_key"),
    ("region", "dim_region", "region_name", "region_key"),
    ("shift", "dim_shift", "shift_name", "shift_key"),
    ("record_source", "dim_source", "source_name", "source_key"),
)


def calendar_rows(bounds: DataFrame) -> DataFrame:
    """One calendar row per day from ``first_day`` to ``last_day`` (inclusive) of ``bounds``."""
    span = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    d = F.col("full_date")
    return bounds.select(F.explode(span).alias("full_date")).select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        week_of_year(d).alias("week_num"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        is_weekday(d).alias("is_weekday"),
    )


def date_dimension(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    """The calendar between two dates, both included; empty when they are reversed."""
    last = F.lit(max(start, end)).alias("last_day")
    bounds = spark.range(1 if start <= end else 0).select(F.lit(start).alias("first_day"), last)
    return calendar_rows(bounds)


def absent(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """The candidates whose key ``existing`` does not hold yet."""
    return candidates.join(existing.select(key), key, "left_anti")


def add_absent(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the candidates whose key it does not hold yet."""
    return existing.unionByName(absent(existing, candidates, key))


def new_members(existing: DataFrame, names: DataFrame, name: str, key: str) -> DataFrame:
    """(key, name) of every name that ``existing`` lacks, numbered on from its highest key.

    ``names`` may be a whole feed: it is reduced to distinct names in its own tasks first. The new
    names are sorted and numbered where they are, however many there are.
    """
    fresh = (
        names.select(F.col(name))
        .filter(F.col(name).isNotNull())
        .distinct()
        .join(existing.select(name), name, "left_anti")
    )
    highest = F.coalesce(existing.select(F.max(key).alias(key)).scalar(), F.lit(0))
    numbered = kept_with_places(fresh.orderBy(name), "_place")
    number = highest + F.col("_place") + 1
    return numbered.select(number.cast(existing.schema[key].dataType).alias(key), name)


def seed_members(existing: DataFrame, names: DataFrame, name: str, key: str) -> DataFrame:
    """``existing`` plus a row for every new name; attributes other than the name stay null."""
    fresh = new_members(existing, names, name, key)
    return existing.unionByName(fresh, allowMissingColumns=True)


def _comparable(c: Column, dim: str, ignore_case: bool) -> Column:
    """A name as it is compared with a dimension's names; dates compare as they are."""
    return F.collate(c, "UTF8_LCASE_RTRIM") if ignore_case and dim != "dim_date" else c


def resolve_operations(
    staging: DataFrame,
    dims: dict[str, DataFrame],
    run_date: date | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """Replace the names in staging by the keys of the four dimensions.

    A row whose name is in no dimension is dropped, as by an inner join; ``unmatched_names``
    shows what was lost. ``ignore_case`` also ignores trailing blanks. No broadcast is forced:
    Spark broadcasts a dimension when its size is below the session's threshold and otherwise
    sorts and merges, with skewed names split at run time.
    """
    out = staging
    for column, dim, name, key in OPERATIONS_LOOKUPS:
        members = dims[dim].select(
            _comparable(F.col(name), dim, ignore_case).alias("_member"), F.col(key)
        )
        wanted = _comparable(F.col(column), dim, ignore_case)
        out = out.join(members, wanted == F.col("_member")).drop("_member")
    kept = [c for c in staging.columns if c not in ("order_date", "region", "shift")]
    keys = [key for *_, key in OPERATIONS_LOOKUPS]
    if run_date is not None:
        out = out.withColumn("pipeline_run_date", F.lit(run_date))
        kept.append("pipeline_run_date")
    return out.select(*keys, *[c for c in kept if c not in keys])


def unmatched_names(
    staging: DataFrame, dims: dict[str, DataFrame], ignore_case: bool = False
) -> DataFrame:
    """Rows per dimension and name that the dimension does not hold: (dimension, name, records).

    Staging is read once and reduced to its distinct name combinations before the lookups.
    """
    columns = [column for column, *_ in OPERATIONS_LOOKUPS]
    out = staging.groupBy(*columns).agg(F.count(F.lit(1)).alias("records"))
    lost = []
    for column, dim, name, key in OPERATIONS_LOOKUPS:
        members = dims[dim].select(_comparable(F.col(name), dim, ignore_case).alias("_member"))
        marked = members.distinct().withColumn(f"_in_{dim}", F.lit(True))
        wanted = _comparable(F.col(column), dim, ignore_case)
        out = out.join(marked, wanted == F.col("_member"), "left").drop("_member")
        missing = F.when(
            F.col(f"_in_{dim}").isNull(),
            F.struct(F.lit(dim).alias("dimension"), F.col(column).cast("string").alias("name")),
        )
        lost.append(missing)
    return (
        out.select("records", F.explode(F.array_compact(F.array(*lost))).alias("lost"))
        .groupBy("lost.dimension", "lost.name")
        .agg(F.sum("records").alias("records"))
    )
