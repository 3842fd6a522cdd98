import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import dimensions


def test_default_calendar(spark):
    rows = dimensions.date_dimension(spark)
    assert rows.count() == 4018
    row = rows.filter("date_key = 20240229").first()
    assert row.asDict() == {
        "date_key": 20240229,
        "full_date": dt.date(2024, 2, 29),
        "year": 2024,
        "quarter": 1,
        "month_num": 2,
        "month_name": "February",
        "week_num": 9,
        "day_of_week": "Thursday",
        "is_weekday": True,
    }
    assert rows.filter("NOT is_weekday").select("day_of_week").distinct().count() == 2
    assert dimensions.date_dimension(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0


def test_add_absent(spark):
    existing = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    more = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    once = dimensions.add_absent(existing, more, "k")
    assert {r.k: r.v for r in once.collect()} == {1: "old", 2: "old", 3: "new"}
    assert dimensions.add_absent(once, more, "k").count() == 3


def test_seed(spark):
    existing = spark.createDataFrame([(4, "b", "zone")], "key int, name string, zone string")
    names = spark.createDataFrame([("c",), ("a",), ("b",), (None,), ("a",)], "name string")
    seeded = dimensions.seed_members(existing, names, "name", "key")
    assert {(r.key, r.name, r.zone) for r in seeded.collect()} == {
        (4, "b", "zone"), (5, "a", None), (6, "c", None),
    }
    assert seeded.schema["key"].dataType == existing.schema["key"].dataType
    assert dimensions.seed_members(seeded, names, "name", "key").count() == 3
    first = dimensions.seed_members(existing.limit(0), names, "name", "key")
    assert {(r.key, r.name) for r in first.collect()} == {(1, "a"), (2, "b"), (3, "c")}


def tables(spark):
    return {
        "dim_date": dimensions.date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
        "dim_region": spark.createDataFrame([(1, "North"), (2, "South")], "region_key int, region_name string"),
        "dim_shift": spark.createDataFrame([(1, "Day")], "shift_key int, shift_name string"),
        "dim_source": spark.createDataFrame([(1, "w")], "source_key int, source_name string"),
    }


STAGED = [
    (dt.date(2024, 1, 5), "North", "Day", "w", 1.0),
    (dt.date(2024, 1, 5), "north ", "Day", "w", 2.0),
    (dt.date(2024, 2, 5), "South", "Day", "w", 3.0),
    (dt.date(2024, 1, 5), "East", "Late", "w", 4.0),
    (None, None, "Day", "w", 5.0),
]


def test_resolve(spark):
    staged = spark.createDataFrame(
        STAGED, "order_date date, region string, shift string, record_source string, x double"
    )
    dims = tables(spark)
    exact = dimensions.resolve_operations(staged, dims, dt.date(2024, 7, 1))
    (row,) = exact.collect()
    assert (row.date_key, row.region_key, row.shift_key, row.source_key, row.x) == (20240105, 1, 1, 1, 1.0)
    assert row.pipeline_run_date == dt.date(2024, 7, 1)
    loose = dimensions.resolve_operations(staged, dims, dt.date(2024, 7, 1), ignore_case=True)
    assert sorted(r.x for r in loose.collect()) == [1.0, 2.0]

    lost = dimensions.unmatched_names(staged, dims)
    assert {(r.dimension, r.name): r.records for r in lost.collect()} == {
        ("dim_date", "2024-02-05"): 1,
        ("dim_date", None): 1,
        ("dim_region", "north "): 1,
        ("dim_region", "East"): 1,
        ("dim_region", None): 1,
        ("dim_shift", "Late"): 1,
    }
    loose = dimensions.unmatched_names(staged, dims, ignore_case=True)
    assert loose.filter(F.col("name") == "north ").count() == 0
