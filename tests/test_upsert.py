import datetime as dt
import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidewater.operators import upsert
from tidewater.operators.keys import kept_with_places

DAY = dt.date(2024, 7, 1)
COLUMNS = (
    "date_key int, region_key int, shift_key int, source_key int, throughput_uph decimal(8,2),"
    " total_cost decimal(12,2), pipeline_run_date date, record_source string"
)


def frame(spark, rows):
    """Rows of (date, region, shift, source key, throughput, run date, source)."""
    full = [(d, r, s, k, t, t * 2 if t is not None else None, day, src) for d, r, s, k, t, day, src in rows]
    return spark.createDataFrame(
        full,
        COLUMNS.replace("decimal(8,2)", "double").replace("decimal(12,2)", "double"),
    ).selectExpr(
        "date_key", "region_key", "shift_key", "source_key",
        "CAST(throughput_uph AS decimal(8,2)) AS throughput_uph",
        "CAST(total_cost AS decimal(12,2)) AS total_cost", "pipeline_run_date", "record_source",
    )


def result(merged):
    return Counter(
        (r.date_key, r.region_key, r.shift_key, r.source_key,
         None if r.throughput_uph is None else float(r.throughput_uph),
         r.pipeline_run_date, r.record_source, r.action)
        for r in merged.collect()
    )


def brute_force(target, source):
    """The same upsert with plain loops."""
    key = lambda row: (*row[:3], row[5])
    new = {}
    for row in source:
        new.setdefault(key(row), []).append(row)
    held = {key(row) for row in target if None not in key(row)}
    out = []
    for row in target:
        if key(row) in new and None not in key(row):
            (hit,) = new[key(row)]
            out.append((*row[:4], hit[4], *row[5:], "update"))
        else:
            out.append((*row, "keep"))
    out += [(*row, "insert") for k, rows in new.items() if k not in held for row in rows]
    return Counter(out)


def random_rows(rng, n, keys, run_days):
    return [
        (*rng.choice(keys), rng.randint(1, 3), float(rng.randint(1, 99)), rng.choice(run_days), "s")
        for _ in range(n)
    ]


def test_against_brute_force(spark):
    rng = random.Random(3)
    keys = [(d, r, s) for d in range(20240101, 20240120) for r in (1, 2, None) for s in (1, 2)]
    for _ in range(2):
        target = random_rows(rng, 60, keys, [DAY, dt.date(2024, 6, 30), None])
        held = {(*row[:3], row[5]) for row in target}
        source, used = [], set()
        for row in random_rows(rng, 80, keys, [DAY]):
            key = (*row[:3], row[5])
            if key not in held or key not in used:
                source.append(row)
            used.add(key)
        merged = upsert.merge(frame(spark, target), frame(spark, source))
        assert result(merged) == brute_force(target, source)


def test_update_keeps_lineage(spark):
    target = frame(spark, [(1, 1, 1, 7, 10.0, DAY, "old")])
    source = frame(spark, [(1, 1, 1, 8, 20.0, DAY, "new")])
    row = upsert.merge(target, source).first()
    assert (row.source_key, row.record_source, float(row.throughput_uph)) == (7, "old", 20.0)


def test_null_measure_overwrites(spark):
    target = frame(spark, [(1, 1, 1, 7, 10.0, DAY, "s")])
    row = upsert.merge(target, frame(spark, [(1, 1, 1, 7, None, DAY, "s")])).first()
    assert row.action == "update" and row.throughput_uph is None


def test_repeated_source_key(spark):
    twice = frame(spark, [(1, 1, 1, 7, 20.0, DAY, "s"), (1, 1, 1, 7, 30.0, DAY, "s")])
    target = frame(spark, [(1, 1, 1, 7, 10.0, DAY, "s")])
    with pytest.raises(Exception, match=upsert.REPEATED_KEY):
        upsert.merge(target, twice)  # fails here, whatever the size
    (row,) = upsert.repeated_keys(target, twice).collect()
    assert (row.date_key, row.copies) == (1, 2)

    elsewhere = frame(spark, [(2, 1, 1, 7, 10.0, DAY, "s")])
    merged = upsert.merge(elsewhere, twice)
    assert sorted(r.action for r in merged.collect()) == ["insert", "insert", "keep"]
    assert upsert.repeated_keys(elsewhere, twice).count() == 0

    older = frame(spark, [(1, 1, 1, 7, 10.0, dt.date(2024, 6, 30), "s")])
    assert upsert.records_loaded(upsert.merge(older, twice)).first().records_loaded == 2


def test_hot_key(spark):
    """A third of the target and of the inserts on one key, with joins of either kind."""
    target = [(1, 1, 1, 1, 5.0, DAY, "s")] * 3000 + [(i, 2, 1, 1, 5.0, DAY, "s") for i in range(3000)]
    source = [(1, 1, 1, 2, 9.0, DAY, "s")] + [(7, 7, 7, 1, 1.0, DAY, "s")] * 3000
    expected = brute_force(target, source)
    merged = upsert.merge(frame(spark, target), frame(spark, source))
    assert result(merged) == expected
    counts = {r.action: r.records for r in upsert.action_counts(merged).collect()}
    assert counts == {"update": 3000, "keep": 3000, "insert": 3000}
    with no_broadcast(spark):
        merged = upsert.merge(frame(spark, target), frame(spark, source))
        assert result(merged) == expected


@contextmanager
def no_broadcast(spark):
    """Shuffled joins only, with partitions of 100 KB counting as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed_rows(spark, n, hot, others):
    """A third of the rows on the key ``hot``; values that do not compress."""
    return spark.range(0, n, 1, 8).selectExpr(
        f"CAST(CASE WHEN id % 3 = 0 THEN {hot} ELSE {others} + id % 1000 END AS int) AS date_key",
        "1 AS region_key", "1 AS shift_key", "1 AS source_key",
        "CAST(id % 100 AS decimal(8,2)) AS throughput_uph",
        "CAST(rand(1) * 1000 AS decimal(12,2)) AS total_cost",
        "DATE '2024-07-01' AS pipeline_run_date", "CAST(rand(2) AS string) AS record_source",
    )


def test_hot_key_is_split_when_shuffled(spark):
    with no_broadcast(spark):
        target = skewed_rows(spark, 120_000, 5, 2_000_000)
        source = skewed_rows(spark, 120_000, 7, 10_000)
        source = source.unionByName(skewed_rows(spark, 1, 5, 0))
        merged = upsert.merge(target, source)
        # A checksum over all columns, so that none is pruned.
        sums = merged.groupBy("action").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64(*merged.columns).cast("decimal(38,0)")).alias("checksum"),
        )
        assert {r.action: r.n for r in sums.collect()} == {
            "update": 40_000, "keep": 80_000, "insert": 120_000,
        }
        final = sums._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        joins = [line for line in final.splitlines() if "SortMergeJoin" in line]
        assert any("skew=true" in j and "LeftOuter" in j for j in joins), joins


def test_inserts_are_numbered_once_each(spark):
    target = frame(spark, [(1, 1, 1, 7, 10.0, DAY, "s")])
    rows = [(1, 1, 1, 7, 1.0, DAY, "s")] + [(i, 1, 1, 7, 1.0, DAY, "s") for i in range(2, 500)] * 3
    merged = upsert.merge(target, frame(spark, rows).repartition(7))
    numbers = [r.insert_no for r in merged.collect() if r.action == "insert"]
    assert len(set(numbers)) == len(numbers) == 498 * 3 and None not in numbers
    assert merged.filter("action <> 'insert' AND insert_no IS NOT NULL").count() == 0


def test_keep_one(spark):
    rows = spark.range(1000).selectExpr("id % 7 AS k", "(id * 37) % 1000 AS v")
    kept = upsert.keep_one(rows, ("k",), [F.desc("v")])
    expected = {r.k: r.m for r in rows.groupBy("k").agg(F.max("v").alias("m")).collect()}
    assert {r.k: r.v for r in kept.collect()} == expected
    # Each task keeps one row per key before the shuffle.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]


@pytest.mark.parametrize("tasks", [1, 6, 40])
def test_places_are_consecutive(spark, tasks):
    rows = spark.range(0, 1000, 1, tasks).filter("id % 7 <> 3").repartition(tasks).withColumn("x", F.rand(1))
    placed = kept_with_places(rows, "place")
    got = placed.orderBy("place").collect()
    assert [r.place for r in got] == list(range(len(got))) and len(got) == rows.count()
    assert placed.columns == ["id", "x", "place"]
    ordered = kept_with_places(rows.orderBy("x"), "place").orderBy("place").collect()
    assert [r.x for r in ordered] == sorted(r.x for r in ordered)
    assert kept_with_places(rows.limit(0), "place").count() == 0


def test_fact_keys(spark):
    held = None
    seen = set()
    for day, load in [(DAY, 0), (DAY, 1), (dt.date(2024, 7, 2), 0), (DAY, 2)]:
        places = kept_with_places(spark.range(0, 5000, 1, 50 + load), "place")
        old = F.lit(held if day == DAY else None).cast("bigint")
        rows = places.select(upsert.new_fact_keys(day, old, F.col("place")).alias("k")).collect()
        keys = {r.k for r in rows}
        assert len(keys) == 5000 and not keys & seen and min(keys) > 0
        seen |= keys
        if day == DAY:
            assert held is None or min(keys) == held + 1
            held = max(keys)


def test_keys_do_not_depend_on_the_number_of_tasks(spark):
    """More tasks than any fixed width would hold are only larger numbers."""
    far = F.lit((1 << 40) + 5)
    row = spark.range(1).select(upsert.new_fact_keys(DAY, F.lit(None).cast("bigint"), far).alias("k")).first()
    assert row.k == ((DAY - upsert.KEY_EPOCH).days << upsert.DAY_SHIFT) + (1 << 40) + 5
