import datetime as dt
import io
import json
import os

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.operators import quality
from tidewater.operators.rules import RULES
from tidewater.schemas import FINANCE_FEED, UNREADABLE, WAREHOUSE_FEED, conform, ddl
from tidewater.sources.readers import (
    lossy_values,
    read_csv,
    read_json,
    read_landing_csv,
    read_landing_json,
    typed,
)
from tidewater.sources.tables import (
    export_csv,
    open_table,
    read_checked,
    read_table,
    replace_run,
    write_checked,
    write_staging,
)
from tidewater.streaming.landing import ingest_new_files, landing_stream

HEADER = ",".join(WAREHOUSE_FEED)
GOOD = "ORD-1,2024-01-05,Region 1,Day,115.5,2.5,2.8,95.5,20.1,100,4.55"
ODD = [
    GOOD,
    "NA,2024-01-05,Region 1,Day,115.5,2.5,2.8,95.5,20.1,100,4.55",
    '"ORD-3, ""b""",2024-01-05,"Region 2",Night,abc,2.5,2.8,95.5,20.1,100,4.55',
    "ORD-4,2024-01-05,,Day,115.5,N/A,null,,None,100,4.55",
    'ORD-5,2024-01-05,"",Day,115.5,,2.8,95.5,,,',
    "ORD-6,2024-01-06,Region 1,Day,1e2,nan,abc,95.5,20.1,7,4.55",
]


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_matches_pandas(spark, tmp_path):
    path = put(tmp_path / "w.csv", HEADER, *ODD)
    feed = read_csv(spark, path)
    assert feed.columns == [*WAREHOUSE_FEED, UNREADABLE]
    rows = [tuple(r) for r in feed.collect()]
    assert {r[-1] for r in rows} == {None}
    ours = [r[:-1] for r in rows]
    theirs = pd.read_csv(io.StringIO(open(path).read()), dtype=str)
    assert ours == [
        tuple(None if v != v else v for v in r) for r in theirs.itertuples(index=False)
    ]


def test_csv_with_line_breaks(spark, tmp_path):
    path = put(tmp_path / "m.csv", "a,b", '"one\ntwo",2', "three,4")
    assert [r.a for r in read_csv(spark, path, multiline=True).collect()] == ["one\ntwo", "three"]


def test_uneven_rows_are_rejected_with_their_text(spark, tmp_path):
    lines = [GOOD, GOOD + ",extra", "ORD-9,2024-01-05,Region 1", '"ORD-1,2024', GOOD + ","]
    path = put(tmp_path / "u.csv", HEADER, *lines)
    checked = quality.check(read_csv(spark, path), RULES["warehouse"])
    assert [r.order_id for r in quality.passed(checked).collect()] == ["ORD-1"]
    bad = quality.rejected(checked).collect()
    assert [r.unreadable_record for r in bad] == lines[1:]
    assert all(r.rejection_reason.startswith("unreadable_record") for r in bad)
    assert quality.passed(checked).columns == list(WAREHOUSE_FEED)
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, path, strict=True).collect()


def test_lossy_values_of_accepted_rows_are_counted(spark, tmp_path):
    rows = [GOOD, GOOD.replace(",2.8,", ",abc,"), GOOD.replace(",100,", ",12.7,"), "NA" + GOOD.replace(",2.8,", ",abc,")[5:]]
    feed = read_csv(spark, put(tmp_path / "l.csv", HEADER, *rows))
    checked = quality.check(feed, RULES["warehouse"])
    counts = write_checked(checked, str(tmp_path / "checked"), lossy_values(feed, WAREHOUSE_FEED))
    found = {k: n for k, n in counts.items() if k.startswith("lossy:") and n}
    assert found == {"lossy:defect_rate_pct": 1, "lossy:units_processed": 1}


def test_files_with_another_header_fail(spark, tmp_path):
    put(tmp_path / "d" / "a.csv", "a,b", "1,2")
    put(tmp_path / "d" / "b.csv", "b,a", "1,2")
    with pytest.raises(Exception, match="header does not conform"):
        read_csv(spark, str(tmp_path / "d")).collect()


def test_typed_rows(spark, tmp_path):
    feed = read_csv(spark, put(tmp_path / "w.csv", HEADER, *ODD))
    rows = typed(quality.passed(quality.check(feed, RULES["warehouse"])), WAREHOUSE_FEED)
    assert [f"{n} {t}" for n, t in rows.dtypes] == [f"{n} {t}" for n, t in WAREHOUSE_FEED.items()]
    kept = {r.order_id: r for r in rows.collect()}
    assert set(kept) == {"ORD-1", "ORD-6"}
    assert kept["ORD-6"].throughput_uph == 100.0
    assert kept["ORD-6"].defect_rate_pct is None and kept["ORD-6"].dock_delay_hrs is None
    assert kept["ORD-1"].order_date == dt.date(2024, 1, 5)


FINANCE_ROWS = [
    {"record_id": "FIN-1", "month": "2024-01", "business_unit": "NE", "cost_center": "Labor",
     "amount": 1500.5, "record_type": "actual"},
    {"record_id": None, "month": "2024-01", "business_unit": "NE", "cost_center": "Labor",
     "amount": "oops", "record_type": "actual"},
    {"record_id": "FIN-3", "business_unit": "NA", "cost_center": "Labor", "amount": -5},
]


@pytest.mark.parametrize("array", [True, False])
def test_json(spark, tmp_path, array):
    lines = [json.dumps(r) for r in FINANCE_ROWS]
    path = put(tmp_path / "f.json", json.dumps(FINANCE_ROWS, indent=1)) if array else put(
        tmp_path / "f.json", *lines, "{broken"
    )
    feed = read_json(spark, path, FINANCE_FEED, array)
    out = quality.check(feed, RULES["finance"])
    assert [r.record_id for r in typed(quality.passed(out), FINANCE_FEED).collect()] == ["FIN-1"]
    bad = quality.rejected(out).collect()
    assert bad[0].rejection_reason == "null:record_id non_positive:amount"
    assert bad[0].amount == "oops"
    assert bad[1].rejection_reason == "null:month null:business_unit non_positive:amount"
    assert [r.unreadable_record for r in bad[2:]] == ([] if array else ["{broken"])


def test_landing(spark, tmp_path):
    for day in ("2024/07/01", "2024/07/02", "2024/07/03"):
        put(tmp_path / "raw" / "warehouse" / day / "a.csv", HEADER, GOOD)
        put(tmp_path / "raw" / "finance" / day / "a.json", json.dumps(FINANCE_ROWS[0]))
    days = [dt.date(2024, 7, 1), dt.date(2024, 7, 3)]
    rows = read_landing_csv(spark, str(tmp_path / "raw"), "warehouse", days)
    assert sorted(r.landing_date for r in rows.collect()) == days
    rows = read_landing_json(spark, str(tmp_path / "raw"), "finance", days, FINANCE_FEED)
    assert sorted(r.landing_date for r in rows.collect()) == days


def test_checked_rows_are_replaced_as_a_whole(spark, tmp_path):
    out = str(tmp_path / "checked")
    feed = read_csv(spark, put(tmp_path / "w.csv", HEADER, *ODD))
    first = quality.check(feed, RULES["warehouse"])
    counts = write_checked(first, out)
    assert counts == {
        "records_in": 6, "records_out": 2, "records_rejected": 4, "rejection_rate": 4 / 6 * 100,
    }
    back = read_checked(spark, out, first.schema)
    assert quality.passed(back).count() == 2
    assert quality.rejected(back).columns == [*WAREHOUSE_FEED, UNREADABLE, "rejection_reason"]
    assert sorted(map(str, quality.rejected(back).collect())) == sorted(
        map(str, quality.rejected(first).collect())
    )
    plan = quality.passed(back)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan

    clean = read_csv(spark, put(tmp_path / "v.csv", HEADER, GOOD))
    assert write_checked(quality.check(clean, RULES["warehouse"]), out)["records_rejected"] == 0
    back = read_checked(spark, out, first.schema)
    assert (quality.passed(back).count(), quality.rejected(back).count()) == (1, 0)


def test_checked_rows_of_an_empty_feed(spark, tmp_path):
    empty = read_csv(spark, put(tmp_path / "e.csv", HEADER))
    out = quality.check(empty, RULES["warehouse"])
    counts = write_checked(out, str(tmp_path / "checked"))
    assert counts["records_in"] == counts["records_rejected"] == counts["rejection_rate"] == 0
    assert read_checked(spark, str(tmp_path / "checked"), out.schema).count() == 0


def test_staging_output(spark, tmp_path):
    out = str(tmp_path / "staging")
    write_staging(spark.range(4).withColumn("half", F.col("id") % 2), out, ("half",))
    names = [p.name for p in (tmp_path / "staging").glob("half=*/*.parquet")]
    assert names and all("snappy" in n for n in names)
    assert spark.read.parquet(out).filter("half = 1").count() == 2


def test_replace_run_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "fact")
    table = {"date_key": "int", "region_key": "int", "pipeline_run_date": "date"}
    one, two = dt.date(2024, 7, 1), dt.date(2024, 7, 2)
    for day in (one, two):
        replace_run(spark.createDataFrame([(20240101, 1, day)], ddl(table)), path, table, day)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "fact").glob("*07-01/*.parquet")}
    day2 = read_table(spark, path, table).filter("pipeline_run_date = DATE '2024-07-02'")
    replace_run(day2.unionAll(day2), path, table, two)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "fact").glob("*07-01/*.parquet")} == before
    assert read_table(spark, path, table).count() == 3
    # A rerun without rows leaves none of the old ones.
    replace_run(day2.limit(0), path, table, two)
    assert [r.pipeline_run_date for r in read_table(spark, path, table).collect()] == [one]
    with pytest.raises(Exception, match="another run date"):
        replace_run(read_table(spark, path, table), path, table, two)
    assert read_table(spark, path, table).count() == 1


def test_open_table(spark, tmp_path):
    table = {"a": "int", "pipeline_run_date": "date"}
    for name, parts in (("plain", ()), ("split", ("pipeline_run_date",))):
        path = str(tmp_path / name)
        assert open_table(spark, path, table, parts).count() == 0
        row = spark.createDataFrame([(1, dt.date(2024, 7, 1))], ddl(table))
        row.write.mode("append").partitionBy(*parts).parquet(path)
        assert open_table(spark, path, table, parts).collect() == row.collect()


def test_values_that_do_not_fit_raise(spark):
    with pytest.raises(PySparkException):
        conform(spark.sql("SELECT 12345678.9D AS x"), {"x": "decimal(8,2)"}).collect()


def test_export(spark, tmp_path):
    export_csv(spark.range(3).coalesce(1), str(tmp_path / "log.csv"))
    assert len(list((tmp_path / "log.csv").glob("*.csv"))) == 1


def test_stream_reads_each_file_once(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")

    def run():
        ingest_new_files(
            spark, str(raw), "warehouse", WAREHOUSE_FEED, out, str(tmp_path / "checkpoint")
        )
        stream = landing_stream(spark, str(raw), "warehouse", WAREHOUSE_FEED)
        return read_checked(spark, out, quality.check(stream, RULES["warehouse"]).schema)

    put(raw / "warehouse" / "2024/07/01" / "a.csv", HEADER, *ODD)
    assert run().count() == 6
    put(raw / "warehouse" / "2024/07/02" / "b.csv", HEADER, GOOD)
    put(raw / "warehouse" / "2024/07/01" / "late.csv", HEADER, GOOD)
    rows = run()
    per_half = rows.groupBy("landing_date", "rejected").agg(F.count(F.lit(1)).alias("n"))
    counts = {(str(r.landing_date), r.rejected): r.n for r in per_half.collect()}
    assert counts == {("2024-07-01", False): 3, ("2024-07-01", True): 4, ("2024-07-02", False): 1}
    # A file that is far older than the others is read as well.
    old = put(raw / "warehouse" / "2020/07/01" / "old.csv", HEADER, GOOD)
    os.utime(old, (1_000_000_000, 1_000_000_000))
    assert run().count() == rows.count() + 1
    batch = quality.check(read_csv(spark, put(tmp_path / "w.csv", HEADER, *ODD)), RULES["warehouse"])
    expected = sorted(r.rejection_reason for r in quality.rejected(batch).collect())
    assert sorted(r.rejection_reason for r in rows.filter("rejected").collect()) == expected
