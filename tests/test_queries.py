"""Every registered query against its SQL twin, and the plans that scale depends on."""

import datetime as dt
import re

import pytest
from oracle_check import differences, open_tables
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tidewater.operators import keys, measures, quality, upsert
from tidewater.operators.rules import rules_for
from tidewater.plans import catalog, derived, oracle, roundtrips
from tidewater.schemas import FACT_OPERATIONS, WAREHOUSE_FEED, ddl
from tidewater.sources import api
from tidewater.sources.tables import read_table, replace_run

QUERIES = catalog.QUERIES
TWINS = oracle.oracle_sql()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS) and set(QUERIES) <= set(entry_point.queries())


def test_entry_module_works_without_the_corpus_operators(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    bare = importlib.import_module("__spark_entry__")
    assert set(bare.queries()) == set(QUERIES) == set(bare.oracle_sql())


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_no_twin_is_empty(scale):
    con = open_tables(f"/root/testdata/{scale}")
    empty = [name for name, sql in TWINS.items() if not con.execute(f"SELECT 1 FROM ({sql}) LIMIT 1").fetchall()]
    assert empty == []


@pytest.fixture(scope="module")
def tables():
    import os

    return open_tables(os.environ.get("TIDEWATER_SF_DIR", "/root/testdata/sf0.001"))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, sf_dir, name):
    assert differences(spark, tables, QUERIES[name], TWINS[name], sf_dir) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_the_plans(spark, sf_dir):
    for name, query in QUERIES.items():
        text = plan(query(spark, sf_dir))
        assert "Python" not in text and "Pandas" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_check_and_enrichment_need_no_shuffle(spark, sf_dir):
    for name in ("qc_passed", "qc_rejected", "enrich_warehouse", "stage_ops"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text, name


def test_measures_read_only_their_columns(spark, sf_dir):
    text = plan(measures.evaluate(derived.audit_log(spark, sf_dir), "avg_duration_min"))
    assert "ReadSchema: struct<value:double>" in text


def test_load_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "fact")
    days = [dt.date(2024, 7, d) for d in (1, 2)]
    empty = {name: None for name in FACT_OPERATIONS}
    rows = [tuple({**empty, "fact_key": 1, "pipeline_run_date": d}.values()) for d in days]
    for row, day in zip(rows, days):
        replace_run(spark.createDataFrame([row], ddl(FACT_OPERATIONS)), path, FACT_OPERATIONS, day)
    target = read_table(spark, path, FACT_OPERATIONS).filter("pipeline_run_date = DATE '2024-07-02'")
    text = plan(upsert.merge(target, target.withColumn("date_key", F.lit(1))))
    assert text.count("FileScan") == text.count("PartitionFilters: [isnotnull(pipeline_run_date")
    assert "FileScan" in text


def test_order_lines_move_before_they_are_text(spark, sf_dir, tmp_path):
    """API records are made after the shuffle, from the given numbers, and saved compressed."""
    plan = roundtrips.api_responses(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RepartitionByExpression") :]
    assert "collect_list" in plan[: plan.index("RepartitionByExpression")]
    assert "to_json" not in moved and "ORD-" not in moved
    path = roundtrips._saved_api(spark, sf_dir)
    names = {f.rsplit("/", 1)[-1] for f in spark.read.text(path).inputFiles()}
    assert names and all(n.endswith(".gz") for n in names)


def test_the_api_check_is_compiled(spark, tmp_path):
    """The JVM interprets methods of over 8000 bytes for good, which took 1.4 times as long."""
    (tmp_path / "api.json").write_text('{"request_id":"R","page":1,"total_pages":1,"data":[{"id":"x"}]}\n')
    read = api.read_api(spark, str(tmp_path / "api.json"))
    checked = quality.check(read, rules_for("api"), feed=WAREHOUSE_FEED)
    plan = checked._jdf.queryExecution().executedPlan()
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_numbering_moves_no_row(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id * 3 AS x").filter("x % 2 = 0")
    numbered = keys.kept_with_places(rows, "place")
    found = numbered.collect()
    assert sorted(r.place for r in found) == list(range(2500))
    assert [r.x for r in sorted(found, key=lambda r: r.place)] == [x for x in range(0, 15000, 3) if x % 2 == 0]
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
