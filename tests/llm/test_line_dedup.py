import plain
import pytest
from oracle_check import differences, open_tables
from pyspark.sql import functions as F

from tidewater.llm import oracle, queries
from tidewater.llm.line_dedup import drop_shared_lines, without_shared_lines


@pytest.mark.parametrize("name", oracle.ORACLE)
def test_query_equals_its_twin(spark, sf_dir, name):
    tables = open_tables(sf_dir)
    assert differences(spark, tables, queries.QUERIES[name], oracle.ORACLE[name], sf_dir) == []


def test_query_equals_brute_force(spark, sf_dir, texts):
    rows = queries.op8_line_dedup(spark, sf_dir).collect()
    expected = {i: (n, k, plain.sha(t)) for i, (n, k, t) in plain.shared_lines(texts).items()}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in rows} == expected


def test_odd_rows(odd):
    rows = {r.doc_id: r for r in drop_shared_lines(odd).collect()}
    assert drop_shared_lines(odd).count() == odd.count()
    assert rows[1].n_dropped == 0 and rows[2].n_dropped == 1
    assert rows[2].text == "own words of the second\n\n" and rows[2].n_lines == 4
    assert (rows[3].text, rows[3].n_lines, rows[4].text, rows[4].n_lines) == ("", 1, "", 1)
    assert rows[6].text == " \n\t\n" and rows[8].text == ""
    assert rows[7].n_dropped == 0 and rows[None].n_dropped == 0


def test_null_id_comes_last(spark):
    rows = [(None, "a line that is shared"), (5, "a line that is shared")]
    out = {r.doc_id: r.text for r in drop_shared_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {None: "", 5: "a line that is shared"}


def test_lines_repeated_in_one_document_stay(spark):
    df = spark.createDataFrame([(1, "one long line here\none long line here")], "doc_id long, text string")
    assert drop_shared_lines(df).first().n_dropped == 0


def test_higher_threshold(spark):
    rows = [(i, "shared by some of them") for i in range(3)] + [(i, "shared by only two of them") for i in (3, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.n_dropped for r in drop_shared_lines(df, min_docs=3).collect()}
    assert out == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0}


def test_clashing_columns_and_empty_table(odd, nothing):
    clashing = odd.withColumns({c: F.lit("x") for c in ("n_lines", "drops", "_lines", "_doc", "pos", "h1", "doc")})
    kept = without_shared_lines(clashing)
    assert kept.columns == clashing.columns and kept.filter("n_lines = 'x'").count() == odd.count()
    assert drop_shared_lines(clashing).filter("n_dropped = 1").count() == 2
    assert drop_shared_lines(nothing).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    text = queries.op8_line_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
