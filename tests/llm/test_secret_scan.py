import random
import re

import pytest
from pyspark.sql import functions as F

from tidewater.llm import queries, secret_scan


@pytest.fixture
def leaks(spark):
    rng = random.Random(6)
    rows = []
    for i in range(240):
        key = "".join(rng.choices("0123456789abcdef", k=40))
        mixed = "".join(rng.choices("abcdefghijABCDEFGHIJ0123456789+/", k=32))
        name = "".join(rng.choices(["tion", "ing", "able", "con", "pre", "ment"], k=6))
        kind = i % 4
        text = {
            0: f'we set token = "{key}" for it',
            1: f"the word {name} is long and so is 1234567890123456{i:04}",
            2: f'secret: "{mixed}" stays here',
            3: f"see docs/path/to/some/file_{i}.txt for {name}",
        }[kind]
        rows.append((i, text, "src/app" if i % 2 else "tests/data", kind in (0, 2)))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, leaks boolean")


def test_forest_removes_false_positives(leaks):
    found = secret_scan.find_candidates(leaks)
    assert found.count() >= 240
    truth = found.join(leaks.select("doc_id", "leaks"), "doc_id").withColumn("label", F.col("leaks").cast("int"))
    scanned = secret_scan.scan(leaks, truth.filter("doc_id % 3 = 0"))
    tested = scanned.join(leaks.select("doc_id", "leaks"), "doc_id").filter("doc_id % 3 <> 0")
    right, n = tested.agg(F.count_if(F.expr("kept = leaks")), F.count(F.lit(1))).first()
    assert right / n > 0.97


def test_candidates_and_neighbours(spark):
    text = "a b abcdefghijklmnop0 c  abcdefghijklmnop1=x,abcdefghijklmnop2\nabcdefghijklmnop3"
    df = spark.createDataFrame([(1, text, "p")], "doc_id long, text string, source string")
    rows = secret_scan.find_candidates(df).orderBy("word_no", "part_no").collect()
    assert [(r.word_no, r.part_no, r.candidate[-1], r.before, r.after) for r in rows] == [
        (2, 0, "0", "a b", "c"),
        (4, 0, "x", "abcdefghijklmnop0 c", "abcdefghijklmnop3"),
        (4, 1, "2", "abcdefghijklmnop0 c", "abcdefghijklmnop3"),
        (5, 0, "3", "c abcdefghijklmnop1=x,abcdefghijklmnop2", ""),
    ]


def test_every_candidate_of_the_table_is_found(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries.op2_secret_scan(spark, sf_dir).collect()
    assert len(rows) == sum(len(re.findall(r"[A-Za-z0-9+/_=.\-]{16,}", t)) for t in texts)
    tokens = sum(len(re.findall(r'(?i)token = "[0-9a-f]{40}"', t)) for t in texts)
    assert sum(r.kept for r in rows) == tokens > 0


def test_odd_rows(odd, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, word_no int, part_no int, label int")
    clashing = odd.withColumns({c: F.lit("abcdefghijklmnopq") for c in ("candidate", "word", "path", "label", "w")})
    assert secret_scan.scan(clashing, none).count() == 0
    assert secret_scan.scan(nothing, none).count() == 0
    long = spark.createDataFrame(
        [(None, "x " * 50_000 + "a" * 20, None), (2, None, "p"), (3, "b" * 100_000, "p"), (3, "b" * 100_000, "p")],
        "doc_id long, text string, source string",
    )
    rows = secret_scan.scan(long, none).collect()
    assert len(rows) == 3 and all(r.kept and r.score == 1 for r in rows)


def test_no_python_in_the_plan(spark, sf_dir):
    text = queries.op2_secret_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
