import plain
import pytest
from pyspark.sql import functions as F

from tidewater.llm import queries
from tidewater.llm.decontaminate import find_contamination, keep_uncontaminated


@pytest.fixture
def items(spark):
    rows = [
        (1, "Seven ate nine. Zehn été!"),
        (2, " ".join(f"w{i}" for i in range(15))),
        (2, "beta-gamma"),
        (3, None),
        (4, "...!"),
        (None, "omega"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture
def docs(spark):
    long = " ".join(f"w{i}" for i in range(15))
    rows = [
        (1, "He said: SEVEN  ate\nnine, zehn—no; seven ate nine zehn été"),
        (2, "x" + long + " " + long.replace(" ", ", ") + " tail"),
        (3, None),
        (4, ""),
        (5, "beta gamma BETA\tGamma omega omegas"),
        (5, "beta gamma BETA\tGamma omega omegas"),
        (None, "omega " * 3 + "filler " * 100),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_query_equals_brute_force(spark, sf_dir, texts):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for r in queries.op3_benchmark_decontamination(spark, sf_dir).collect():
        n, hit, names = plain.contamination(texts[r.doc_id], bench)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(names))
        assert r.items_sha256 == plain.sha(",".join(names))
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


@pytest.mark.parametrize("limit", [10**6, 40])
def test_small_cases(docs, items, limit):
    bench = [(r.item_id, r.text) for r in items.collect()]
    rows = find_contamination(docs, items, automaton_bytes=limit).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, hit, names = plain.contamination(r.text, bench)
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, names)
    found = {r.doc_id: r for r in rows}
    assert [r.text[s.start : s.end] for r in [found[1]] for s in r.spans] == ["seven ate nine zehn été"]
    assert found[2].n_hit == 29 and not found[None].contaminated and found[5].contaminated
    assert found[3].n_words == 0 and not found[3].contaminated


def test_stage_keeps_clean_rows(docs, items):
    clashing = docs.withColumns({c: F.lit("x") for c in ("n_words", "spans", "contaminated", "_scan", "doc")})
    kept = keep_uncontaminated(clashing, items)
    assert kept.columns == clashing.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "None"]
    assert kept.filter("spans = 'x' and n_words = 'x'").count() == 3


def test_empty_tables(docs, items):
    assert find_contamination(docs.limit(0), items).count() == 0
    assert find_contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0


def test_odd_rows(odd, items):
    assert find_contamination(odd, items).filter("not contaminated").count() == odd.count()
