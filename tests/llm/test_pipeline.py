"""The pipeline against a plain version of its stages, applied one after the other."""

import hashlib

import corpus_pipeline
import plain
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidewater.llm import queries, quality_rules


def test_stages(spark, sf_dir):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_run_equals_plain_stages(spark, sf_dir, documents, texts):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    # The robust verdict has its own brute-force test; all other stages are worked out here.
    kept = {r.doc_id for r in quality_rules.assess(documents).filter("kept").collect()}
    left = {i: t for i, (_, _, t) in plain.shared_lines({i: texts[i] for i in kept}).items()}
    least = plain.components({i: plain.fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if least[i] == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for i in list(left):
        n, hit, _ = plain.contamination(left[i], bench)
        if hit and 20 * hit >= n:
            del left[i]
    model = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    assert {r.doc_id: r["ids"] for r in rows} == {i: model.encode(t, add_eos=True) for i, t in left.items()}
    for r in rows:
        assert r.agrees and r.n_tokens == len(r["ids"])
        assert r.decoded_sha256 == hashlib.sha256(model.decode(r["ids"]).encode()).hexdigest()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_return_the_columns_they_took(spark, sf_dir, odd, nothing, stage):
    clashing = odd.withColumns({c: F.lit("x") for c in ("kept", "n_lines", "spans", "items", "ids", "component_id")})
    for docs in (clashing, nothing):
        out = stage[1](spark, docs, sf_dir)
        assert out.schema == docs.schema or out.dtypes == docs.dtypes
        assert out.count() <= docs.count()
    assert stage[1](spark, clashing, sf_dir).filter("kept = 'x' and n_lines = 'x'").count() >= 1


def test_all_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
