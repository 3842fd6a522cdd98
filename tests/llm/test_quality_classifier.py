import numpy as np
import plain
from pyspark.sql import functions as F

from tidewater.llm import queries
from tidewater.llm import quality_classifier as qc


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = queries.op1_quality_classifier(spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == plain.held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = np.array([s for s, y in tested if y])
    bad = np.array([s for s, y in tested if not y])
    assert len(good) > 30 and len(bad) > 3
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert np.mean([(s >= 0.3) == y for s, y in tested]) > 0.95


def test_labels_of_the_held_out_fold_are_not_read(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    spoiled = labels.withColumn("quality", F.when(qc.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (qc.training_matrix(documents, x.filter(~qc.held_out())) for x in (labels, spoiled))
    assert all(np.array_equal(p, q) for p, q in zip(a, b)) and len(a[0]) > 0


def test_pairs_learn_what_single_tables_cannot():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (2000, 3))
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)
    model = qc.fit_model(x, y)
    assert (0, 1) in model.pairs
    assert np.mean((model.scores(x) > 0.5) == y) > 0.9


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + 0.2 * rng.normal(size=400) > 0).astype(float)
    model = qc.fit_model(x, y)
    for row in x[:20]:
        total = model.start
        for i, table in enumerate(model.tables):
            total += table[sum(row[i] >= c for c in model.cuts[i])]
        for (i, j), table in zip(model.pairs, model.pair_tables):
            total += table[sum(row[i] >= c for c in model.pair_cuts[i]), sum(row[j] >= c for c in model.pair_cuts[j])]
        assert np.isclose(1 / (1 + np.exp(-total)), model.scores(row[None])[0])


def test_degenerate_labels():
    none = qc.fit_model(np.zeros((0, 13)), np.zeros(0))
    assert np.allclose(none.scores(np.zeros((2, 13))), 0.5)
    one = qc.fit_model(np.random.default_rng(2).normal(size=(50, 13)), np.ones(50))
    assert (one.scores(np.zeros((1, 13))) > 0.9).all()
    same = qc.fit_model(np.zeros((40, 13)), np.arange(40) % 2.0)
    assert np.allclose(same.scores(np.zeros((1, 13))), 0.5, atol=0.05)


def test_odd_rows(odd, nothing, spark):
    labels = [(1, 1), (1, 1), (2, 0), (None, 1), (5, None), (7, 1), (7, 0), (99, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    x, y = qc.training_matrix(odd, labels)
    assert len(x) == 3 and sorted(y) == [0, 1, 1] and np.isfinite(x).all()
    model = qc.fit_model(x, y)
    clashing = odd.withColumns({c: F.lit("x") for c in ("score", "predicted", "_score", "raw")})
    rows = qc.classify(clashing, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    assert qc.classify(nothing, model).count() == 0
    assert len(qc.training_matrix(nothing, labels)[0]) == 0


def test_sample_is_bounded(documents, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert len(qc.training_matrix(documents, labels, rows=20)[0]) <= 20
