import math

import numpy as np
import plain
from pyspark.sql import functions as F

from tidewater.llm import quality_rules, queries


def test_counts_equal_brute_force(spark, sf_dir, texts):
    rows = queries.op7_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *rest = expected = plain.counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (n < 10 or 100 * rest[-1] > 20 * n)
        assert not (r.base_failed and r.kept)


def test_labelled_quality(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")
    judged = queries.op7_quality_rules(spark, sf_dir.replace("sf0.001", "sf0.01")).join(labels, "doc_id")
    good, kept_good, bad, kept_bad = judged.filter("not base_failed").agg(
        *[F.count_if(F.expr(c)) for c in ("quality = 1", "quality = 1 and kept", "quality = 0", "quality = 0 and kept")]
    ).first()
    assert kept_good == good and kept_bad < bad


def plain_mcd(x, floors):
    """Concentration steps over sorted distances, with the operator's start, floors and scales."""
    p = x.shape[1]
    r = np.round(x * 64) / 64
    center = np.median(r, axis=0)
    spread = np.maximum(1.4826 * np.median(np.abs(r - center), axis=0), floors)
    precision = np.diag(spread**-2.0)

    def floored(cov):
        values, vectors = np.linalg.eigh(cov / np.outer(floors, floors))
        return (vectors * np.maximum(values, 1)) @ vectors.T * np.outer(floors, floors)

    def distances():
        d = x - center
        return np.einsum("ni,ij,nj->n", d, precision, d)

    share = quality_rules.COVERAGE
    scale = share / quality_rules.chi2_share(p + 2, quality_rules.chi2_quantile(p, share))
    for _ in range(quality_rules.STEPS):
        inner = x[np.argsort(distances())[: math.ceil(share * len(x))]]
        center = inner.mean(axis=0)
        precision = np.linalg.inv(floored(np.cov(inner.T, bias=True) * scale))
    limit = quality_rules.chi2_quantile(p, quality_rules.REWEIGHT)
    inner = x[distances() <= limit]
    center = inner.mean(axis=0)
    scale = quality_rules.REWEIGHT / quality_rules.chi2_share(p + 2, limit)
    return center, np.linalg.inv(floored(np.cov(inner.T, bias=True) * scale))


def test_estimate_resists_outliers_and_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    clean = rng.multivariate_normal([1, 2, 3], [[2, 1, 0], [1, 2, 0.5], [0, 0.5, 1]], 1600)
    foul = rng.normal([12, -9, 20], 0.4, (300, 3))
    x = np.concatenate([clean, foul])
    names, floors = ("a", "b", "c"), (0.1, 0.1, 0.1)
    rows = [("g", *map(float, row)) for row in x] + [("h", *map(float, row + 5)) for row in clean]
    df = spark.createDataFrame(rows, "grp string, a double, b double, c double")
    found = {r.grp: r for r in quality_rules.fit_outliers(df, names, floors).collect()}
    assert found["g"].n == 1900 and found["h"].n == 1600
    for grp, points in (("g", x), ("h", clean + 5)):
        center, precision = plain_mcd(points, np.array(floors))
        # Bins of distance add at most the rows of one bin to the concentrated share.
        assert np.allclose(found[grp].center, center, atol=0.05)
        assert np.allclose(np.array(found[grp].precision).reshape(3, 3), precision, atol=0.1)
    assert np.abs(np.array(found["g"].center) - [1, 2, 3]).max() < 0.2


def test_a_third_of_equal_outliers_is_rejected(spark):
    rng = np.random.default_rng(5)
    clean = rng.normal(0, 1, (600, 7))
    x = np.concatenate([clean, np.tile([40.0, -40, 30, 30, -30, 40, 40], (300, 1))])
    names = tuple("abcdefg")
    rows = [("g", *map(float, row)) for row in x]
    df = spark.createDataFrame(rows, "grp string, " + ", ".join(f"{c} double" for c in names))
    (r,) = quality_rules.fit_outliers(df, names, (0.1,) * 7).collect()
    d = x - np.array(r.center)
    far = np.einsum("ni,ij,nj->n", d, np.array(r.precision).reshape(7, 7), d) > quality_rules.chi2_quantile(
        7, quality_rules.CUTOFF
    )
    assert far[600:].all() and far[:600].mean() < 0.01
    assert np.abs(r.center).max() < 0.2


def test_chi_square():
    # From published tables.
    for p, share, value in ((1, 0.95, 3.8415), (5, 0.975, 12.8325), (10, 0.99, 23.2093)):
        assert abs(quality_rules.chi2_quantile(p, share) - value) < 1e-3


def test_odd_rows(odd, nothing):
    rows = quality_rules.assess(odd).collect()
    assert len(rows) == odd.count()
    found = {r.doc_id: r for r in rows}
    for i in (3, 4, 6):
        assert found[i].n_words == 0 and found[i].base_failed and not found[i].kept
    assert found[5].n_words == 120_000 and found[None].n_words == 9
    assert quality_rules.assess(nothing).count() == 0 and quality_rules.keep_clean(nothing).count() == 0


def test_small_groups_take_a_wider_estimate(documents):
    counted = quality_rules.with_counts(documents, "s")
    found = quality_rules.fit(counted, "s").collect()
    assert all(len(r.center) == len(quality_rules.FEATURES) for r in found)


def counted_rows(rng, source, n, words, symbols):
    """Rows (lang, source, counts) of texts of one kind."""
    out = []
    for _ in range(n):
        w = int(words * rng.lognormal(0, 0.2))
        c = (w, int(5 * w * rng.normal(1, 0.03)), int(w * symbols * rng.lognormal(0, 0.2)), 0, 0)
        out.append(("en", source, (*c, 10, w // 5, w // 6)))
    return out


def test_a_small_source_has_its_own_estimate(spark):
    rng = np.random.default_rng(4)
    prose, tables = counted_rows(rng, "prose", 1500, 300, 0.0), counted_rows(rng, "tables", 200, 60, 3.0)
    schema = "lang string, source string, s struct<" + ", ".join(
        f"{c}: long" for c in quality_rules._COUNTED.names
    ) + ">"
    found = {}
    for n in (150, 199, 200):
        strays = [("en", "tables", c) for _, _, c in prose[:5]]
        df = spark.createDataFrame(prose + tables[: n - 5] + strays, schema)
        estimates = quality_rules.fit(df, "s").collect()
        (found[n],) = [r for r in estimates if "tables" in r.grp]
        judged = quality_rules.judge(df, "s", spark.createDataFrame(estimates)).filter("source = 'tables'")
        tabular = F.col("s.n_symbols") > 0
        good, strays_kept = judged.agg(
            F.count_if(F.col("kept") & tabular), F.count_if(F.col("kept") & ~tabular)
        ).first()
        assert good >= 0.98 * (n - 5) and strays_kept == 0
    assert np.abs(np.subtract(found[199].center, found[200].center)).max() < 0.05


def test_clashing_columns(odd):
    clashing = odd.withColumns({c: F.lit("x") for c in ("kept", "distance", "base_failed", "n_words", "_counts", "grp")})
    kept = quality_rules.keep_clean(clashing)
    assert kept.columns == clashing.columns
    assert {r.kept for r in kept.collect()} <= {"x"}
    assert quality_rules.assess(clashing).filter("n_words = 120000").count() == 1


def test_texts_are_counted_once_where_they_are_judged(odd):
    kept = quality_rules.keep_clean(odd)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    passed = {r.doc_id for r in quality_rules.assess(odd).filter("kept").collect()}
    assert passed and {r.doc_id for r in kept.collect()} == passed
