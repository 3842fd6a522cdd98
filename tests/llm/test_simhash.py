import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tidewater.llm import queries, simhash
from tidewater.llm.components import connected_components


def groups(pairs):
    found = {}
    for node, root in pairs:
        found.setdefault(root, set()).add(node)
    return sorted(map(sorted, found.values()))


def test_query_equals_brute_force(spark, sf_dir, texts):
    rows = queries.op4_simhash_near_dedup(spark, sf_dir).collect()
    prints = {i: plain.fingerprint(t) for i, t in texts.items()}
    expected = plain.components(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", expected[i]) for i in texts
    }


@pytest.fixture
def clouds():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1500, dtype=np.int64).view(np.uint64)
    chains = [base[:200]]
    for _ in range(5):
        a, b = (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64) for _ in range(2))
        chains.append(chains[-1] ^ (a | b))
    dense = base[0] ^ rng.integers(0, 64, 300).astype(np.uint64)
    return np.unique(np.concatenate([base, *chains, dense]))


def linked(points, edges):
    root = {int(x): int(x) for x in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(int(a))] = find(int(b))
    return groups((x, find(x)) for x in root)


def all_links(points, bits=2):
    return [
        (points[i], points[j])
        for i in range(len(points))
        for j in np.flatnonzero(np.bitwise_count(points[:i] ^ points[i]) <= bits)
    ]


def test_search_in_a_shard_loses_no_link(clouds):
    assert linked(clouds, simhash.near_edges(clouds, 2)) == linked(clouds, all_links(clouds))


@pytest.mark.parametrize("shard_rows, task_rows", [(20_000, 100_000), (150, 100_000), (150, 120)])
def test_shards_lose_no_link(spark, clouds, monkeypatch, shard_rows, task_rows):
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(simhash, "TASK_ROWS", task_rows)
    df = spark.createDataFrame([(int(x),) for x in clouds.view(np.int64)], "fp long")
    edges = simhash.link_edges(df, 2).collect()
    found = [tuple(np.array([r.u, r.v], np.int64).view(np.uint64)) for r in edges]
    assert linked(clouds, found) == linked(clouds, all_links(clouds))
    assert len(found) < 20 * len(clouds)


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200), (-5, 3)]
    df = spark.createDataFrame(path, "u long, v long")
    rows = {r.node: r.root for r in connected_components(df).collect()}
    assert rows == {**{i: -5 for i in range(41)}, -5: -5, 100: 100, 101: 100, 200: 200}
    assert connected_components(df.limit(0)).count() == 0


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(odd).collect()]
    assert len(rows) == odd.count()
    found = {i: (fp, c) for i, fp, c in rows}
    assert {i: found[i] for i in (3, 4, 6)} == {i: (0, 3) for i in (3, 4, 6)}
    assert found[7] == found[8] and found[8][1] == 7 and found[None][1] is None
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_first(nothing).count() == 0


def test_one_document_of_each_group_stays(odd, spark):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(kept.select("doc_id").collect(), key=str) == sorted(
        [(1,), (2,), (3,), (5,), (7,), (None,), (9,)], key=str
    )
    twins = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (4, "x y"), (4, "x  y")], "doc_id long, text string")
    assert simhash.keep_first(twins).count() == 2


def test_columns_without_an_order(odd):
    wide = odd.withColumn("m", F.create_map(F.lit("a"), F.col("n_chars"))).withColumn("b", F.array(F.lit(b"x")))
    again = wide.unionByName(wide)
    kept = simhash.keep_first(again)
    assert kept.columns == again.columns and kept.count() == simhash.keep_first(odd).count()


def test_clashing_columns(odd):
    clashing = odd.withColumns({c: F.lit("x") for c in ("fp", "doc", "root", "least", "component_id", "_doc", "version")})
    assert simhash.near_duplicates(clashing).count() == odd.count()
    kept = simhash.keep_first(clashing)
    assert kept.columns == clashing.columns and kept.filter("fp = 'x' and _doc = 'x'").count() == 7


def test_short_texts_are_one_shingle():
    assert simhash._fingerprint(b"Two words", 3) == plain.fingerprint("two words")
    assert simhash._fingerprint(b"", 3) == 0
