import random
from collections import defaultdict

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tidewater.llm import minhash, queries


def shingles(text, width=5):
    w = plain.words((text or "").translate(plain.LOWER))
    return {" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def expected(rows, percent=85):
    """(shingles, least reachable id) per row of (id, text), by comparing all pairs of texts."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                shared[j] += 1
            holders[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = defaultdict(lambda: minhash.LAST_ID)
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], minhash.LAST_ID if doc is None else doc)
    known = [least[find(i)] for i in range(len(rows))]
    return [(len(s), None if c == minhash.LAST_ID else c) for s, c in zip(sets, known)]


def check(df, rows, **options):
    found = minhash.near_duplicates(df, **options).collect()
    wanted = [(d, n, c, d == c) for (d, _), (n, c) in zip(rows, expected(rows))]
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, wanted))
    return wanted


def test_query_equals_brute_force(spark, sf_dir, texts):
    rows = queries.op11_minhash_near_dedup(spark, sf_dir).collect()
    ids = sorted(texts)
    wanted = expected([(i, texts[i]) for i in ids])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(zip(ids, wanted))
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def near_copies(seed, groups=12, copies=25):
    """Texts of random words with a few words replaced, dropped or added, many near the limit."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 12, 60, 150, 400]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 40)):
                k = rng.randrange(len(text))
                text[k : k + rng.randrange(2)] = [f"v{rng.randrange(5000)}"] * rng.randrange(2)
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bin_rows, shingles, pairs", [(50_000, 2_000_000, 1 << 18), (200, 700, 64)])
def test_near_copies(spark, monkeypatch, bin_rows, shingles, pairs):
    monkeypatch.setattr(minhash, "BIN_ROWS", bin_rows)
    monkeypatch.setattr(minhash, "BIN_SHINGLES", shingles)
    monkeypatch.setattr(minhash, "PAIRS", pairs)
    rows = near_copies(3)
    wanted = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert 12 < len({c for _, _, c, _ in wanted}) < len(rows) / 2


def test_chains_without_a_common_hub(spark):
    """Each text links with the next only, and the ids are in no order of the chain."""
    words = [f"w{i}" for i in range(1000)]
    rng = random.Random(5)
    ids = rng.sample(range(1000), 80)
    rows = [(doc, " ".join(words[5 * i : 5 * i + 100])) for i, doc in enumerate(ids)]
    wanted = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert {c for _, _, c, _ in wanted} == {min(ids)}


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(2)
    signs = rng.integers(0, 1 << 16, (400, minhash.SYMBOLS), dtype=np.uint16)
    other = signs.copy()
    for row in other:
        row[rng.choice(minhash.SYMBOLS, minhash.MAX_DISTANCE, replace=False)] ^= 7
    same = minhash.chunk_keys(signs) == minhash.chunk_keys(other)
    assert same.any(axis=1).all()
    assert (minhash.first_shared_key(signs == other) == same.argmax(axis=1)).all()
    # One more symbol and pairs may share none.
    other[:, :] = signs
    other.reshape(-1, minhash.CHUNKS, minhash.CHUNK)[:, :, :2] ^= 1
    assert not (minhash.chunk_keys(signs) == minhash.chunk_keys(other)).any()


def test_each_pair_is_given_once():
    rng = np.random.default_rng(4)
    sign = np.repeat(rng.integers(0, 1 << 16, (1, minhash.SYMBOLS), dtype=np.uint16), 60, axis=0)
    for row in sign:
        row[rng.choice(minhash.SYMBOLS, 4, replace=False)] = 1
    keys = minhash.chunk_keys(sign)
    node = np.repeat(np.arange(60), minhash.KEYS)
    order = np.argsort(keys.ravel(), kind="stable")
    group = {"key": keys.ravel().view(np.int64)[order]}
    order = order[np.argsort(group["key"], kind="stable")]
    node = node[order]
    group = {"key": keys.ravel().view(np.int64)[order], "comp": node, "n": np.full(len(node), 9), "sign": sign[node]}
    found = [tuple(sorted(p)) for i, j, _ in minhash.near_pairs(group, 85) for p in zip(node[i].tolist(), node[j].tolist())]
    wanted = {(a, b) for a in range(60) for b in range(a) if (sign[a] != sign[b]).sum() <= minhash.MAX_DISTANCE}
    assert len(found) == len(set(found)) and set(found) == {(b, a) for a, b in wanted}


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    wide = odd.withColumns({c: F.lit("x") for c in ("n", "h1", "node", "doc", "version", "kept", "component_id", "set")})
    wide = wide.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    found = minhash.near_duplicates(wide).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == sorted(
        (str(d), n, str(c)) for (d, _), (n, c) in zip(rows, expected(rows))
    )
    assert {r.doc_id: r.kept for r in found if r.doc_id is not None} == {i: i != 8 for i in range(1, 10)}
    assert minhash.near_duplicates(nothing).count() == 0


def test_ids_with_several_texts(spark):
    rows = [(1, "a b c d e f g"), (1, "p q r s t u v"), (2, "P Q R  S T U V"), (None, "a b c d e f g"), (3, "A b")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in found) == [
        ("1", 1, True), ("1", 1, True), ("2", 1, False), ("3", 3, True), ("None", 1, False)
    ]
