import random
import zlib
from collections import Counter, defaultdict

import plain
import pytest
from pyspark.sql import functions as F

from tidewater.llm import queries, sharding


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 64, 65, 300])
def test_jump_hash(spark, shards):
    rng = random.Random(2)
    keys = [0, 1, -1, 2**63 - 1, -(2**63)] + [rng.randint(-(2**63), 2**63 - 1) for _ in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    rows = df.select("k", sharding.jump_hash(F.col("k"), shards).alias("s")).collect()
    assert [r.s for r in rows] == [plain.jump(r.k, shards) for r in rows]


def test_query(spark, sf_dir, texts):
    rows = queries.op5_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows_and_buckets(odd, nothing, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 1)
    clashing = odd.withColumns({c: F.lit("x") for c in ("shard", "size", "_bucket", "n")})
    rows = sharding.shard_rows(clashing, 3).collect()
    assert len(rows) == odd.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    found = {r.doc_id: r for r in rows}
    assert found[3]["size"] == 1 and found[3].text_crc32 == 0 and found[7]._bucket == "x"
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1
    assert sharding.shard_rows(nothing, 3).count() == 0


def test_hot_id_gets_gapless_slots(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    df = spark.range(300).select(F.when(F.col("id") < 200, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.shard_rows(df, 4).collect()
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_no_python_in_the_plan(spark, sf_dir):
    text = queries.op5_sharding(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_shards_must_be_positive():
    with pytest.raises(ValueError):
        sharding.jump_hash(None, 0)
