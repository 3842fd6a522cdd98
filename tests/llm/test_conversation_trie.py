import random
import zlib
from collections import defaultdict

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tidewater.llm import conversation_trie as trie
from tidewater.llm import queries

FIELDS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def conversations(rows):
    """Turns per conversation, in order, of (conv_id, turn, role, text) rows."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in held.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        source = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(source, [])[:h] + own[h:]
    return out


def nodes(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        saved[path] = own + sum(saved[x] for x in children[path])
        out.append((
            min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]),
            len(children[path]), leaves[path], saved[path], plain.sha(",".join(map(str, sorted(ends[path])))),
        ))
    return out


def found(df):
    return sorted(map(str, (tuple(r[c] for c in FIELDS) for r in df.collect())))


def test_query_equals_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    wanted = nodes(rebuilt(conversations(rows)))
    assert found(queries.op12_conversation_trie(spark, sf_dir)) == sorted(map(str, wanted))
    assert any(n[3] > 1 and n[1] > 1 for n in wanted)


def tree(seed):
    """Conversations over few texts, some very long, with numbers missing and repeated."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-20, 300), 90):
        for turn in range(rng.choice([1, 2, 3, 6, 9, 12])):
            number = None if rng.random() < 0.1 else turn
            rows.append((conv, number, rng.choice(["user", None]), rng.choice(["", "a", "é" * 9, None])))
    for conv in (301, 302, 305):
        rows += [(conv, t, "user", f"turn {t}" if t < 70 or conv != 305 else "other") for t in range(100)]
    rows += [(c, 0, "user", "one turn for all") for c in range(400, 460)]
    return rows


@pytest.mark.parametrize("block, shard_rows, ends", [(1024, 100_000, 1 << 16), (7, 50, 60)])
@pytest.mark.parametrize("every", [None, 5])
def test_trees(spark, monkeypatch, block, shard_rows, ends, every):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(trie, "ENDS_BYTES", ends)
    rows = tree(block)
    given = conversations(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    wanted = nodes(rebuilt(given) if every else given)
    assert found(trie.conversation_trie(df, every=every)) == sorted(map(str, wanted))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_slots_are_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    rows = np.unique(rng.integers(-50, 50, (n, 3)), axis=0)
    table = trie.SlotTable(rows)
    slots = table.slots(rows)
    assert sorted(slots.tolist()) == list(range(len(rows))) and (table.rows[slots] == rows).all()
    assert (table.slots(rows + 1000) == -1).all()


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [
        (None, 0, "user", "nobody"), (6, 0, None, None), (7, 0, "", ""), (7, 0, "", ""),
        (8, None, "user", "long " * 50_000), (8, 1, "a:b", "c"), (9, 1, "a", "b:c"), (10, 1, "user", "x\nuser\n"),
    ]
    df = spark.createDataFrame(rows, schema)
    wide = df.withColumns({c: F.lit("x") for c in ("conv", "pos", "depth", "n_convs", "d1", "seg", "block", "h")})
    wide = wide.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    for every in (None, 5):
        given = conversations(rows)
        wanted = nodes(rebuilt(given) if every else given)
        assert found(trie.conversation_trie(wide, every=every)) == sorted(map(str, wanted))
        assert trie.conversation_trie(df.filter("conv_id IS NULL"), every=every).count() == 0
