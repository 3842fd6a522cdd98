import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tidewater.llm import queries, spelling


def word_counts(rows, least=7, every=31):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(plain.LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def grouped(counts, ratio=10):
    """{word: (n, n_near, form, form_n, root)}, near words found by leaving out each letter."""
    cut = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            cut[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            near[w] |= cut[w[:i], w[i + 1 :]] - {w}
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = n, len(near[w]), form.get(w), counts.get(form.get(w)), root
    return out


def found(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark, sf_dir, texts):
    rows = found(queries.op13_spelling_variants(spark, sf_dir))
    assert rows == grouped(word_counts(texts.items()))
    assert any(form for _, _, form, _, _ in rows.values())


@pytest.mark.parametrize("symbols, lot, carried", [(4, 32, 48), (2, 3, 9), (6, 1, 7)])
def test_dense_vocabulary(spark, monkeypatch, symbols, lot, carried):
    """Few letters, so that most words have near words; short and long words meet at the border."""
    monkeypatch.setattr(spelling, "CLASS_WORDS", lot)
    monkeypatch.setattr(spelling, "CARRIED", carried)
    rng = random.Random(symbols)
    counts = {"".join(rng.choices("abéÿ", k=rng.randrange(7, 12))): rng.choice([2, 3, 25, 400, 6000]) for _ in range(500)}
    base = "".join(rng.choices("abcdefgh", k=300))
    for i in range(5):
        counts[base[:i * 50] + "x" + base[i * 50 :]] = 10 ** (i + 1)
    counts[base] = 2
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(spelling.spelling_variants(df, symbols=symbols)) == grouped(counts)


@pytest.mark.parametrize("symbols", [2, 4])
@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_neighbourhoods_are_full(monkeypatch, symbols, piece):
    monkeypatch.setattr(spelling, "PIECE", piece)
    rng = np.random.default_rng(symbols)
    chars = rng.integers(1, symbols + 1, (30, 6)).astype(np.uint64)
    keys = defaultdict(list)
    for rows, found in spelling.neighbours(chars, symbols):
        for r, k in zip(rows.tolist(), found.tolist()):
            keys[r].append(k)
    for r, row in enumerate(chars.tolist()):
        wanted = set()
        for i in range(len(row) + 1):
            for c in range(1, symbols + 1):
                wanted |= {tuple(row[:i] + [c] + row[i:]), tuple(row[:i] + [c] + row[i + 1 :])}
            wanted.add(tuple(row[:i] + row[i + 1 :]))
        wanted.discard(tuple(row))
        hashed = [int(spelling.keys_of(np.array([w], np.uint64))[0]) for w in wanted]
        assert sorted(keys[r]) == sorted(hashed)


def test_chains_lead_to_the_last_form(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20_000, "zbcdefg": 19}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = found(spelling.spelling_variants(df))
    assert rows == grouped(counts) and rows["abcdefg"][-1] == "abcdefghijk"
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, ratio=1)


def test_odd_rows(spark, odd, nothing):
    long = "letters" * 3000
    more = [(20, f"{long} {long}x", "en", "s", 1), (None, f"{long}×÷ {long}x, ÀÉàéÿÿÿ ÀÉàéÿÿÿ Naïvely", None, None, None)]
    rows = odd.unionByName(spark.createDataFrame(more, odd.schema))
    wide = rows.withColumns({c: F.lit("x") for c in ("id", "raw", "word", "n", "key", "root")})
    wide = wide.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    counts = word_counts([(r.doc_id, r.text) for r in rows.collect()])
    assert long + "x" in counts
    assert found(spelling.group_variants(wide, slip_every=31)) == grouped(counts)
    plainly = word_counts([(r.doc_id, r.text) for r in rows.collect()], every=None)
    assert {r.word: r.n for r in spelling.count_words(rows).collect()} == plainly
    assert spelling.group_variants(nothing).count() == 0
