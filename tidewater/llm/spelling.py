"""Spelling variants: words that differ by one edit, and the frequent form that each belongs to.

Every letter is hashed to one of a few symbols. Words within one edit have reduced words within
one edit, so the full one-edit neighbourhoods of the reduced words, joined with the reduced
vocabulary, lose no pair; the pairs that they give are verified on the words themselves. Of two
reduced words only the one of lesser key looks for the other, so each pair is found once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewater.llm.common import LOWER, in_small_batches, raw_text, record
from tidewater.sources.checkpoint import delete_folder, new_folder, settled, stored

LETTERS = "A-Za-zÀ-ÿ"
SYMBOLS = 4  # of the reduced alphabet
CLASS_WORDS = 32  # words of one reduced word that travel together
CARRIED = 48  # longer words travel as a reference, since a neighbourhood has a row for every place
PIECE = 1 << 20  # neighbours that are made at once

_LONG, _TEXT = T.LongType(), T.StringType()
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_BASE = np.uint64(_BASE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def reduced(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """(words, letters) symbols from 1 up, for words of one length."""
    table = np.array([1 + zlib.crc32(bytes([c])) % symbols for c in range(256)], np.uint64)
    held = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return table[held].reshape(len(words), -1)


def _sums(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and for every place what the letters before it add to the hash."""
    length = chars.shape[1]
    powers = np.full(length + 2, _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    before = np.zeros((len(chars), length + 1), np.uint64)
    np.cumsum(chars * powers[length - 1 :: -1][:length], axis=1, out=before[:, 1:])
    return powers, before


def keys_of(chars: np.ndarray) -> np.ndarray:
    return _mixed(_sums(chars)[1][:, -1].copy())


def neighbours(chars: np.ndarray, symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of every distinct string within one edit of a row, the row itself not among them.

    A letter of a run is dropped at the run's end only, and added before the run only, so that
    no string comes twice.
    """
    count, length = chars.shape
    powers, before = _sums(chars)
    whole = before[:, -1:]
    wide = max(1, PIECE // max(1, count))

    def told(ok: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, places = np.nonzero(ok)
        return rows, _mixed(hashes[rows, places])

    for i in range(0, length + 1, wide):
        to = min(i + wide, length)
        here, ahead = chars[:, i:to], before[:, i:to]
        if to > i:
            last = np.ones((count, to - i), bool)
            nexts = chars[:, i + 1 : to + 1]
            last[:, : nexts.shape[1]] = here[:, : nexts.shape[1]] != nexts
            yield told(last, ahead * _INVERSE + (whole - before[:, i + 1 : to + 1]))
        gap = before[:, i : i + wide]
        gap_powers = powers[length - np.arange(i, i + gap.shape[1])]
        previous = np.zeros(gap.shape, np.uint64)
        previous[:, 1 if i == 0 else 0 :] = chars[:, max(i - 1, 0) : i - 1 + gap.shape[1]]
        for c in range(1, symbols + 1):
            symbol = np.uint64(c)
            if to > i:
                yield told(here != symbol, whole + (symbol - here) * powers[length - 1 - np.arange(i, to)])
            yield told(previous != symbol, gap * _BASE + symbol * gap_powers + (whole - gap))


def count_words(
    docs: DataFrame,
    min_chars: int = 7,
    min_count: int = 2,
    slip_every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n) for runs of letters, A-Z lowered, of at least ``min_chars`` found ``min_count`` times.

    With ``slip_every`` a run loses a letter, before it is counted, if that number divides the
    checksum of ``<id>:<run>``. A task counts what an Arrow batch holds before any row moves.
    """
    found = re.compile(f"[{LETTERS}]{{{min_chars},}}").findall

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[str] = Counter()
            for doc, raw in zip(batch["id"], batch["raw"]):
                runs = Counter(found(raw.as_py().translate(LOWER).decode("utf-8", "replace")))
                start = zlib.crc32(f"{doc.as_py()}:".encode())
                for run, n in runs.items():
                    if slip_every:
                        check = zlib.crc32(run.encode(), start)
                        if check % slip_every == 0:
                            place = check % len(run)
                            run = run[:place] + run[place + 1 :]
                            if len(run) < min_chars:
                                continue
                    total[run] += n
            names = pa.array(total.keys(), pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(total.values(), pa.int64())], ["word", "n"])

    ids = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id")
    parts = in_small_batches(docs.select(ids, raw_text(text_col).alias("raw")))
    counts = parts.mapInArrow(counted, record(word=_TEXT, n=_LONG)).groupBy("word")
    return counts.agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _keyed(symbols: int):
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _by_length(batch["word"].to_pylist()):
                words = [w for _, w in group]
                key = keys_of(reduced(words, symbols))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(words, pa.string())], ["key", "word"])

    return keyed


def _by_length(words: list[str]) -> Iterator[list[tuple[int, str]]]:
    found: dict[int, list[tuple[int, str]]] = {}
    for i, word in enumerate(words):
        found.setdefault(len(word), []).append((i, word))
    # Very long words go alone, so that a table of their letters stays small.
    for length, group in found.items():
        step = max(1, PIECE // length)
        yield from (group[i : i + step] for i in range(0, len(group), step))


def _around(symbols: int):
    """Rows with the key of every reduced word near that of a row's first word, itself included."""

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, own = batch["carried"], np.asarray(batch["key"])
            firsts = [w.partition(" ")[0] for w in batch["first"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], held, pa.array([True] * len(own))], ["key", "held", "same"])
            for group in _by_length(firsts):
                places = np.array([i for i, _ in group])
                for rows, keys in neighbours(reduced([w for _, w in group], symbols), symbols):
                    at = places[rows]
                    above = keys > own[at]
                    keys, at = keys[above], at[above]
                    for i in range(0, len(at), 1 << 16):
                        part = slice(i, i + (1 << 16))
                        carried = held.take(pa.array(at[part]))
                        flags = pa.array(np.zeros(len(carried), bool))
                        yield pa.RecordBatch.from_arrays([pa.array(keys[part]), carried, flags], ["key", "held", "same"])

    return around


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(a, b): every pair of words that one inserted, deleted or replaced code point tells apart, once.

    ``words`` has distinct words of letters up to U+00FF in ``word``. Words of one reduced word
    travel together, in lots of ``CLASS_WORDS``, so no row grows with the vocabulary; a key with
    many lots is an ordinary join key, which Spark splits.
    """
    keyed = settled(words.select("word").mapInArrow(_keyed(symbols), record(key=_LONG, word=_TEXT)))
    near = (F.levenshtein("a", "b", 1) == 1) & (~F.col("same") | (F.col("a") < F.col("b")))

    order = W.partitionBy("key").orderBy("word")
    lots = (
        keyed.filter(F.length("word") <= CARRIED)
        .withColumn("lot", F.floor((F.row_number().over(order) - 1) / CLASS_WORDS))
        .groupBy("key", "lot")
        .agg(F.array_join(F.collect_list("word"), " ").alias("words"))
    )
    lots = settled(lots.select("key", "words"))
    kind = record(key=_LONG, held=_TEXT, same=T.BooleanType())
    sent = lots.select("key", F.col("words").alias("carried"), F.col("words").alias("first"))
    met = in_small_batches(sent).mapInArrow(_around(symbols), kind).join(lots, "key")
    short = (
        met.select("same", "words", F.explode(F.split("held", " ")).alias("a"))
        .select("same", "a", F.explode(F.split("words", " ")).alias("b"))
        .filter(near)
        .select("a", "b")
    )

    long = keyed.filter(F.length("word") >= CARRIED)
    named = settled(long.withColumn("name", F.xxhash64("word").cast("string")))
    sent = named.select("key", F.col("name").alias("carried"), F.col("word").alias("first"))
    met = in_small_batches(sent).mapInArrow(_around(symbols), kind).join(named.select("key", "name"), "key")
    long = (
        met.join(named.select(F.col("name").alias("held"), F.col("word").alias("a")), "held")
        .join(named.select("name", F.col("word").alias("b")), "name")
        .filter(near & (F.greatest(F.length("a"), F.length("b")) > CARRIED))
        .select("a", "b")
    )
    return short.unionByName(long)


def spelling_variants(words: DataFrame, ratio: int = 10, symbols: int = SYMBOLS) -> DataFrame:
    """``words`` (word, n) with n_near, form, form_n and root.

    ``n_near`` counts a word's near words. Its form is the near word of largest n, of several the
    least in code-point order, if that n reaches ``ratio`` times the word's own; else null, as is
    ``form_n``, the form's n. ``root`` is the last word that forms lead to, the word itself if
    none. A form is ``ratio`` times as frequent as its word, so chains have few steps; they are
    followed by doubling. Ratios of 1 and less are an error. No words give no rows.
    """
    if ratio <= 1:
        raise ValueError("Forms lead to an end only if each is more frequent than the one before")
    words = settled(words.select("word", "n"))
    pairs = settled(near_words(words, symbols))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    best = both.join(counts, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("order"), F.col("b").alias("form"))).alias("best"),
    )
    reached = -F.col("best.order") >= ratio * F.col("n")
    formed = settled(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(reached, F.col("best.form")).alias("form"),
            F.when(reached, -F.col("best.order")).alias("form_n"),
        )
    )

    spark, folder, step = words.sparkSession, new_folder(words.sparkSession, "forms"), 0
    up = stored(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), f"{folder}/0")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if up.join(further, "root", "left_semi").isEmpty():
            break
        ahead = up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        up = stored(ahead, f"{folder}/{step + 1}")
        delete_folder(spark, f"{folder}/{step}")
        step += 1
    roots = settled(up)
    delete_folder(spark, folder)
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(docs: DataFrame, ratio: int = 10, symbols: int = SYMBOLS, **counting) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for the words of all texts; see the parts above.

    Null and empty texts have no words; a null id counts as an empty one. Repeated rows count
    again. Other columns play no part, whatever they hold. Long runs of letters are words like
    others. An empty table gives an empty table.
    """
    return spelling_variants(count_words(docs, **counting), ratio, symbols)
