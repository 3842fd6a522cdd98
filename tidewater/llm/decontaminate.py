"""Benchmark decontamination: one Aho-Corasick automaton scans every text for benchmark windows.

Items and texts are normalised to lowered words with single spaces. Every window of an item is a
pattern, bounded by spaces, so that a match always is a run of whole words. The automaton reads a
normalised text once; matches are mapped back to words and to places in the original text.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import (
    LOWER,
    free_names,
    id_of,
    in_small_batches,
    put_aside,
    raw_text,
    record,
    text_of,
    trimmed,
)
from tidewater.sources.checkpoint import settled

WINDOW = 13
MIN_SHARE = 20  # a text is contaminated if one word in so many is hit
# Bytes of patterns in one automaton, which takes some 50 bytes for each. More patterns than
# that are dealt over several automata, each of which scans all texts.
AUTOMATON_BYTES = 6_000_000

# Every byte that is neither a digit, a letter nor part of a character beyond ASCII is a space.
_NORMAL = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).isalpha() else 32 for b in LOWER
)

_SPAN = record(
    first_word=T.IntegerType(), last_word=T.IntegerType(), start=T.IntegerType(), end=T.IntegerType()
)
_SCAN = record(
    n_words=T.LongType(), spans=T.ArrayType(_SPAN), items=T.ArrayType(T.StringType())
)

_PLACES = pa.struct([(name, pa.int32()) for name in _SPAN.names])
_SCANNED = pa.struct(
    [("n_words", pa.int64()), ("spans", pa.list_(_PLACES)), ("items", pa.list_(pa.string()))]
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_NORMAL).split()


def windows_of(items: DataFrame, width: int, item_col: str, text_col: str) -> DataFrame:
    """(window, item): every distinct window of every item; an item without words has none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows, names = [], []
            for item, raw in zip(batch["item"].to_pylist(), batch["raw"].to_pylist()):
                words = words_of(raw)
                places = max(1, len(words) - width + 1) if words else 0
                windows += [b" ".join(words[i : i + width]) for i in range(places)]
                names += [item] * places
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.binary()), pa.array(names, pa.string())], names=["window", "item"]
            )

    texts = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        raw_text(text_col).alias("raw"),
    )
    return texts.mapInArrow(cut, record(window=T.BinaryType(), item=T.StringType())).distinct()


def _automaton(patterns: list[tuple[bytes, list[str]]]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    if not patterns:
        patterns = [(b"", [])]  # an automaton needs a word; two spaces never meet in a text
    for window, items in patterns:
        # One character per byte, so that places in the pattern are places in the bytes.
        key = f" {window.decode('latin-1')} "
        found.add_word(key, (len(key), items))
    found.make_automaton()
    return found


def _merged(pairs: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words that overlap or touch become one."""
    out: list[list[int]] = []
    for first, last in sorted(pairs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _scan(raw: bytes, automaton: ahocorasick.Automaton) -> tuple[int, list[dict], list[str]]:
    words = words_of(raw)
    if not words:
        return 0, [], []
    normal = b" " + b" ".join(words) + b" "
    matches = list(automaton.iter(normal.decode("latin-1")))
    if not matches:
        return len(words), [], []
    # The space before word i is at before[i]; a match ends on the space behind its last word.
    before = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
    ends = np.searchsorted(before, [end for end, _ in matches]) - 1
    starts = np.searchsorted(before, [end - size + 1 for end, (size, _) in matches])
    runs = _merged(set(zip(starts.tolist(), ends.tolist())))
    # Byte places of the words in the original, and from bytes to characters.
    letters = np.frombuffer(raw.translate(_NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], letters.view(np.int8), [0]))))
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    spans = [
        {
            "first_word": a,
            "last_word": b,
            "start": int(chars[edges[2 * a]]),
            "end": int(chars[edges[2 * b + 1]]),
        }
        for a, b in runs
    ]
    items = sorted({item for _, (_, held) in matches for item in held})
    return len(words), spans, items


def _scanner(patterns: Broadcast):
    @F.arrow_udf(_SCAN)
    @trimmed
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton(patterns.value)
        for batch in batches:
            rows = (_scan(raw.as_py(), automaton) for raw in batch)
            yield pa.array([dict(zip(_SCAN.names, row)) for row in rows], _SCANNED)

    return scan


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = WINDOW,
    min_share: int = MIN_SHARE,
    automaton_bytes: int = AUTOMATON_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans``, ``items``, ``n_hit`` and ``contaminated``.

    Words are runs of ASCII digits and letters, A-Z lowered, and of characters beyond ASCII. A
    window is ``width`` consecutive words of an item; an item with fewer words is one window. A
    word inside any occurrence of a window is hit. ``spans`` holds the maximal runs of hit words,
    as word numbers (both included) and as character places in the original text (end excluded).
    ``items`` names the items with occurring windows. A text is contaminated if a word is hit and
    one in ``min_share`` at least.

    Null and empty texts have no words and no hits; items without words have no window; a null
    item id counts as an empty name, and items that repeat an id count as one. Rows that repeat
    come out as often. Output names replace input columns, all others are kept. With no items
    nothing is hit; an empty table gives an empty table.

    The patterns of one automaton are broadcast; their size is measured first. Where they exceed
    ``automaton_bytes``, several automata scan all texts one after the other, and their spans are
    joined by document.
    """
    docs = in_small_batches(docs)
    windows = settled(
        windows_of(items, width, item_col, item_text_col)
        .groupBy("window")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    size = windows.agg(F.sum(F.length("window") + 2)).first()[0] or 0
    blocks = max(1, -(-size // automaton_bytes))
    (s,) = free_names(docs, "_scan")

    def block(k: int) -> list[tuple[bytes, list[str]]]:
        rows = windows if blocks == 1 else windows.filter(
            F.pmod(F.xxhash64("window"), F.lit(blocks)) == k
        )
        return [(bytes(r.window), r["items"]) for r in rows.collect()]

    if blocks == 1:
        patterns = docs.sparkSession.sparkContext.broadcast(block(0))
        scanned = docs.withColumn(s, _scanner(patterns)(raw_text(text_col)))
    else:
        scanned = _scanned_in_blocks(docs, [block] * blocks, s, id_col, text_col)
    words = F.aggregate(
        F.col(f"{s}.spans"),
        F.lit(0).cast("bigint"),
        lambda n, x: n + (x["last_word"] - x["first_word"] + 1).cast("bigint"),
    )
    return (
        scanned.withColumns({c: F.col(f"{s}.{c}") for c in _SCAN.names} | {"n_hit": words})
        .withColumn("contaminated", (F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words")))
        .drop(s)
    )


def _joined(spans: Column) -> Column:
    """Spans of several scans in order, those that overlap or touch joined."""

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        touches = (F.size(done) > 0) & (x["first_word"] <= F.try_element_at(done, F.lit(-1))["last_word"] + 1)
        later = F.when(x["last_word"] > last["last_word"], x).otherwise(last)
        joined = F.struct(
            last["first_word"].alias("first_word"),
            later["last_word"].alias("last_word"),
            last["start"].alias("start"),
            later["end"].alias("end"),
        )
        before = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(touches, F.concat(before, F.array(joined))).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(F.array_sort(spans), F.array().cast(T.ArrayType(_SPAN)), add)


def _scanned_in_blocks(docs: DataFrame, blocks: list, s: str, id_col: str, text_col: str) -> DataFrame:
    """Scan with one automaton after the other; the hits of each are kept before the next."""
    sc = docs.sparkSession.sparkContext
    keyed = {"doc": id_of(id_col), "version": F.xxhash64(text_of(text_col))}
    hits = None
    for k, block in enumerate(blocks):
        patterns = sc.broadcast(block(k))
        part = docs.select(
            *[c.alias(name) for name, c in keyed.items()],
            _scanner(patterns)(raw_text(text_col)).alias("scan"),
        )
        part = settled(part.filter(F.size("scan.spans") > 0).distinct())
        patterns.unpersist()
        hits = part if hits is None else hits.unionByName(part)

    doc, version, spans, held = free_names(docs, "_doc", "_version", "_spans", "_held")
    merged = hits.groupBy(F.col("doc").alias(doc), F.col("version").alias(version)).agg(
        _joined(F.flatten(F.collect_list("scan.spans"))).alias(spans),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("scan.items")))).alias(held),
    )
    counted = _scanner(sc.broadcast([]))(raw_text(text_col))["n_words"]
    return (
        docs.withColumns({doc: keyed["doc"], version: keyed["version"], s: counted})
        .join(merged, [doc, version], "left")
        .withColumn(
            s,
            F.struct(
                F.col(s).alias("n_words"),
                F.coalesce(spans, F.array().cast(T.ArrayType(_SPAN))).alias("spans"),
                F.coalesce(held, F.array().cast("array<string>")).alias("items"),
            ),
        )
        .drop(doc, version, spans, held)
    )


def keep_uncontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    aside, restored = put_aside(docs, [*_SCAN.names, "n_hit", "contaminated"])
    found = find_contamination(aside, items, **options)
    return found.filter(~F.col("contaminated")).select(*restored)
