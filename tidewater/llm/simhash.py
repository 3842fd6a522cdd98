"""SimHash near-dedup: fingerprints of word shingles, linked through vantage points.

Distances from a few vantage points cut the fingerprints into shards. By the triangle inequality
two fingerprints within ``bits`` of each other differ by at most ``bits`` in their distance from
any vantage point, so a fingerprint just outside a cut is also sent to the inner side, and every
link lies whole in some shard. A shard is searched by the same cuts once more, down to small
leaves that are compared pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewater.llm.common import (
    LAST_ID,
    LOWER,
    free_names,
    id_of,
    in_small_batches,
    raw_text,
    record,
    text_of,
    trimmed,
)
from tidewater.llm.components import connected_components
from tidewater.sources.checkpoint import settled

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SAMPLE = 4096  # fingerprints that the vantage points and cuts are chosen by
CANDIDATES = 48  # vantage points tried for each cut
SHARD_ROWS = 20_000  # rows that a shard is meant to hold
TASK_ROWS = 100_000  # a larger shard is searched in several tasks
LEAF = 256


def _fingerprint(raw: bytes, width: int) -> int:
    words = raw.translate(LOWER).split()
    if not words:
        return 0
    text = b" ".join(words)
    n = len(words) - width + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(text, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(text[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())])
    # Big-endian digests: the first bit of a row is the highest.
    rows = np.frombuffer(hashed, np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 255):
        ones += np.add.reduce(np.unpackbits(rows[i : i + 255], axis=1), axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_of(text_col: str = "text", width: int = SHINGLE_WORDS) -> Column:
    """The text's fingerprint as a bigint (its 64 bits), 0 for a text without words or null."""

    @F.arrow_udf(T.LongType())
    @trimmed
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = (_fingerprint(raw.as_py(), width) for raw in batch)
            yield pa.array(np.fromiter(found, np.uint64, len(batch)).view(np.int64))

    return fingerprints(raw_text(text_col))


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def choose_cuts(sample: np.ndarray, rows: int, bits: int) -> list[tuple[int, int]]:
    """Vantage points with the radius of their cut, for ``rows`` fingerprints like the sample's.

    Each cut is the one, of some candidates, that leaves the smallest sum of squared shard sizes
    with the fingerprints counted on both sides that have to go to both. A cut that does not
    lower the sum is not made.
    """
    cuts: list[tuple[int, int]] = []
    wanted = max(0, math.ceil(math.log2(max(rows, 1) / SHARD_ROWS)))
    owner = np.arange(len(sample))
    code = np.zeros(len(sample), np.int64)
    cost = float(len(sample)) ** 2
    for level in range(wanted):
        best = None
        for vantage in sample[level * CANDIDATES : (level + 1) * CANDIDATES]:
            d = distance(sample, vantage)[owner]
            for radius in {int(np.quantile(d, q)) for q in (0.3, 0.4, 0.5, 0.6, 0.7)}:
                outer = d > radius
                both = outer & (d <= radius + bits)
                codes = np.concatenate([2 * code + outer, 2 * code[both]])
                _, sizes = np.unique(codes, return_counts=True)
                total = float((sizes.astype(np.float64) ** 2).sum())
                if best is None or total < best[0]:
                    best = total, int(vantage), radius, codes, np.concatenate([owner, owner[both]])
        if best is None or best[0] > 0.95 * cost:
            break
        cost, vantage, radius, code, owner = best
        cuts.append((vantage, radius))
    return cuts


def _routes(cuts: list[tuple[int, int]], bits: int):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.asarray(batch["fp"]).view(np.uint64)
            shard = np.zeros(len(points), np.int64)
            for vantage, radius in cuts:
                d = distance(points, np.uint64(vantage))
                outer = d > radius
                both = outer & (d <= radius + bits)
                shard = np.concatenate([2 * shard + outer, 2 * shard[both]])
                points = np.concatenate([points, points[both]])
            yield pa.RecordBatch.from_pydict({"shard": shard, "fp": points.view(np.int64)})

    return route


def _forest(a: np.ndarray, b: np.ndarray | None, bits: int) -> list[tuple[int, int]]:
    """Edges that join what links within a, or between a and b, by direct comparison."""
    other = a if b is None else b
    near = np.bitwise_count(a[:, None] ^ other[None, :]) <= bits
    if b is None:
        np.fill_diagonal(near, False)
    rows, columns = np.nonzero(near)
    if not len(rows):
        return []
    # Breadth first from each unseen row, so that a dense block gives a tree and not all pairs.
    n = len(a)
    edges, seen_a, seen_b = [], np.zeros(n, bool), np.zeros(len(other), bool)
    if b is None:
        seen_b = seen_a
    for start in np.unique(rows):
        if seen_a[start]:
            continue
        seen_a[start] = True
        left = [start]
        while left:
            i = left.pop()
            fresh = np.flatnonzero(near[i] & ~seen_b)
            seen_b[fresh] = True
            edges += [(int(a[i]), int(other[j])) for j in fresh]
            if b is None:
                left.extend(fresh)
                continue
            for j in fresh:
                back = np.flatnonzero(near[:, j] & ~seen_a)
                seen_a[back] = True
                edges += [(int(a[k]), int(other[j])) for k in back]
                left.extend(back)
    return edges


def near_edges(points: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges with the same components as all links within ``bits`` among distinct ``points``.

    A set is cut at a distance from one of its points; inner and outer part are searched by
    themselves, and only the two bands along the cut against each other.
    """
    edges: list[tuple[int, int]] = []
    todo: list[tuple[np.ndarray, np.ndarray | None]] = [(points, None)]
    while todo:
        a, b = todo.pop()
        if not len(a) or (b is not None and not len(b)):
            continue
        if (len(a) if b is None else max(len(a), len(b))) <= LEAF:
            edges += _forest(a, b, bits)
            continue
        pool = a if b is None or len(a) >= len(b) else b
        vantage = pool[len(pool) // 2]
        da = distance(a, vantage)
        db = da if b is None else distance(b, vantage)
        radius = int(np.median(da if pool is a else db))
        for radius in (radius, radius - 1):
            ina, inb = da <= radius, db <= radius
            if ina.any() and not ina.all() or b is not None and inb.any() and not inb.all():
                break
        else:  # all at one distance: halves by position
            half_a, half_b = len(a) // 2, 0 if b is None else len(b) // 2
            parts_a = [x for x in (a[:half_a], a[half_a:]) if len(x)]
            if b is None:
                todo += [(x, None) for x in parts_a] + [(parts_a[0], parts_a[1])]
            else:
                parts_b = [x for x in (b[:half_b], b[half_b:]) if len(x)]
                todo += [(x, y) for x in parts_a for y in parts_b]
            continue
        band_a = a[ina & (da > radius - bits)], a[~ina & (da <= radius + bits)]
        if b is None:
            todo += [(a[ina], None), (a[~ina], None), band_a]
        else:
            band_b = b[inb & (db > radius - bits)], b[~inb & (db <= radius + bits)]
            todo += [(a[ina], b[inb]), (a[~ina], b[~inb])]
            todo += [(band_a[0], band_b[1]), (band_a[1], band_b[0])]
    return edges


def link_edges(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) with the components of all links among the distinct bigints in ``fp``.

    The cuts are chosen by a sample of at most ``SAMPLE`` fingerprints. Their number grows with
    the table, so that a shard keeps its size; every fingerprint is routed and searched. A shard
    beyond ``TASK_ROWS`` rows is dealt into blocks, and each task searches two of them, so no
    task holds more than a bounded number of rows.
    """
    rows = prints.count()
    sampled = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r.fp for r in sampled], np.int64).view(np.uint64)
    cuts = choose_cuts(sample, rows, bits)
    routed = prints.mapInArrow(_routes(cuts, bits), record(shard=T.LongType(), fp=T.LongType()))
    routed = settled(routed)

    sizes = routed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    blocks = sizes.select("shard", F.ceil(2 * F.col("n") / TASK_ROWS).cast("int").alias("k"))
    blocks = blocks.withColumn("k", F.when(F.col("k") > 2, F.col("k")).otherwise(1))
    own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    dealt = routed.join(settled(blocks), "shard").select(
        "shard", "fp", "k", own.alias("block"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("with")
    )
    # Two blocks make a task; a block meets itself in every task that holds it.
    tasks = dealt.filter((F.col("k") == 1) | (F.col("block") != F.col("with"))).select(
        "shard",
        F.least("block", "with").alias("one"),
        F.greatest("block", "with").alias("two"),
        "fp",
    )

    def search(group: pa.Table) -> pa.Table:
        points = np.unique(group["fp"].to_numpy()).view(np.uint64)
        edges = np.array(near_edges(points, bits), np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"u": edges[:, 0].copy(), "v": edges[:, 1].copy()})

    return tasks.groupBy("shard", "one", "two").applyInArrow(
        search, record(u=T.LongType(), v=T.LongType())
    )


def _grouped(docs: DataFrame, width: int, bits: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, doc_id, version, fp, root, least) for every row; root names the component."""
    prints = settled(
        in_small_batches(docs).select(
            id_of(id_col).alias("doc"),
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text_of(text_col)).alias("version"),
            fingerprint_of(text_col, width).alias("fp"),
        )
    )
    distinct = settled(prints.groupBy("fp").agg(F.min("doc").alias("least")))
    roots = connected_components(link_edges(distinct.select("fp"), bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = settled(rooted.select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = settled(rooted.groupBy("root").agg(F.min("least").alias("least")))
    members = settled(rooted.drop("least").join(least, "root"))
    return prints.join(members, "fp")


def near_duplicates(
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id) for every row: its fingerprint and its component's least id.

    Documents whose fingerprints differ in at most ``bits`` bits are linked, and so are those
    that are linked through others. Equal fingerprints meet as one before any search, so copies
    cost nothing. Texts shorter than a shingle are one shingle; texts without words, null ones
    too, have fingerprint 0 and are linked like others. A null id counts after all others and
    comes out as null. Rows that repeat come out as often. Other columns play no part. An empty
    table gives an empty table.
    """
    found = _grouped(docs, width, bits, id_col, text_col)
    known = F.when(F.col("least") != LAST_ID, F.col("least"))
    return found.select("doc_id", "fp", known.alias("component_id"))


def keep_first(
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of ``docs`` per component: one with the least id, unchanged.

    Where rows with that id have several texts, the one with the least text hash stays; of rows
    with one id and text, the one whose other columns come first when written as JSON.
    """
    found = _grouped(docs, width, bits, id_col, text_col).filter(F.col("doc") == F.col("least"))
    firsts = found.groupBy("root", "doc").agg(F.min("version").alias("version"))
    doc, version, place = free_names(docs, "_doc", "_version", "_place")
    kept = settled(firsts.select(F.col("doc").alias(doc), F.col("version").alias(version)))
    # Written out, since columns such as maps have no order of their own.
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    order = F.to_json(F.struct(*others)) if others else F.lit(0)
    same = W.partitionBy(doc, version).orderBy(order)
    return (
        docs.withColumns({doc: id_of(id_col), version: F.xxhash64(text_of(text_col))})
        .join(kept, [doc, version], "left_semi")
        .withColumn(place, F.row_number().over(same))
        .filter(F.col(place) == 1)
        .select(*docs.columns)
    )
