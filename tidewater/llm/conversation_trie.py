"""The trie of conversation prefixes: who shares which first turns, and what sharing them saves.

A node is a distinct sequence of first turns, named by a digest. Conversations are dealt to shards
in pieces of a bounded number of turns. A shard enumerates the digests of its rows, gives each a
slot of a minimal perfect hash table, scatters its rows' values into flat arrays by slot, and adds
them up through an array of parent slots, deepest first. The shards' sums for a digest are added.
Every value belongs to one conversation's turn, so a node that lies in many shards counts once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewater.llm.common import in_small_batches, record
from tidewater.sources.checkpoint import settled

BLOCK = 1024  # turns that are numbered and summed together
SHARD_ROWS = 100_000
ENDS_BYTES = 1 << 16  # of a list of ids, in one row
_BITS = 50  # of each half of a digest: a block's sum of halves fits a bigint
_HALF = 1 << _BITS
_LONG = T.LongType()
NODE = ["d1", "d2", "depth"]


def _numbered(rows: DataFrame, order: list[Column], block: Column) -> DataFrame:
    """``rows`` with ``pos``, their place in the conversation from 1, numbered block by block."""
    blocked = rows.withColumn("block", block)
    sizes = blocked.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("conv", "block", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("conv", "block").orderBy(*order))
    placed = blocked.withColumn("pos", within.cast("bigint")).join(sizes, ["conv", "block"])
    return placed.withColumn("pos", F.col("pos") + F.col("before")).drop("block", "before")


def read_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, s1, s2, bytes): each turn by a digest of its role and text, and its text's size.

    Turns are ordered by their number, missing ones first, then by role and text; null roles and
    texts are empty. Rows without a conversation id belong to none.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        said.alias("said"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    block = F.floor(F.coalesce("turn", F.lit(-(1 << 62))) / BLOCK)
    placed = _numbered(rows, [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")], block)
    part = lambda start: F.conv(F.substring("said", start, 15), 16, 10).cast("bigint")
    return placed.select("conv", "pos", part(1).alias("s1"), part(16).alias("s2"), "bytes")


def branched(turns: DataFrame, every: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(conv) and the turns of conversations rebuilt on others' beginnings.

    Conversation c begins with the first h turns of conversation c - c % ``every`` (all if it has
    fewer, none if it is absent), h being the checksum of its id modulo ``heads``; its own turns
    after its first h follow. The remainder has the sign of c, as in SQL.
    """
    convs = settled(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(heads))
    source = F.col("conv") - F.expr(f"conv % {int(every)}")
    plan = convs.select("conv", h.alias("h"), source.alias("source"))
    lengths = convs.select(F.col("conv").alias("source"), F.col("n").alias("held"))
    plan = plan.join(lengths, "source", "left")
    plan = settled(plan.withColumn("taken", F.least("h", F.coalesce("held", F.lit(0)))))
    own = turns.join(plan, "conv").filter("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    firsts = turns.filter(F.col("pos") < heads).withColumnRenamed("conv", "source")
    begun = firsts.join(plan, "source").filter("pos <= h")
    columns = ["conv", "pos", "s1", "s2", "bytes"]
    return convs.select("conv"), begun.select(columns).unionByName(own.select(columns))


def _paths(turns: DataFrame) -> DataFrame:
    """A row per turn: the digests of the sequence up to it and up to the turn before.

    A sequence's digest adds up its turns' hashes, each taken with its place; sums need no order,
    so a long conversation is summed block by block.
    """
    turns = turns.withColumn("seg", F.floor((F.col("pos") - 1) / BLOCK))
    half = lambda k: F.xxhash64("pos", "s1", "s2", F.lit(k)).bitwiseAND(_HALF - 1)
    turns = turns.withColumns({"e1": half(1), "e2": half(2)})
    sums = turns.groupBy("conv", "seg").agg(
        *[F.pmod(F.sum(e), F.lit(_HALF)).cast("decimal(38,0)").alias(e) for e in ("e1", "e2")],
        F.count(F.lit(1)).alias("rows"),
    )
    whole = W.partitionBy("conv")
    earlier = whole.orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    offset = lambda e: F.pmod(F.coalesce(F.sum(e).over(earlier), F.lit(0)), F.lit(_HALF)).cast("bigint")
    sums = sums.select(
        "conv", "seg", offset("e1").alias("o1"), offset("e2").alias("o2"), F.sum("rows").over(whole).alias("length")
    )
    running = W.partitionBy("conv", "seg").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    summed = turns.withColumns({"r1": F.sum("e1").over(running), "r2": F.sum("e2").over(running)})
    digests = summed.join(sums, ["conv", "seg"]).withColumns(
        {f"d{k}": F.pmod(F.col(f"o{k}") + F.col(f"r{k}"), F.lit(_HALF)) for k in (1, 2)}
    )
    return digests.select(
        "conv",
        "seg",
        F.col("pos").alias("depth"),
        "d1",
        "d2",
        F.pmod(F.col("d1") - F.col("e1"), F.lit(_HALF)).alias("p1"),
        F.pmod(F.col("d2") - F.col("e2"), F.lit(_HALF)).alias("p2"),
        "bytes",
        (F.col("pos") == F.col("length")).alias("last"),
    )


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class SlotTable:
    """A minimal perfect hash of distinct rows of integers: n rows have the slots 0 to n - 1.

    Rows are hashed into an array twice as long as they are many. Those alone in their cell get
    the next slots; the others are hashed anew, by another seed. A slot keeps its row, so a row
    that was never stored is found out.
    """

    def __init__(self, rows: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = np.empty_like(rows)
        left, filled = rows, 0
        while len(left):
            cells = self._cells(left, len(self.levels), 2 * len(left))
            alone = np.bincount(cells, minlength=2 * len(left)) == 1
            slots = filled + np.cumsum(alone) - 1
            self.levels.append((alone, slots))
            placed = alone[cells]
            self.rows[slots[cells[placed]]] = left[placed]
            filled += int(placed.sum())
            left = left[~placed]

    @staticmethod
    def _cells(rows: np.ndarray, seed: int, size: int) -> np.ndarray:
        state = np.full(len(rows), np.uint64(seed + 1))
        for column in rows.T:
            state = _mixed(state ^ column.astype(np.uint64)) * np.uint64(0x94D049BB133111EB) + np.uint64(1)
        return (_mixed(state) % np.uint64(size)).astype(np.int64)

    def slots(self, rows: np.ndarray) -> np.ndarray:
        """The slot of each row, -1 for rows that are not in the table."""
        found = np.full(len(rows), -1, np.int64)
        left = np.arange(len(rows))
        for level, (alone, slots) in enumerate(self.levels):
            cells = self._cells(rows[left], level, len(alone))
            hit = alone[cells]
            found[left[hit]] = slots[cells[hit]]
            left = left[~hit]
        known = np.flatnonzero(found >= 0)
        wrong = (self.rows[found[known]] != rows[known]).any(axis=1)
        found[known[wrong]] = -1
        return found


def subtree_sums(
    nodes: np.ndarray, parents: np.ndarray, values: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(distinct nodes, sums of values over each one's subtree); the last column of nodes is depth.

    ``nodes``, ``parents`` and ``values`` have a row per value. The root, all zeros, is always a
    node; a parent that is no row's node itself is outside, and nothing is added to it.
    """
    table = SlotTable(np.unique(np.concatenate([nodes, np.zeros((1, nodes.shape[1]), np.int64)]), axis=0))
    at = table.slots(nodes)
    sums = np.zeros((len(table.rows), values.shape[1]), np.int64)
    np.add.at(sums, at, values)
    parent = np.full(len(table.rows), -1, np.int64)
    parent[at] = table.slots(parents)
    order = np.argsort(-table.rows[:, -1], kind="stable")
    depths = -table.rows[order, -1]
    edges = np.flatnonzero(np.concatenate(([True], depths[1:] != depths[:-1], [True])))
    for start, end in zip(edges[:-1], edges[1:]):
        level = order[start:end]
        level = level[parent[level] >= 0]
        np.add.at(sums, parent[level], sums[level])
    return table.rows, sums


_SUMS = record(d1=_LONG, d2=_LONG, depth=_LONG, leaves=_LONG, saved=_LONG)
_SHARD = ["d1", "d2", "depth", "p1", "p2", "up", "leaf", "value"]


def _shard_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    col = {c: x.to_numpy() for c, x in zip(_SHARD, pa.Table.from_batches(batches).select(_SHARD).columns)}
    stacked = lambda *names: np.stack([col[c] for c in names], axis=1)
    nodes, parents = stacked("d1", "d2", "depth"), stacked("p1", "p2", "up")
    rows, sums = subtree_sums(nodes, parents, stacked("leaf", "value"))
    held = [*rows.T, *sums.T]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=_SUMS.names)


def _sums(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """(d1, d2, depth, leaves, saved): the sums over each node's subtree.

    ``saved`` adds up (members - 1) times bytes: every member's turn adds its bytes but the one of
    the node's first conversation, which also counts the node if it has no children.
    """
    owner = nodes.select(*NODE, "conv", (F.col("n_children") == 0).cast("bigint").alias("childless"))
    owned = paths.join(owner, [*NODE, "conv"], "left").select(
        "conv",
        "seg",
        *NODE,
        "p1",
        "p2",
        F.coalesce("childless", F.lit(0)).cast("bigint").alias("leaf"),
        F.when(F.col("childless").isNull(), F.col("bytes")).otherwise(0).cast("bigint").alias("value"),
    )
    owned = settled(owned)
    # What the later pieces of a conversation hold is added to the last turn of each piece.
    later = W.partitionBy("conv").orderBy(F.desc("seg")).rowsBetween(W.unboundedPreceding, -1)
    pieces = owned.groupBy("conv", "seg").agg(
        F.sum("leaf").alias("leaf"), F.sum("value").alias("value"), F.max("depth").alias("depth")
    )
    carried = pieces.select(
        "conv",
        "seg",
        "depth",
        F.sum("leaf").over(later).alias("more_leaf"),
        F.sum("value").over(later).alias("more_value"),
    ).filter(F.col("more_leaf").isNotNull())
    more = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
    rows = owned.count()
    shard = F.pmod(F.xxhash64("conv", "seg"), F.lit(-(-rows // SHARD_ROWS) or 1))
    # A piece's first turn has no parent in any shard: the piece before counts it already.
    inside = (F.col("seg") == 0) | (F.col("depth") > F.col("seg") * BLOCK + 1)
    up = F.when(inside, F.col("depth") - 1).otherwise(-1).cast("bigint")
    dealt = owned.join(carried, ["conv", "seg", "depth"], "left").select(
        shard.alias("shard"), *NODE, "p1", "p2", up.alias("up"), more("leaf"), more("value")
    )
    parts = dealt.groupBy("shard").applyInArrow(_shard_sums, _SUMS)
    return parts.groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """(d1, d2, depth, ends_sha256): the ids (conv) that end at a node, ascending, comma-joined.

    Sorted ids are joined to pieces of text wherever they lie; a node's pieces then pass one task
    in order, piece by piece.
    """
    kind = record(d1=_LONG, d2=_LONG, depth=_LONG, first=_LONG, ids=T.StringType())

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [np.asarray(batch[c]) for c in (*NODE, "conv")]
            if not len(cols[0]):
                continue
            fresh = np.any([x[1:] != x[:-1] for x in cols[:3]], axis=0)
            texts = list(map(str, cols[3].tolist()))
            cuts = np.concatenate(([0], np.flatnonzero(fresh) + 1, [len(texts)])).tolist()
            step = ENDS_BYTES // 20
            spans = [(i, min(i + step, b)) for a, b in zip(cuts, cuts[1:]) for i in range(a, b, step)]
            starts = np.array([a for a, _ in spans])
            held = [pa.array(x[starts]) for x in cols]
            held.append(pa.array([",".join(texts[a:b]) for a, b in spans]))
            yield pa.RecordBatch.from_arrays(held, names=kind.names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*[batch[c].to_pylist() for c in (*NODE, "ids")]):
                if node != now:
                    if now:
                        done.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _rows(done)
        if now:
            yield _rows([(*now, state.hexdigest())])

    def _rows(found: list[tuple]) -> pa.RecordBatch:
        columns = [list(x) for x in zip(*found)] or [[], [], [], []]
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], [*NODE, "ends_sha256"])

    pieces = ends.orderBy(*NODE, "conv").mapInArrow(joined, kind)
    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return ordered.mapInArrow(digests, record(d1=_LONG, d2=_LONG, depth=_LONG, ends_sha256=T.StringType()))


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per node of the trie of the conversations ``convs`` (conv) with turns as read above.

    Columns: conv_id, the least member; depth; parent_conv_id, the parent's conv_id (null for the
    root); n_convs, members; n_children; n_leaves, childless nodes in the subtree, itself
    included; saved_tokens, each node's (members - 1) times the bytes of its last text, summed
    over the subtree; ends_sha256, the digest of the ids that end at the node.

    A conversation without turns is a member of the root. Without conversations there is no node.
    """
    paths = settled(_paths(in_small_batches(turns)))
    found = paths.groupBy(*NODE).agg(
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
    )
    zero = F.lit(0).cast("bigint")
    none = F.lit(None).cast("bigint")
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        zero.alias("d1"), zero.alias("d2"), zero.alias("depth"), "conv", "n_convs", none.alias("p1"), none.alias("p2")
    )
    found = settled(found.unionByName(root))
    children = (
        found.filter("depth > 0")
        .groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = found.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
    nodes = settled(nodes)

    ended = paths.filter("last").select(*NODE, "conv")
    turnless = convs.join(paths.filter("depth = 1").select("conv"), "conv", "left_anti")
    ended = ended.unionByName(turnless.select(zero.alias("d1"), zero.alias("d2"), zero.alias("depth"), "conv"))
    parents = nodes.select(
        F.col("d1").alias("p1"),
        F.col("d2").alias("p2"),
        (F.col("depth") + 1).alias("depth"),
        F.col("conv").alias("parent_conv_id"),
    )
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    childless = F.col("n_children") == 0
    return (
        nodes.join(_sums(paths, nodes), NODE, "left")
        .join(_end_digests(ended), NODE, "left")
        .join(settled(parents), ["p1", "p2", "depth"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.when(childless, 1).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved_tokens"),
            F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, every: int | None = None, heads: int = 9) -> DataFrame:
    """The prefix trie of ``conversations`` (conv_id, turn, role, text), see ``prefix_trie``.

    With ``every`` they are rebuilt first, see ``branched``. Repeated rows are turns of their own,
    and so are rows that share a number; other columns play no part. An empty table, or one whose
    ids are all null, gives an empty table.
    """
    turns = settled(read_turns(conversations))
    if every is None:
        convs = turns.select("conv").distinct()
    else:
        convs, turns = branched(turns, every, heads)
    return prefix_trie(settled(convs), turns)
