"""MinHash near-dedup: documents whose sets of word shingles overlap, by a multi-index Hamming join.

A set's signature holds ``SYMBOLS`` minima of independent permutations, each cut to 16 bits. The
share of symbols in which two signatures agree estimates the similarity of their sets, so similar
sets have signatures at a small Hamming distance. A signature is split into ``CHUNKS`` chunks. If
two differ in at most ``MAX_DISTANCE`` symbols, some chunk differs in at most ``ERRORS`` of them:
every choice of so many symbols of a chunk is left out once, and what is left is a key. No pair
within the distance escapes, and every pair found is confirmed on the whole sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import LAST_ID, LOWER, id_of, in_small_batches, raw_text, record, text_of
from tidewater.llm.components import connected_components
from tidewater.sources.checkpoint import settled

SHINGLE_WORDS = 5
PERCENT = 85  # of the union, which the intersection has to reach
CHUNKS, CHUNK, ERRORS = 8, 4, 1
SYMBOLS = CHUNKS * CHUNK
# With more differing symbols every chunk may hold more than ERRORS of them.
MAX_DISTANCE = CHUNKS * (ERRORS + 1) - 1
# The symbols of a chunk that stay in each of its keys.
MASKS = [[i for i in range(CHUNK) if i not in out] for out in itertools.combinations(range(CHUNK), ERRORS)]
KEYS = CHUNKS * len(MASKS)
BIN_ROWS = 50_000  # rows of key groups whose signatures one task compares
BIN_SHINGLES = 2_000_000  # shingles of the sets that one task compares
PAIRS = 1 << 18  # pairs that a task compares at once
SPAN = 4096  # shingles that are permuted at once

_rng = np.random.default_rng(11)
_FACTORS = _rng.integers(1, 1 << 62, SHINGLE_WORDS, dtype=np.int64).astype(np.uint64) * 2 + 1
_FLIPS = _rng.integers(0, 1 << 63, (SYMBOLS, 1), dtype=np.int64).astype(np.uint64)
_TURNS = _rng.integers(1, 1 << 62, (SYMBOLS, 1), dtype=np.int64).astype(np.uint64) * 2 + 1
_FOLD = _rng.integers(1, 1 << 62, CHUNK, dtype=np.int64).astype(np.uint64) * 2 + 1
_LONG, _BYTES = T.LongType(), T.BinaryType()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit spread over all output bits; distinct inputs stay distinct."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(raw: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct shingles, the same on every machine."""
    words = raw.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64)
    digest = xxhash.xxh64_digest
    hashed = np.frombuffer(b"".join([digest(w) for w in words]), ">u8").astype(np.uint64)
    n = len(words) - width + 1
    factors = np.resize(_FACTORS, width)
    found = np.zeros(n, np.uint64)
    for i in range(width):  # each place has a state of its own, so order counts
        found = _mixed(found ^ hashed[i : i + n]) * factors[i]
    found.sort()
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The symbols of a set that is not empty."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), SPAN):
        least = np.minimum(least, ((shingles[i : i + SPAN] ^ _FLIPS) * _TURNS).min(axis=1))
    return (least & np.uint64(0xFFFF)).astype(np.uint16)


def _describe(width: int):
    """A column function: size, 128-bit digest and signature of a text's set."""
    kind = record(n=_LONG, h1=_LONG, h2=_LONG, sig=_BYTES)

    @F.arrow_udf(kind)
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            digests = np.zeros((len(batch), 2), np.uint64)
            signs = []
            for i, raw in enumerate(batch):
                found = shingle_set(raw.as_py(), width)
                n[i] = len(found)
                if len(found):
                    whole = xxhash.xxh3_128_intdigest(found.tobytes())
                    digests[i] = whole >> 64, whole & (1 << 64) - 1
                    signs.append(signature(found).tobytes())
                else:
                    signs.append(b"")
            h1, h2 = (digests[:, k].copy().view(np.int64) for k in (0, 1))
            yield pa.StructArray.from_arrays(
                [pa.array(n), pa.array(h1), pa.array(h2), pa.array(signs, pa.binary())], names=kind.names
            )

    return describe


def _symbols(column: pa.Array) -> np.ndarray:
    held = b"".join(x.as_py() for x in column)
    return np.frombuffer(held, np.uint16).reshape(-1, SYMBOLS)


def chunk_keys(signs: np.ndarray) -> np.ndarray:
    """(signatures, KEYS) keys; the low bits of a key are its number, so numbers never meet."""
    chunks = signs.reshape(-1, CHUNKS, CHUNK).astype(np.uint64) + np.uint64(1)
    found = np.empty((len(signs), CHUNKS, len(MASKS)), np.uint64)
    for m, left in enumerate(MASKS):
        state = np.zeros(chunks.shape[:2], np.uint64)
        for i in left:
            state = _mixed(state ^ chunks[:, :, i]) * _FOLD[i]
        found[:, :, m] = state
    found = found.reshape(len(signs), KEYS)
    bits = np.uint64((KEYS - 1).bit_length())
    return (found >> bits << bits) | np.arange(KEYS, dtype=np.uint64)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = np.asarray(batch["node"])
        for i in range(0, len(nodes), 4096):
            keys = chunk_keys(_symbols(batch["sig"][i : i + 4096]))
            held = np.repeat(nodes[i : i + 4096], KEYS)
            yield pa.RecordBatch.from_pydict({"key": keys.ravel().view(np.int64), "node": held})


def first_shared_key(agree: np.ndarray) -> np.ndarray:
    """The least number of a key that each pair shares; ``agree`` says which symbols do."""
    chunks = agree.reshape(-1, CHUNKS, CHUNK)
    shared = np.stack([chunks[:, :, left].all(axis=2) for left in MASKS], axis=2)
    return shared.reshape(-1, KEYS).argmax(axis=1)


def _long_enough(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar at all."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def near_pairs(group: dict[str, np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows that share a key, lie within the distance and belong to different components.

    ``group`` has key, comp, n and sign, in the order of key. A pair is given, with its distance,
    under the first key that it shares and no other.
    """
    key, comp, n, sign = (group[x] for x in ("key", "comp", "n", "sign"))
    if not len(key):
        return
    ends = np.searchsorted(key, key, side="right")
    partners = ends - np.arange(len(key)) - 1
    # A row with very many partners is taken in several pieces.
    pieces = np.maximum(1, -(-partners // PAIRS))
    row = np.repeat(np.arange(len(key)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = row + 1 + nth * PAIRS
    count = np.clip(ends[row] - start, 0, PAIRS)
    total = np.cumsum(count)
    at = 0
    while at < len(row):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        i = np.repeat(row[at:to], count[at:to])
        before = np.repeat(np.cumsum(count[at:to]) - count[at:to], count[at:to])
        j = np.repeat(start[at:to], count[at:to]) + np.arange(len(i)) - before
        left = (comp[i] != comp[j]) & _long_enough(n[i], n[j], percent)
        i, j = i[left], j[left]
        agree = sign[i] == sign[j]
        number = (key[i].view(np.uint64) & np.uint64((1 << (KEYS - 1).bit_length()) - 1)).astype(np.int64)
        apart = SYMBOLS - agree.sum(axis=1)
        left = (apart <= MAX_DISTANCE) & (first_shared_key(agree) == number)
        yield i[left], j[left], apart[left]
        at = to


def _distances(percent: int):
    """A column function: the distance of two signatures, null where the sizes rule a link out."""

    @F.arrow_udf(T.IntegerType())
    def distances(sig: pa.Array, other: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        apart = (_symbols(sig) != _symbols(other)).sum(axis=1).astype(np.int32)
        return pa.array(apart, mask=~_long_enough(np.asarray(n), np.asarray(m), percent))

    return distances


def _common(found: pa.Array, others: pa.Array) -> pa.Array:
    """Size of the intersection of two ascending sets of 64-bit hashes, given as bytes."""
    sizes = []
    for a, b in zip(found, others):
        a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (a, b))
        a, b = (a, b) if len(a) <= len(b) else (b, a)
        places = np.minimum(np.searchsorted(b, a), len(b) - 1)
        sizes.append(int((b[places] == a).sum()))
    return pa.array(sizes, pa.int64())


def _compared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[tuple]:
    """(table, columns, i, j, distance): the near pairs of a task, as rows of its table."""
    group = pa.Table.from_batches(batches)
    group = group.take(np.argsort(np.asarray(group["key"]), kind="stable"))
    col = {c: np.asarray(group[c]) for c in ("key", "node", "comp", "n", "block")}
    col["sign"] = _symbols(group["sig"].combine_chunks())
    one, two, k = (group[c][0].as_py() for c in ("one", "two", "k"))
    for i, j, apart in near_pairs(col, percent):
        if k > 1:
            # Pairs within block b belong to the task of b and b + 1, in the last one both.
            b, c = col["block"][i], col["block"][j]
            own = (b != c) | ((two == one + 1) & ((b == one) | (two == k - 1)))
            i, j, apart = i[own], j[own], apart[own]
        yield group, col, i, j, apart


def _near_nodes(percent: int):
    """A task function: the classes that are near one of another component."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, col, i, j, _ in _compared(batches, percent):
            yield pa.RecordBatch.from_pydict({"node": np.unique(col["node"][np.concatenate((i, j))])})

    return search


def _similar(i: np.ndarray, j: np.ndarray, set_of, percent: int) -> np.ndarray:
    """Whether the whole sets of each pair of rows are similar; ``i`` never falls."""
    found = np.zeros(len(i), bool)
    edges = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1], [True]))) if len(i) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        own = set_of(int(i[a]))
        for x in range(a, b, 256):
            others = [set_of(int(r)) for r in j[x : min(x + 256, b)]]
            sizes = np.array([len(o) for o in others])
            every = np.concatenate(others)
            places = np.minimum(np.searchsorted(own, every), len(own) - 1)
            both = np.add.reduceat(own[places] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
            found[x : x + len(others)] = 100 * both >= percent * (len(own) + sizes - both)
    return found


def _links(percent: int):
    """A task function: edges that join what whole sets link, no more than the components joined.

    The nearest pairs are compared first. Pairs that edges of the task have joined meanwhile, and
    components that earlier rounds have, are not compared.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}
        sets: dict[int, np.ndarray] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        for group, col, i, j, apart in _compared(batches, percent):
            nodes, comp, held = col["node"], col["comp"], group["held"]

            def set_of(row: int) -> np.ndarray:
                node = int(nodes[row])
                if node not in sets:
                    sets[node] = np.frombuffer(held[row].as_py(), np.uint64)
                return sets[node]

            for least, most in ((0, 4), (5, 8), (9, SYMBOLS)):
                band = (apart >= least) & (apart <= most)
                x, y = i[band], j[band]
                apart_still = [find(a) != find(b) for a, b in zip(comp[x].tolist(), comp[y].tolist())]
                x, y = x[np.array(apart_still, bool)], y[np.array(apart_still, bool)]
                linked = _similar(x, y, set_of, percent)
                edges = []
                for a, b in zip(x[linked].tolist(), y[linked].tolist()):
                    p, q = find(int(comp[a])), find(int(comp[b]))
                    if p != q:
                        root[p] = q
                        edges.append((int(nodes[a]), int(nodes[b])))
                ends = np.array(edges, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict({"u": ends[:, 0].copy(), "v": ends[:, 1].copy()})

    return search


_DEALT = ["bin", "large", "one", "two"]


def _dealt(rows: DataFrame, weight: str, most: int) -> DataFrame:
    """``rows`` (key, node, ...) dealt to tasks of a bounded weight, groups of a key together.

    Small groups share a task. A group beyond the bound is dealt into blocks, and each task gets two
    of them.
    """
    totals = settled(rows.groupBy("key").agg(F.sum(weight).cast("bigint").alias("total")))
    whole = totals.agg(F.coalesce(F.sum("total"), F.lit(0).cast("bigint"))).first()[0]
    bins = max(1, -(-whole // most))
    blocks = F.ceil(2 * F.col("total") / most).cast("int")
    split = rows.join(totals, "key").withColumn("k", F.when(blocks > 2, blocks).otherwise(1)).drop("total")
    dealt = split.withColumns(
        {
            "bin": F.when(F.col("k") == 1, F.pmod(F.xxhash64("key"), F.lit(bins))).otherwise(F.col("key")),
            "block": F.pmod(F.xxhash64("node"), F.col("k")).cast("int"),
            "with": F.explode(F.sequence(F.lit(0), F.col("k") - 1)),
        }
    )
    # Pairs within a block are found by its task with the next one.
    return dealt.filter((F.col("k") == 1) | (F.col("block") != F.col("with"))).withColumns(
        {"large": F.col("k") > 1, "one": F.least("block", "with"), "two": F.greatest("block", "with")}
    )


class _Join:
    """The classes of equal sets of some documents, and how their links are found and confirmed."""

    def __init__(self, docs: DataFrame, rows: DataFrame, width: int, percent: int, text_col: str, id_col: str):
        self.percent = percent
        counted = rows.filter("n > 0").groupBy("h1", "h2")
        merged = counted.agg(
            F.min(F.struct("doc", "version")).alias("rep"), F.min("n").alias("n"), F.min("sig").alias("sig")
        )
        self.classes = settled(merged.withColumn("node", F.monotonically_increasing_id()))

        @F.arrow_udf(_BYTES)
        def sets(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in texts:
                yield pa.array([shingle_set(x.as_py(), width).tobytes() for x in batch], pa.binary())

        keyed = docs.select(
            id_of(id_col).alias("doc"), F.xxhash64(text_of(text_col)).alias("version"), raw_text(text_col).alias("raw")
        )
        self.texts, self.sets = keyed, sets

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """(node, held): the whole sets of some classes, read from their documents again."""
        chosen = self.classes.join(nodes.distinct(), "node").select("rep.doc", "rep.version", "node")
        # A repeated row gives one set.
        return settled(
            self.texts.join(settled(chosen), ["doc", "version"])
            .select("node", self.sets("raw").alias("held"))
            .groupBy("node")
            .agg(F.first("held").alias("held"))
        )

    def confirmed(self, pairs: DataFrame, held: DataFrame) -> DataFrame:
        """Those of the pairs (u, v) whose whole sets are similar; ``held`` has the sets."""
        one = held.select(F.col("node").alias("u"), F.col("held").alias("a"))
        two = held.select(F.col("node").alias("v"), F.col("held").alias("b"))
        common = F.arrow_udf(_common, _LONG)("a", "b")
        size = lambda c: F.octet_length(c).cast("bigint") / 8
        counted = pairs.join(one, "u").join(two, "v").select(
            "u", "v", common.alias("both"), (size("a") + size("b")).cast("bigint").alias("all")
        )
        return counted.filter(100 * F.col("both") >= self.percent * (F.col("all") - F.col("both"))).select("u", "v")

    def links(self) -> DataFrame:
        """Confirmed edges (u, v) with the components of all links between classes.

        First every class meets the nearest of its key groups' least classes, which joins what
        copies of one text have in common. Then groups that still hold several components are
        searched in full, but for pairs that are joined already: by signatures for the classes
        that are near any other, then by the whole sets of those, which meet in the task.
        """
        percent = self.percent
        keys = settled(self.classes.select("node", "sig").mapInArrow(_keyed, record(key=_LONG, node=_LONG)))
        groups = keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
        groups = settled(groups.filter("hub < last").select("key", "hub"))
        members = settled(keys.join(groups, "key"))
        own = self.classes.select("node", "n", "sig")
        hubs = own.select(F.col("node").alias("hub"), F.col("n").alias("m"), F.col("sig").alias("other"))
        stars = members.filter("node <> hub").select("node", "hub").distinct()
        measured = stars.join(own, "node").join(hubs, "hub").select(
            "node", "hub", _distances(percent)("sig", "other", "n", "m").alias("apart")
        )
        nearest = (
            measured.filter(F.col("apart") <= MAX_DISTANCE)
            .groupBy("node")
            .agg(F.min(F.struct("apart", "hub")).alias("best"))
            .select(F.col("node").alias("u"), F.col("best.hub").alias("v"))
        )
        nearest = settled(nearest)
        ends = nearest.select(F.explode(F.array("u", "v")).alias("node"))
        first = settled(self.confirmed(nearest, self.sets_of(ends)))

        rooted = settled(connected_components(first))
        placed = members.join(rooted, "node", "left").select(
            "key", "node", F.coalesce("root", "node").alias("comp")
        )
        placed = settled(placed)
        mixed = placed.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
        mixed = settled(mixed.filter("least < most").select("key"))
        left = settled(placed.join(mixed, "key"))

        # Most classes of a mixed group are near none of its others: only the rest's sets are read.
        tasks = _dealt(left.withColumn("weight", F.lit(1)), "weight", BIN_ROWS).join(own, "node")
        near = tasks.groupBy(*_DEALT).applyInArrow(_near_nodes(percent), record(node=_LONG)).distinct()
        held = self.sets_of(settled(near)).join(own, "node")
        close = left.join(held.select("node", "n"), "node")
        tasks = _dealt(close, "n", BIN_SHINGLES).drop("n").join(held, "node")
        second = tasks.groupBy(*_DEALT).applyInArrow(_links(percent), record(u=_LONG, v=_LONG))
        # Kept, since the components read their edges more than once.
        return first.unionByName(settled(second))


def near_duplicates(
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    A row's set holds the distinct shingles of ``width`` words, A-Z lowered; fewer words are one
    shingle, and no words (null or empty texts) an empty set, which is linked with nothing. Sets
    are linked if 100 times their intersection reaches ``percent`` times their union. Equal sets
    meet as one before any search. ``component_id`` is the least id that links lead to, itself
    included; ``kept`` tells whether it is the row's own.

    All pairs at a signature distance of at most ``MAX_DISTANCE`` of ``SYMBOLS`` are found. A pair
    of similarity s lies beyond it with the chance of a binomial tail: 4 in a million at 0.85,
    less for more similar ones; below 0.8 choose more chunks. What is found is exact.

    Rows with one id and several texts are sets of their own under that id. A null id counts
    after all others and comes out as null, as does a component of such rows only, which are
    kept. Repeated rows come out as often. Other columns play no part. An empty table gives an
    empty table.
    """
    rows = settled(
        in_small_batches(docs)
        .select(
            id_of(id_col).alias("doc"),
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text_of(text_col)).alias("version"),
            _describe(width)(raw_text(text_col)).alias("set"),
        )
        .select("doc", "doc_id", "version", "set.*")
    )
    join = _Join(docs, rows, width, percent, text_col, id_col)
    roots = connected_components(join.links())
    rooted = join.classes.join(roots, "node", "left").select(
        "h1", "h2", "rep.doc", F.coalesce("root", "node").alias("root")
    )
    rooted = settled(rooted)
    least = settled(rooted.groupBy("root").agg(F.min("doc").alias("least")))
    members = settled(rooted.join(least, "root").select("h1", "h2", "least"))
    found = rows.select("doc", "doc_id", "n", "h1", "h2").join(members, ["h1", "h2"], "left")
    least = F.coalesce("least", "doc")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(least != LAST_ID, least).alias("component_id"),
        (F.col("doc") == least).alias("kept"),
    )
