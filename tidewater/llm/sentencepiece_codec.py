"""SentencePiece encoding and decoding for vocabularies made of merges.

A text is normalised, cut where no piece of the vocabulary can cross, and each part is merged by
an agenda: the adjacent pairs of symbols that make a piece, best score first, leftmost first
among equals. Short parts of one length are merged together, their agendas being the rows of a
matrix; a long part has a heap. The sentencepiece library encodes every text of the same Arrow
batch as a check.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import free_names, in_small_batches, record, text_of, trimmed

SIGN = "▁"  # stands for a space inside pieces and normalised texts
SPACE = " "  # stands for that sign here: most texts then take a byte a character
CACHED_PARTS = 250_000  # parts whose ids a worker remembers
TEXTS = 768  # texts that are encoded together at most
BLOCK_BYTES = 4_000_000
SHORT = 32  # characters of a part that is merged in a matrix
NONE = np.int32(2**31 - 1)

_CODED = record(ids=T.ArrayType(T.IntegerType()), decoded=T.StringType(), agrees=T.BooleanType())


class PairTable:
    """Looks up what two adjacent symbols make, for arrays of symbols."""

    BITS = 20

    def __init__(self, left: array, right: array, made: array, width: int) -> None:
        self.width = np.int64(width)
        keys = np.asarray(left, np.int64) * width + np.asarray(right, np.int64)
        made = np.asarray(made, np.int32)
        order = np.argsort(keys)
        self.sorted_keys, self.sorted_made = keys[order], made[order]
        slots = self._slots(keys)
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.made = np.full(1 << self.BITS, NONE, np.int32)
        self.keys[slots], self.made[slots] = keys, made
        # Slots that several pairs want; those are looked up by bisection.
        self.crowded = np.bincount(slots, minlength=1 << self.BITS) > 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).view(np.int64)

    def made_by(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) * self.width + b
        slots = self._slots(keys)
        found = np.where(self.keys[slots] == keys, self.made[slots], NONE)
        again = np.flatnonzero(self.crowded[slots])
        if len(again):
            at = np.searchsorted(self.sorted_keys, keys[again])
            at[at == len(self.sorted_keys)] = 0
            found[again] = np.where(self.sorted_keys[at] == keys[again], self.sorted_made[at], NONE)
        return found


class _Numbered(dict):
    """Numbers parts as they come; ``fresh`` lists those that are new."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.fresh.append(part)
        return number


class Merger:
    """Encodes normalised texts by the pieces and scores of a loaded model.

    Symbols are numbers: pieces first, then characters that pieces hold without being one, then
    characters of no piece as they come.
    """

    def __init__(self, model) -> None:
        every = range(model.get_piece_size())
        if any(model.is_unused(i) for i in every):
            raise ValueError("Vocabularies with unused pieces are not supported")
        special = {i for i in every if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.ids = {model.id_to_piece(i).replace(SIGN, SPACE): i for i in every if i not in special}
        # Equal scores share a rank, so that the leftmost of equals goes first.
        scores = sorted({model.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {score: r for r, score in enumerate(scores)}
        self.rank = {piece: place[model.get_score(i)] for piece, i in self.ids.items()}
        self.unknown = model.unk_id()
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = byte_ids if all(model.is_byte(i) for i in byte_ids) else None
        self.parts = re.compile(self._cuts(), re.DOTALL)

        symbols = [*self.ids, *sorted({c for p in self.ids for c in p} - set(self.ids))]
        number = {s: k for k, s in enumerate(symbols)}
        self.width = len(symbols)
        left, right, made = array("i"), array("i"), array("i")
        for p in self.ids:
            for k in range(1, len(p)):
                if p[:k] in number and p[k:] in number:
                    left.append(number[p[:k]])
                    right.append(number[p[k:]])
                    made.append(number[p])
        self.table = PairTable(left, right, made, self.width + 1)
        self.ranks = np.array([self.rank.get(s, NONE) for s in symbols], np.int64)
        self.char = np.full(0x110000, -1, np.int32)
        for s, k in number.items():
            if len(s) == 1:
                self.char[ord(s)] = k
        self.symbol_ids = [self._ids_of(s) for s in symbols]
        # The id of a symbol that is a piece, else -1.
        self.piece_id = np.array([self.ids.get(s, -1) for s in symbols], np.int32)
        self.forget()

    def _ids_of(self, symbol: str) -> list[int]:
        if symbol in self.ids:
            return [self.ids[symbol]]
        written = symbol.replace(SPACE, SIGN)
        return [self.bytes[b] for b in written.encode()] if self.bytes else [self.unknown]

    def forget(self) -> None:
        self.known = _Numbered()
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _cuts(self) -> str:
        """Parts that no merge can cross: two neighbours in no piece never become one symbol.

        A part begins at a run of spaces, and a word ends before a sign where its letters meet
        signs in no piece. Line ends stand alone where no piece has one.
        """
        longer = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            return ".+"
        end = "" if any("\n" in p for p in longer) else "\n"
        before_signs = {a for p in longer for a, b in zip(p, p[1:]) if not b.isalnum()}
        letters = [c for c in map(chr, range(65, 256)) if c.isalpha() and c not in before_signs]
        word = f"{SPACE}*[{''.join(letters)}]++(?![^\\W_])" if letters else ""
        parts = [word, f"{SPACE}*[^{SPACE}{end}]+", f"{SPACE}+", end]
        return "|".join(p for p in parts if p)

    def merged(self, part: str) -> list[str]:
        """The symbols of one part, by a heap of numbers: the pair's rank, then its place."""
        rank, n = self.rank.get, len(part)
        symbols = list(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [r * n + i for i in range(n - 1) if (r := rank(part[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            r, i = divmod(heappop(agenda), n)
            j = after[i]
            if j >= n or not symbols[i]:
                continue
            piece = symbols[i] + symbols[j]
            if rank(piece) != r:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = piece, ""
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if (r := rank(piece + symbols[j])) is not None:
                    heappush(agenda, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + piece)) is not None:
                heappush(agenda, r * n + h)
        return [s for s in symbols if s]

    def _numbers(self, points: np.ndarray) -> np.ndarray:
        """Symbols of characters; new ones of no piece get numbers of their own."""
        for point in np.unique(points[self.char[points] < 0]):
            self.char[point] = len(self.symbol_ids)
            self.symbol_ids.append(self._ids_of(chr(point)))
        return self.char[points]

    def _merged_rows(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, symbols) of rows that have no pair left, for rows of equal length.

        Every row that goes on makes its best pair one symbol, so all rows stay of one length.
        """

        def made_by(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            # Characters of no piece share a number that makes no pair.
            return self.table.made_by(np.minimum(a, self.width), np.minimum(b, self.width))

        at = np.arange(len(rows))
        made = made_by(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), -1)
        while len(rows):
            n = rows.shape[1]
            if n == 1:
                yield at, rows
                return
            ranks = np.where(made == NONE, np.int64(NONE), self.ranks[np.where(made == NONE, 0, made)])
            best = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            done = ranks[every, best] == NONE
            if done.any():
                yield at[done], rows[done]
                go = ~done
                at, rows, made, best = at[go], rows[go], made[go], best[go]
                every = np.arange(len(rows))
                if not len(rows):
                    return
            rows[every, best] = made[every, best]
            columns = np.arange(n)
            rows = rows[columns != best[:, None] + 1].reshape(len(rows), n - 1)
            made = made[columns[:-1] != best[:, None]].reshape(len(rows), n - 2)
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < n - 2)
            k = best[left]
            made[left, k - 1] = made_by(rows[left, k - 1], rows[left, k])
            k = best[right]
            made[right, k] = made_by(rows[right, k], rows[right, k + 1])

    def _learn(self, parts: list[str]) -> None:
        """Merge parts that are new and keep their ids, in the order of their numbers."""
        by_length = defaultdict(list)
        for k, p in enumerate(parts):
            by_length[len(p) if len(p) <= SHORT else 0].append(k)
        sizes = np.zeros(len(parts), np.int64)
        starts = np.zeros(len(parts), np.int64)
        pools, end = [self.pool], len(self.pool)

        def keep(at: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
            nonlocal end
            sizes[at] = own
            starts[at] = end + np.cumsum(own) - own
            pools.append(ids)
            end += len(ids)

        for n, own in by_length.items():
            if n == 0:
                for k in own:
                    ids = list(chain.from_iterable(map(self._ids_of, self.merged(parts[k]))))
                    keep(np.array([k]), np.array(ids, np.int32), np.array([len(ids)]))
                continue
            own = np.array(own)
            points = np.frombuffer("".join([parts[k] for k in own]).encode("utf-32-le"), np.uint32)
            for at, rows in self._merged_rows(self._numbers(points).reshape(-1, n).copy()):
                keep(own[at], *self._ids_of_rows(rows))
        self.starts = np.concatenate((self.starts, starts))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.pool = np.concatenate(pools)

    def _ids_of_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if rows.max() < self.width:
            ids = self.piece_id[rows]
            if ids.min() >= 0:
                return ids.ravel(), np.full(len(rows), rows.shape[1])
        lists = [self.symbol_ids[x] for x in rows.ravel().tolist()]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)).reshape(rows.shape).sum(axis=1)
        return np.fromiter(chain.from_iterable(lists), np.int32), sizes

    def encode_all(self, normals: list[str]) -> list[np.ndarray]:
        """The ids of each normalised text."""
        cut = [self.parts.findall(text.replace(SIGN, SPACE)) for text in normals]
        parts = list(chain.from_iterable(cut))
        if not parts:
            return [np.zeros(0, np.int32) for _ in normals]
        if len(self.known) > CACHED_PARTS:
            self.forget()
        codes = np.fromiter(map(self.known.__getitem__, parts), np.int32, len(parts))
        per_text = np.cumsum([len(c) for c in cut])
        del parts, cut  # the largest things here
        if self.known.fresh:
            self._learn(self.known.fresh)
            self.known.fresh = []
        lengths = self.sizes[codes]
        ends = np.cumsum(lengths)
        # Every id's place in the pool: its part's start, and on from there.
        places = np.repeat((self.starts[codes] - ends + lengths).astype(np.int32), lengths)
        places += np.arange(ends[-1], dtype=np.int32)
        ids = self.pool[places]
        bounds = np.concatenate(([0], ends))[per_text]
        found = np.split(ids, bounds[:-1])
        return found if self.bytes else [self._joined_unknowns(x) for x in found]

    def _joined_unknowns(self, ids: np.ndarray) -> np.ndarray:
        """A run of unknown characters is one unknown piece."""
        unknown = ids == self.unknown
        return ids[~(unknown & np.concatenate(([False], unknown[:-1])))] if len(ids) else ids


def _blocks(batch: pa.Array) -> Iterator[pa.Array]:
    """The batch in blocks of a bounded number of texts and, but for one long text, of bytes."""
    sizes = pc.binary_length(batch).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > start and (k - start == TEXTS or held + size > BLOCK_BYTES):
            yield batch[start:k]
            start, held = k, 0
        held += size
    if len(batch) > start:
        yield batch[start:]


def _loaded(model_path: str) -> tuple:
    """The model of a file and its merger, kept by the worker process for its further tasks.

    The store hangs on the library's own module, since functions of this package are new objects
    in every task.
    """
    import sentencepiece

    store = vars(sentencepiece).setdefault("_loaded_mergers", {})
    if model_path not in store:
        store.clear()
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        store[model_path] = model, Merger(model)
    return store[model_path]


def coded(model_path: str, text: Column, decode: bool = True) -> Column:
    """Struct (ids, decoded, agrees) of a text column; ``model_path`` is a file on every worker."""

    @F.arrow_udf(_CODED)
    @trimmed
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, merger = _loaded(model_path)
        end = np.array([model.eos_id()], np.int32)
        # Results leave block by block, so a worker holds those of one block only.
        for given in (block.to_pylist() for batch in batches for block in _blocks(batch)):
            sizes, ids, texts, agrees = [0], [np.zeros(0, np.int32)], [], []
            # An empty text has no pieces, where a normalised one may begin with a space.
            normal = [model.normalize(text) if text else "" for text in given]
            for text, own in zip(given, merger.encode_all(normal)):
                own = np.concatenate((own, end))
                agrees.append(np.array_equal(own, model.encode_as_numpy(text, add_eos=True)))
                ids.append(own)
                sizes.append(len(own))
                texts.append(model.decode(own.tolist()) if decode else None)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(ids))
            )
            yield pa.StructArray.from_arrays(
                [lists, pa.array(texts, pa.string()), pa.array(agrees, pa.bool_())], names=_CODED.names
            )

    return code(text)


def tokenize(docs: DataFrame, model_path: str, text_col: str = "text", decode: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (the end id last), ``decoded`` and ``agrees``.

    ``ids`` are those of the agenda, ``decoded`` is what the library makes of them (null without
    ``decode``), and ``agrees`` says whether the library encodes the text to the same ids. Null
    and empty texts have only the end id. Output names replace input columns, all others are
    kept; repeated rows come out as often; an empty table gives an empty table. A narrow stage:
    texts of any length are encoded whole, and memory holds one Arrow batch and a bounded cache.
    """
    (s,) = free_names(docs, "_coded")
    done = in_small_batches(docs).withColumn(s, coded(model_path, text_of(text_col), decode))
    return done.withColumns({c: F.col(f"{s}.{c}") for c in _CODED.names}).drop(s)
