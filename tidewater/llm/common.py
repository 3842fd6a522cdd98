"""Byte tables and column helpers that several operators share."""

from __future__ import annotations

import functools
import string
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ASCII white space as the operators' contracts name it: space and \t to \r.
BLANKS = " \t\n\x0b\x0c\r"
# Only A-Z are lowered; other scripts stay as they are.
LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
# Stands for a missing id where ids are compared: after every real one.
LAST_ID = (1 << 63) - 1


def text_of(name: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def raw_text(name: str = "text") -> Column:
    """The text's UTF-8 bytes, with null as empty: Python workers then need not decode it."""
    return text_of(name).cast("binary")


def id_of(name: str = "doc_id") -> Column:
    """The id as a bigint, with null after all others."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(LAST_ID))


def lowered(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def record(**fields: T.DataType) -> T.StructType:
    """A struct type that needs no session, so that modules can hold it."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Helper column names that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def put_aside(df: DataFrame, results: list[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns named like ``results`` renamed, and the columns that undo that."""
    clashing = [c for c in df.columns if c.lower() in {r.lower() for r in results}]
    names = dict(zip(clashing, free_names(df, *[f"_{c}" for c in clashing])))
    return df.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in df.columns]


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends texts to Python in Arrow batches of at most 8 MB.

    Spark's own bound is 64 MB, which both sides of every task hold several times over. A session
    that sets another bound keeps it.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key) == "67108864b":
        conf.set(key, "8m")
    return df


def trimmed(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work``, which turns a task's batches into results, giving its memory back when it ends.

    A Python worker waits for further tasks, and what it keeps counts against its executor, also
    while stages run that need no Python.
    """

    @functools.wraps(work)
    def done(batches):
        try:
            yield from work(batches)
        finally:
            _release()

    return done


def _release() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass
