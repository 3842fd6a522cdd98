"""Line dedup: lines that several documents share stay only in the first of them.

Native operator: lines are exploded, normalised, hashed and counted by built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BLANKS, free_names, id_of, lowered, put_aside, text_of


def _keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, version, pos, h1, h2): every line long enough to count, by the hash of its key.

    Two hashes with independent seeds make a key of 128 bits, so that lines of a large corpus
    do not meet by chance; they cross the shuffle instead of the lines.
    """
    lines = docs.select(
        id_of(id_col).alias("doc"),
        F.xxhash64(text_of(text_col)).alias("version"),
        F.posexplode(F.split(text_of(text_col), "\n")).alias("pos", "line"),
    )
    key = lowered(F.btrim(F.col("line"), F.lit(BLANKS)))
    return (
        lines.select("doc", "version", "pos", key.alias("key"))
        .filter(F.length("key") >= min_chars)
        .select(
            "doc",
            "version",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
        )
    )


def drop_shared_lines(
    docs: DataFrame,
    min_chars: int = 10,
    min_docs: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with shared lines taken out of ``text``, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line without ASCII blanks at its ends and with A-Z lowered. A key of at
    least ``min_chars`` code points that at least ``min_docs`` documents hold loses all its lines
    except those of the smallest id holding it; other lines keep their order. ``n_lines`` counts
    the lines before dropping.

    Null or empty text is one empty line and comes out empty. Repeats inside one document do not
    count as shared. Rows that repeat an id are one document; each row loses its own lines. A
    null id counts as an id after all others. Columns named ``n_lines`` or ``n_dropped`` are
    replaced, all others are kept. An empty table gives an empty table.

    A hot line costs one row per task in the count; the join that marks its lines has one row
    per key on the other side, so that Spark can split it.
    """
    keyed = _keyed_lines(docs, id_col, text_col, min_chars)
    holders = keyed.groupBy("h1", "h2")
    if min_docs <= 2:
        shared = holders.agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter(
            F.col("first") < F.col("last")
        )
    else:
        shared = holders.agg(F.min("doc").alias("first"), F.count_distinct("doc").alias("n"))
        shared = shared.filter(F.col("n") >= min_docs)
    dropped = (
        keyed.join(shared.select("h1", "h2", "first"), ["h1", "h2"])
        .filter(F.col("doc") > F.col("first"))
        .groupBy("doc", "version")
        .agg(F.collect_set("pos").alias("drops"))
    )

    doc, version, lines, drops = free_names(docs, "_doc", "_version", "_lines", "_drops")
    # Split before the join: the lambda below then reads a column and does not split again.
    split = docs.withColumns(
        {
            doc: id_of(id_col),
            version: F.xxhash64(text_of(text_col)),
            lines: F.split(text_of(text_col), "\n"),
        }
    )
    marked = split.join(
        dropped.select(
            F.col("doc").alias(doc), F.col("version").alias(version), F.col("drops").alias(drops)
        ),
        [doc, version],
        "left",
    )
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(every, F.col(drops)), lambda i: F.get(F.col(lines), i))
    return marked.select(
        *[F.col(c) for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")],
        F.when(F.col(drops).isNull(), text_of(text_col))
        .otherwise(F.array_join(kept, "\n"))
        .alias(text_col),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(drops), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def without_shared_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its own columns only, shared lines taken out of the text."""
    aside, restored = put_aside(docs, ["n_lines", "n_dropped"])
    return drop_shared_lines(aside, **options).select(*restored)
