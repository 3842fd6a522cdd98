"""Chat formatting by prefix-target expansion.

Every assistant turn is an example of its own: all turns before it are context, and only its own
text is trainable. A conversation's formatted text is kept once, turn by turn; an example's
context is the part of it that ends where its target begins, named by its length. Written out,
contexts grow with the square of a conversation's length, which ``with_contexts`` does on request;
``streamed_contexts`` gives the digest of each from one pass over the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewater.llm.common import in_small_batches, record

# The signs that the template marks turns with.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
# Turns that one task numbers together.
BLOCK = 1024
# Contexts of a conversation are written out if they hold so many characters together; of others
# they are read in one pass over the turns.
WRITTEN_CHARS = 1_000_000


def escaped(text: Column) -> Column:
    """The text without any ``<|``: one backslash more in every ``<``, backslashes, ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _escaped_role(role: Column) -> Column:
    """A role on one line; backslashes and line ends are written with a backslash."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn, formatted, start, target_start, target_end), a row per turn.

    Expects conv_id, turn, role and text; other columns play no part. ``formatted`` is the turn
    in the template, ``start`` its first character's place in the conversation's formatted text,
    ``place`` its number in the conversation from 0. For an assistant turn ``target_start`` and
    ``target_end`` bound its text in the conversation's formatted text; otherwise they are null.

    Turns are ordered by their number, missing ones last; turns that share a number by role and
    text, so repeated rows stay and make repeated turns. Null texts and roles are empty; a null
    conversation id is a conversation of its own. An empty table gives an empty table. Long
    conversations are numbered in blocks of turns, so that no task has to sort a whole one.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), _escaped_role(role), F.lit("\n"))
    body = escaped(text)
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.floor(F.coalesce(F.col("turn").cast("bigint"), F.lit((1 << 62))) / BLOCK).alias("block"),
        F.concat(head, body, F.lit(END + "\n")).alias("formatted"),
        F.length(head).cast("bigint").alias("head"),
        F.length(body).cast("bigint").alias("body"),
    ).withColumn("chars", F.length("formatted").cast("bigint"))
    sizes = turns.groupBy("conv_id", "block").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("chars").alias("chars")
    )
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    blocks = sizes.select(
        F.col("conv_id").alias("of"),
        F.col("block").alias("of_block"),
        F.coalesce(F.sum("rows").over(earlier), zero).alias("rows_before"),
        F.coalesce(F.sum("chars").over(earlier), zero).alias("chars_before"),
    )
    order = W.partitionBy("conv_id", "block").orderBy(F.asc_nulls_last("turn"), "role", "text")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    numbered = turns.withColumns(
        {
            "place": F.row_number().over(order).cast("bigint") - 1,
            "start": F.coalesce(F.sum("chars").over(before), zero),
        }
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))
    start = F.col("start") + F.col("chars_before")
    trained = F.col("role") == TRAINED
    return numbered.join(blocks, same).select(
        "conv_id",
        (F.col("place") + F.col("rows_before")).alias("place"),
        "turn",
        "formatted",
        start.alias("start"),
        F.when(trained, start + F.col("head")).alias("target_start"),
        F.when(trained, start + F.col("head") + F.col("body")).alias("target_end"),
    )


def prefix_examples(formatted: DataFrame) -> DataFrame:
    """(conv_id, place, context_chars, target, end), a row per assistant turn.

    The context is the first ``context_chars`` characters of the conversation's formatted text,
    the head of the reply included; ``target`` is the reply's escaped text, the only trainable
    part; ``end`` closes the example.
    """
    head = F.col("target_start") - F.col("start")
    return formatted.filter(F.col("target_start").isNotNull()).select(
        "conv_id",
        "place",
        F.col("target_start").alias("context_chars"),
        F.substring(
            "formatted", (head + 1).cast("int"), (F.col("target_end") - F.col("target_start")).cast("int")
        ).alias("target"),
        F.lit(END + "\n").alias("end"),
    )


def with_contexts(examples: DataFrame, formatted: DataFrame) -> DataFrame:
    """Examples with ``context`` written out; choose conversations whose length allows it."""
    turns = formatted.select(
        F.col("conv_id").alias("of"), F.col("place").alias("at"), F.col("formatted").alias("part")
    )
    held = examples.join(
        turns, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("at") <= F.col("place")), "left"
    )
    parts = F.array_sort(F.collect_list(F.struct("at", "part")))
    joined = F.array_join(F.transform(parts, lambda x: x["part"]), "")
    return (
        held.groupBy(*examples.columns)
        .agg(joined.alias("context"))
        .withColumn("context", F.left("context", F.col("context_chars").cast("int")))
    )


def written_contexts(examples: DataFrame, formatted: DataFrame, most: int = WRITTEN_CHARS) -> DataFrame:
    """``with_contexts`` of the conversations whose contexts hold at most ``most`` characters together.

    Written out, contexts grow with the square of a conversation's length; ``streamed_contexts``
    gives those of the longer conversations as digests.
    """
    small = _context_sizes(examples).filter(F.col("chars") <= most)
    return with_contexts(examples.join(small, F.col("conv_id").eqNullSafe(F.col("of")), "left_semi"), formatted)


def _context_sizes(examples: DataFrame) -> DataFrame:
    return examples.groupBy(F.col("conv_id").alias("of")).agg(F.sum("context_chars").alias("chars"))


_STREAMED = record(conv_id=T.LongType(), place=T.LongType(), sha256=T.StringType())


def _prefix_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digest of the first ``chars`` characters of a conversation, from its turns in order.

    A prefix ends in the turn that it comes with; one that does not has no digest (empty).
    """
    now, digest, before = None, None, 0
    for batch in batches:
        done = []
        rows = zip(*(batch[c] for c in ("conv_id", "missing", "place", "formatted", "chars")))
        for conv, missing, place, formatted, chars in rows:
            if (conv, missing) != now:
                now, digest, before = (conv, missing), hashlib.sha256(), 0
            if chars >= 0:
                inside = before <= chars <= before + len(formatted)
                prefix = digest.copy()
                prefix.update(formatted[: max(0, chars - before)].encode())
                done.append((None if missing else conv, place, prefix.hexdigest() if inside else ""))
            digest.update(formatted.encode())
            before += len(formatted)
        yield pd.DataFrame(done, columns=_STREAMED.names).astype({"conv_id": "Int64"})


def streamed_contexts(examples: DataFrame, formatted: DataFrame, most: int = WRITTEN_CHARS) -> DataFrame:
    """(conv_id, place, sha256): digests of the contexts that ``written_contexts`` does not write out.

    A conversation's contexts are prefixes of one text, so one pass over its turns in order gives
    them all: work and memory grow with the conversation's length, not with its square. Turns are
    sorted by Spark and read one by one.
    """
    long = _context_sizes(examples).filter(F.col("chars") > most)
    wanted = examples.select(
        F.col("conv_id").alias("by"), F.col("place").alias("at"), F.col("context_chars").alias("chars")
    )
    turns = formatted.join(long.select("of"), F.col("conv_id").eqNullSafe(F.col("of")), "left_semi")
    told = turns.join(wanted, F.col("conv_id").eqNullSafe(F.col("by")) & (F.col("place") == F.col("at")), "left").select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0).cast("bigint")).alias("conv_id"),
        F.col("conv_id").isNull().alias("missing"),
        "place",
        "formatted",
        F.coalesce("chars", F.lit(-1).cast("bigint")).alias("chars"),
    )
    ordered = in_small_batches(told).repartition("conv_id", "missing").sortWithinPartitions("conv_id", "missing", "place")
    return ordered.mapInPandas(_prefix_digests, _STREAMED)


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n", re.DOTALL)
_DIGEST = record(
    conv_id=T.LongType(),
    n_turns=T.LongType(),
    turns_sha256=T.StringType(),
    loss_chars=T.LongType(),
    loss_sha256=T.StringType(),
    formatted_chars=T.LongType(),
    n_examples=T.LongType(),
    n_contexts=T.LongType(),
    n_written=T.LongType(),
)


class _Conversation:
    """What the ordered turns and examples of one conversation have added up to."""

    def __init__(self, conv: int, missing: bool) -> None:
        self.key = conv, missing
        self.turns, self.loss, self.formatted = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
        self.counts = dict.fromkeys(("turns", "loss", "chars", "examples", "contexts", "written"), 0)
        self.before, self.chars_before, self.turn = self.formatted.copy(), 0, ""

    def add_turn(self, formatted: str) -> None:
        role, text = _TURN.fullmatch(formatted).groups()
        self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
        self.counts["turns"] += 1
        self.before, self.chars_before, self.turn = self.formatted.copy(), self.counts["chars"], formatted
        self.formatted.update(formatted.encode())
        self.counts["chars"] += len(formatted)

    def add_example(self, target: str, context_chars: int, context_sha256: str | None) -> None:
        """Count the example, and its context if it is all turns before and the head of its own."""
        text = unescape(target)
        self.loss.update(text.encode())
        self.counts["loss"] += len(text)
        head = self.turn[: self.turn.index("\n") + 1]
        self.before.update(head.encode())
        same = context_chars == self.chars_before + len(head)
        self.counts["examples"] += 1
        self.counts["written"] += context_sha256 is not None
        self.counts["contexts"] += same and context_sha256 in (None, self.before.hexdigest())

    def row(self) -> tuple:
        (conv, missing), n = self.key, self.counts
        digests = n["turns"], self.turns.hexdigest(), n["loss"], self.loss.hexdigest()
        return None if missing else conv, *digests, n["chars"], n["examples"], n["contexts"], n["written"]


def read_back(
    formatted: DataFrame,
    examples: DataFrame,
    written: DataFrame | None = None,
    streamed: DataFrame | None = None,
) -> DataFrame:
    """What the formatted turns and the examples hold, unescaped, as digests per conversation.

    ``n_examples`` counts the examples and ``n_contexts`` those whose context is exactly the turns
    before and the head of the reply: its length is theirs, and, of examples that are in ``written``
    with their context or in ``streamed`` with its digest (``n_written``), so is its digest.

    A digest of a conversation takes its turns in order, so they flow through one task; they are
    sorted there by Spark, which may spill, and read one by one, so memory holds one batch.
    """

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for batch in batches:
            done = []
            rows = zip(*(batch[c] for c in ("conv_id", "missing", "is_target", "content", "chars", "sha256")))
            for conv, missing, is_target, content, chars, sha256 in rows:
                if now is None or (conv, missing) != now.key:
                    if now:
                        done.append(now.row())
                    now = _Conversation(conv, missing)
                if is_target:
                    now.add_example(content, chars, sha256 or None)
                else:
                    now.add_turn(content)
            yield pd.DataFrame(done, columns=_DIGEST.names).astype({"conv_id": "Int64"})
        if now:
            yield pd.DataFrame([now.row()], columns=_DIGEST.names).astype({"conv_id": "Int64"})

    conv = F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0).cast("bigint")).alias("conv_id")
    missing = F.col("conv_id").isNull().alias("missing")
    if written is None and streamed is None:
        told = examples.withColumn("sha256", F.lit(""))
    else:
        digest = F.sha2(F.col("context").cast("binary"), 256)
        held = [] if written is None else [written.select("conv_id", "place", digest.alias("sha256"))]
        # A streamed context without a digest is no prefix of the turns, which none equals.
        none = F.when(F.col("sha256") == "", "none").otherwise(F.col("sha256"))
        held += [] if streamed is None else [streamed.select("conv_id", "place", none.alias("sha256"))]
        contexts = reduce(DataFrame.unionByName, held)
        contexts = contexts.select(F.col("conv_id").alias("of"), F.col("place").alias("at"), "sha256")
        same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("place") == F.col("at"))
        told = examples.join(contexts, same, "left").withColumn("sha256", F.coalesce("sha256", F.lit("")))
    none = F.lit(0).cast("bigint").alias("chars"), F.lit("").alias("sha256")
    parts = formatted.select(
        conv, missing, "place", F.lit(False).alias("is_target"), F.col("formatted").alias("content"), *none
    ).unionByName(
        told.select(
            conv,
            missing,
            "place",
            F.lit(True).alias("is_target"),
            F.col("target").alias("content"),
            F.col("context_chars").alias("chars"),
            "sha256",
        )
    )
    ordered = in_small_batches(parts).repartition("conv_id", "missing").sortWithinPartitions(
        "conv_id", "missing", "place", "is_target"
    )
    return ordered.mapInPandas(digests, _DIGEST)
