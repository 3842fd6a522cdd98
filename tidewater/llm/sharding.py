"""Sharding by jump consistent hashing: a key and the number of shards decide, no ring table.

Native operator: the generator of the published algorithm is 64-bit arithmetic modulo 2^64, kept
in two 32-bit halves, since a product that overflows is an error in Spark's default mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewater.llm.common import free_names, id_of, text_of
from tidewater.sources.checkpoint import settled

# Fixed value: the multiplier of the algorithm's linear congruential generator.
MULTIPLIER = 2862933555777941757
# Jumps computed in straight-line code. More are needed with a chance of about one in 10^20 for a
# million shards; those keys take the loop that allows one jump per shard.
JUMPS = 64
# Rows that one bucket of the slot numbering is meant to hold.
BUCKET_ROWS = 50_000

_LOW = (1 << 32) - 1
_M_HIGH, _M_LOW = MULTIPLIER >> 32, MULTIPLIER & _LOW


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """The halves of (key * MULTIPLIER + 1) mod 2^64; no intermediate value reaches 2^63."""
    low_high, low_low = F.shiftright(low, 16), low.bitwiseAND(_long(0xFFFF))
    upper = low_high * _long(_M_LOW)
    product = low_low * _long(_M_LOW) + F.shiftleft(upper.bitwiseAND(_long(0xFFFF)), 16) + _long(1)

    def times(x: Column, factor: int) -> Column:
        """x * factor mod 2^32."""
        a = (F.shiftright(x, 16) * _long(factor)).bitwiseAND(_long(0xFFFF))
        b = (x.bitwiseAND(_long(0xFFFF)) * _long(factor)).bitwiseAND(_long(_LOW))
        return (F.shiftleft(a, 16) + b).bitwiseAND(_long(_LOW))

    carry = F.shiftright(product, 32) + F.shiftright(upper, 16)
    new_high = carry + times(high, _M_LOW) + times(low, _M_HIGH)
    return new_high.bitwiseAND(_long(_LOW)), product.bitwiseAND(_long(_LOW))


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a 64-bit key; one more shard takes rows only into itself.

    A null key counts as 0.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    key = F.coalesce(key, _long(0))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(_long(_LOW)).alias("low"),
        _long(0).alias("shard"),
        _long(0).alias("next"),
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _step(state["high"], state["low"])
        divisor = (F.shiftright(high, 1) + _long(1)).cast("double")
        forward = ((state["next"] + _long(1)).cast("double") * (F.lit(float(1 << 31)) / divisor)).cast("bigint")
        moved = F.struct(
            high.alias("high"), low.alias("low"), state["next"].alias("shard"), forward.alias("next")
        )
        return F.when(state["next"] < _long(shards), moved).otherwise(state)

    def after(steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, jump)

    quick = after(min(JUMPS, shards))
    if shards <= JUMPS:
        return quick["shard"].cast("int")
    # Only keys that are still short of the last shard are computed a second time.
    exact = F.when(quick["next"] >= _long(shards), quick["shard"]).otherwise(after(shards)["shard"])
    return exact.cast("int")


def key_of(id_col: str = "doc_id") -> Column:
    """A stable 64-bit key of the id."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def shard_rows(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the text, with ``size``, ``text_crc32``, ``shard``, ``slot``, ``grown_shard``.

    The shard follows from the id and the number of shards alone, so rows that repeat an id meet
    in one shard; ``grown_shard`` is the shard if there were one more. ``size`` is the text's
    bytes in UTF-8 plus one. ``slot`` numbers the rows of a shard from 0 without gaps.

    A null text has no bytes and checksum 0; a null id is one key of its own. Output names replace
    input columns, all others are kept. An empty table gives an empty table.

    A shard may hold more rows than a task should see together, so slots are numbered in two
    steps: rows are dealt over buckets of each shard, buckets are counted, and a row's slot is
    its number in the bucket after all rows of the buckets before. Equal ids are dealt by a hash
    of the whole row, and rows that are equal throughout by their place in the input.
    """
    outputs = {
        "size": F.octet_length(text_of(text_col)).cast("bigint") + F.lit(1).cast("bigint"),
        "text_crc32": F.crc32(text_of(text_col).cast("binary")),
        "shard": jump_hash(key_of(id_col), shards),
        "grown_shard": jump_hash(key_of(id_col), shards + 1),
    }
    spread, bucket, before = free_names(docs, "_spread", "_bucket", "_before")
    rows = docs.withColumns(outputs | {spread: F.monotonically_increasing_id()}).drop(text_col)
    placed = settled(rows)  # keeps the numbers of the rows, whatever is computed again later
    total = placed.count()
    buckets = max(1, -(-total // (shards * BUCKET_ROWS)))
    placed = placed.withColumn(bucket, F.pmod(F.xxhash64(F.col(id_col), F.col(spread)), F.lit(buckets)))
    sizes = placed.groupBy("shard", bucket).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("shard").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("shard", bucket, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    own = W.partitionBy("shard", bucket).orderBy(id_of(id_col), spread)
    numbered = placed.withColumn("slot", F.row_number().over(own).cast("bigint") - F.lit(1).cast("bigint"))
    return (
        numbered.join(settled(starts), ["shard", bucket])
        .withColumn("slot", F.col("slot") + F.col(before))
        .drop(spread, bucket, before)
    )
