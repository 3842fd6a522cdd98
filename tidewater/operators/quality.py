"""Row checks: flag, explain, split and count, all in the scan's own stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.numbers import column, number, ratio_pct
from tidewater.operators.rules import RuleSet
from tidewater.schemas import NUMBER_TYPES, PARSED, UNREADABLE, Table


class MissingColumnsError(ValueError):
    """The feed lacks columns that its rules require."""


def require_columns(df: DataFrame, rules: RuleSet) -> None:
    """Raise before any row is read when a required column is absent."""
    missing = [name for name in rules.required if name not in df.columns]
    if missing:
        raise MissingColumnsError(f"The feed lacks required columns: {missing}")


def _is_missing(df: DataFrame, name: str) -> Column:
    c = column(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def failed_rules(
    df: DataFrame, rules: RuleSet, parsed: dict[str, Column]
) -> list[tuple[str, Column]]:
    """Reason text and never-null failure flag per rule; ``parsed`` holds the columns as numbers.

    Rules on columns that the feed lacks are left out. A record that its reader could not parse
    fails whatever its values are.
    """
    present = set(df.columns)
    found = [(UNREADABLE, column(UNREADABLE).isNotNull())] if UNREADABLE in present else []
    found += [(f"null:{c}", _is_missing(df, c)) for c in rules.non_null if c in present]
    found += [
        (f"non_positive:{c}", F.coalesce(parsed[c], F.lit(-1)) <= 0)
        for c in rules.positive
        if c in present
    ]
    for c, (low, high) in rules.ranges.items():
        if c in present:
            outside = (parsed[c] < low) | (parsed[c] > high)
            found.append((f"out_of_range:{c}", F.coalesce(outside, F.lit(False))))
    return found


def check(
    df: DataFrame, rules: RuleSet, require: bool = True, feed: Table | None = None
) -> DataFrame:
    """Add ``rejected`` and ``rejection_reason`` (all failed rules in order, blank-separated).

    With ``feed`` also ``parsed_numbers``, a struct of all the feed's number columns, which
    ``typed`` and ``lossy_values`` then use instead of the text.

    Numbers and flags are columns of their own on the way, so that each is computed once per row
    however often it is used. Keep both halves with ``sources.tables.write_checked`` and split
    what it wrote: a filter on a frame that is not written is pushed below those columns, and
    then repeats the parsing of text.
    """
    if require:
        require_columns(df, rules)
    numbers = [c for c, kind in (feed or {}).items() if kind in NUMBER_TYPES and c in df.columns]
    numeric = [c for c in dict.fromkeys((*rules.positive, *rules.ranges, *numbers)) if c in df.columns]
    parsed = {c: f"_number_{i}" for i, c in enumerate(numeric)}
    numbered = df.select("*", *[number(df, c).alias(alias) for c, alias in parsed.items()])
    failed = failed_rules(df, rules, {c: F.col(alias) for c, alias in parsed.items()})
    flags = [F.col(f"_failed_{i}") for i in range(len(failed))]
    own = [column(c) for c in df.columns]
    if numbers:
        own.append(F.struct(*[F.col(parsed[c]).alias(c) for c in numbers]).alias(PARSED))
    flagged = numbered.select(*own, *[f.alias(f"_failed_{i}") for i, (_, f) in enumerate(failed)])
    reasons = [F.when(flag, F.lit(text)) for flag, (text, _) in zip(flags, failed, strict=True)]
    return flagged.select(
        *[column(c) for c in flagged.columns[: len(own)]],
        reduce(Column.__or__, flags, F.lit(False)).alias("rejected"),
        F.concat_ws(" ", *reasons).alias("rejection_reason"),
    )


def passed(checked: DataFrame) -> DataFrame:
    """Accepted rows with the feed's own columns, and their parsed numbers if the check kept them."""
    return checked.filter(~F.col("rejected")).drop("rejected", "rejection_reason", UNREADABLE)


def rejected(checked: DataFrame) -> DataFrame:
    """Rejected rows, each once, with the reason."""
    return checked.filter("rejected").drop("rejected", PARSED)


def stats(checked: DataFrame) -> DataFrame:
    """One row: records in, out and rejected, and the rejection rate in percent."""
    counts = checked.agg(
        F.count(F.lit(1)).alias("records_in"),
        F.count_if(F.col("rejected")).alias("records_rejected"),
    )
    return counts.select(
        "records_in",
        (F.col("records_in") - F.col("records_rejected")).alias("records_out"),
        "records_rejected",
        ratio_pct(F.col("records_rejected"), F.col("records_in")).alias("rejection_rate"),
    )


def reason_counts(checked: DataFrame) -> DataFrame:
    """Rejected rows per whole reason text."""
    return rejected(checked).groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("records"))


def top_reasons(checked: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent reason texts; ties in text order."""
    return reason_counts(checked).orderBy(F.desc("records"), "rejection_reason").limit(n)
