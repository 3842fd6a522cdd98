"""Number handling: lenient parsing, NaN removal, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark parses more spellings than a plain decimal reader does (a trailing d or f, hex floats,
# control characters), so text has to look like one of these before it is cast.
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITE_WORD = r"(?i)^\s*[+-]?inf(inity)?\s*$"
LARGEST_DOUBLE = 1.7976931348623157e308


def column(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def number(df: DataFrame, name: str) -> Column:
    """``name`` as a number, null where it is missing, NaN or not a number.

    Text that overflows a double ("1e400") is no number; the word "inf" is one.
    """
    c = column(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        value = c.try_cast("double")
        fits = F.abs(value) <= LARGEST_DOUBLE
        return F.when((c.rlike(PLAIN_NUMBER) & fits) | c.rlike(INFINITE_WORD), value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.nanvl(c, F.lit(None).cast(kind))
    if isinstance(kind, T.BooleanType):
        return c.cast("double")
    return c


def ratio_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0 where there is nothing to divide or to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0))


def money(unit_price: Column, units: Column) -> Column:
    """Exact price times whole units at two decimals."""
    return (unit_price.cast("decimal(8,2)") * units.cast("int")).cast("decimal(12,2)")
