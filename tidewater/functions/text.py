"""Missing-value markers in text feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.numbers import column
from tidewater.schemas import UNREADABLE

# The texts that a text feed uses for "no value".
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def markers_to_null(df: DataFrame) -> DataFrame:
    """Turn every missing-value marker in a string column into null.

    The text of an unreadable record stays, whatever it is.
    """
    return df.select(
        *[
            F.when(~column(f.name).isin(*MISSING_MARKERS), column(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name != UNREADABLE
            else column(f.name)
            for f in df.schema.fields
        ]
    )
