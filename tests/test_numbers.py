"""Number parsing agrees with the lenient parser that the pipeline's users come from."""

import math

import pandas as pd
from pyspark.sql import functions as F

from tidewater.functions.calendar import week_of_year
from tidewater.functions.numbers import number, ratio_pct
from tidewater.functions.text import MISSING_MARKERS, markers_to_null

ODD_TEXTS = [
    "1d", "1f", "1.5D", " 1f ", "0x1p3", "0x10", "1e400", "-1e400", "1e309", "inf", "-inf", "INF",
    "Infinity", "+inf", "infinity", " 5 ", "5\t", "\n5", "5\x0b", "5\x00", "1_000", "1,000", "",
    "abc", "NaN", "nan", "1e5", "1E5", "1e-3", ".5", "5.", ".", "+5", "-5", "--5", "True", "true",
    "1L", "1e", "e5", "12abc", "1 2", "null", "None", "-0", "007", "4.9e-325", "1.797e308",
]


def test_text_numbers_match_pandas(spark):
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "i int, c string")
    ours = [r.n for r in df.select("i", number(df, "c").alias("n")).orderBy("i").collect()]
    theirs = pd.to_numeric(pd.Series(ODD_TEXTS, dtype=object), errors="coerce")
    for text, a, b in zip(ODD_TEXTS, ours, theirs, strict=True):
        assert (a is None and math.isnan(b)) or a == b, text


def test_missing_markers_match_pandas(spark):
    import io

    csv = "c,d\n" + "".join(f"{m},1\n" for m in MISSING_MARKERS) + "kept,1\n NA,1\n"
    theirs = pd.read_csv(io.StringIO(csv))["c"].tolist()
    df = spark.createDataFrame([(m,) for m in (*MISSING_MARKERS, "kept", " NA")], "c string")
    ours = [r.c for r in markers_to_null(df).collect()]
    assert ours == [None if isinstance(v, float) else v for v in theirs]


def test_nan_is_missing_in_number_columns(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,), (math.inf,)], "x double")
    assert [r.n for r in df.select(number(df, "x").alias("n")).collect()] == [
        None, None, 2.0, math.inf,
    ]


def test_ratio(spark):
    cases = [(1, 4, 25.0), (0, 4, 0.0), (None, 4, 0.0), (3, 0, 0.0), (None, None, 0.0)]
    df = spark.createDataFrame(cases, "part int, whole int, expected double")
    rows = df.withColumn("r", ratio_pct(F.col("part"), F.col("whole"))).collect()
    assert all(r.r == r.expected for r in rows)


def test_week_of_year_counts_sundays(spark):
    """Brute force: the week grows on each Sunday and starts at 1 on January 1."""
    import datetime as dt

    days = [dt.date(1999, 1, 1) + dt.timedelta(i) for i in range(9500)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    ours = {r.d: r.w for r in df.select("d", week_of_year(F.col("d")).alias("w")).collect()}
    week = 1
    for d in days:
        if (d.month, d.day) == (1, 1):
            week = 1
        elif d.weekday() == 6:
            week += 1
        assert ours[d] == week, d
    assert ours[dt.date(2024, 1, 6)] == 1 and ours[dt.date(2000, 12, 31)] == 54
