import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators import quality
from tidewater.operators.rules import RULES, RuleSet, rules_for

COLUMNS = (
    "order_id string, order_date string, region string, shift string, throughput_uph string,"
    " dock_delay_hrs double, defect_rate_pct string, inventory_accuracy_pct double,"
    " units_processed int"
)
GOOD = {
    "order_id": "ORD-1",
    "order_date": "2024-01-05",
    "region": "Region 1",
    "shift": "Day",
    "throughput_uph": "115.5",
    "dock_delay_hrs": 2.5,
    "defect_rate_pct": "2.8",
    "inventory_accuracy_pct": 95.5,
    "units_processed": 100,
}


# Change to a good row, and the reason it is then rejected for.
CASES = [
    ({}, ""),
    ({"order_id": None}, "null:order_id"),
    ({"order_date": None}, "null:order_date"),
    ({"region": None}, "null:region"),
    ({"units_processed": None}, "non_positive:units_processed"),
    ({"units_processed": 0}, "non_positive:units_processed"),
    ({"throughput_uph": "abc"}, "non_positive:throughput_uph"),
    ({"throughput_uph": "1d"}, "non_positive:throughput_uph"),
    ({"throughput_uph": "-99"}, "non_positive:throughput_uph"),
    ({"throughput_uph": "inf"}, ""),
    ({"dock_delay_hrs": None}, ""),
    ({"dock_delay_hrs": math.nan}, ""),
    ({"dock_delay_hrs": 0.0}, ""),
    ({"dock_delay_hrs": 48.0}, ""),
    ({"dock_delay_hrs": 48.01}, "out_of_range:dock_delay_hrs"),
    ({"dock_delay_hrs": -0.01}, "out_of_range:dock_delay_hrs"),
    ({"defect_rate_pct": "abc"}, ""),
    ({"defect_rate_pct": "0"}, ""),
    ({"defect_rate_pct": "100"}, ""),
    ({"defect_rate_pct": "1e400"}, ""),
    ({"defect_rate_pct": "inf"}, "out_of_range:defect_rate_pct"),
    (
        {"order_id": None, "throughput_uph": "-99", "defect_rate_pct": "150"},
        "null:order_id non_positive:throughput_uph out_of_range:defect_rate_pct",
    ),
]


def test_rules(spark):
    rows = [(i, *{**GOOD, **change}.values()) for i, (change, _) in enumerate(CASES)]
    df = quality.check(spark.createDataFrame(rows, "i int, " + COLUMNS), RULES["warehouse"])
    for row in df.collect():
        change, reason = CASES[row.i]
        assert (row.rejected, row.rejection_reason) == (bool(reason), reason), change


def test_missing_required_column(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], COLUMNS).drop("shift")
    with pytest.raises(quality.MissingColumnsError, match=r"The feed lacks required columns: \['shift'\]"):
        quality.check(df, RULES["warehouse"])
    assert quality.check(df, RULES["warehouse"], require=False).count() == 1


def test_rule_on_absent_column_is_skipped(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], COLUMNS).drop("dock_delay_hrs")
    assert not quality.check(df, RULES["warehouse"]).first().rejected


def test_unknown_source_accepts_all(spark):
    df = spark.createDataFrame([(None, -5)], "order_id string, units_processed int")
    out = quality.check(df, rules_for("upload"))
    assert quality.passed(out).count() == 1
    assert quality.rejected(out).count() == 0


def test_nan_in_a_mandatory_column(spark):
    df = spark.createDataFrame([(math.nan,), (1.0,)], "x double")
    assert quality.rejected(quality.check(df, RuleSet(non_null=("x",)))).count() == 1


def test_odd_column_names(spark):
    df = spark.createDataFrame([(None, 1)], "`a.b c` string, `x``y` int")
    out = quality.check(df, RuleSet(non_null=("a.b c",), positive=("x`y",)))
    assert out.first().rejection_reason == "null:a.b c"


def test_empty_feed(spark):
    out = quality.check(spark.createDataFrame([], COLUMNS), RULES["warehouse"])
    assert quality.stats(out).first().asDict() == {
        "records_in": 0,
        "records_out": 0,
        "records_rejected": 0,
        "rejection_rate": 0.0,
    }


def test_against_pandas(spark):
    """Random rows through the same rules written with pandas masks."""
    rng = np.random.default_rng(7)
    n = 2000
    pdf = pd.DataFrame(
        {
            "order_id": np.where(rng.random(n) < 0.1, None, "ORD"),
            "order_date": np.where(rng.random(n) < 0.05, None, "2024-01-05"),
            "region": np.where(rng.random(n) < 0.05, None, "Region 1"),
            "throughput_uph": rng.choice(["115", "-99", "0", "abc", "1d", None, "NaN", "1e2"], n),
            "units_processed": rng.choice(["5", "0", "x", None, "7.5"], n),
            "defect_rate_pct": rng.choice(["2", "150", "-1", "abc", None, "inf", "100"], n),
            "inventory_accuracy_pct": rng.choice([50.0, 100.0, 100.5, -0.5, np.nan], n),
            "dock_delay_hrs": rng.choice([0.0, 48.0, 60.0, np.nan], n),
        }
    )
    rules = RULES["warehouse"]
    reasons = [[] for _ in range(n)]

    def note(mask, text):
        for i in np.flatnonzero(mask):
            reasons[i].append(text)

    for c in rules.non_null:
        note(pdf[c].isna(), f"null:{c}")
    for c in rules.positive:
        note(~(pd.to_numeric(pdf[c], errors="coerce") > 0), f"non_positive:{c}")
    for c, (low, high) in rules.ranges.items():
        values = pd.to_numeric(pdf[c], errors="coerce")
        note(values.notna() & ~values.between(low, high), f"out_of_range:{c}")

    rows = [
        tuple(None if v is None or v != v and c == "order_id" else v for c, v in zip(pdf, r))
        for r in pdf.itertuples(index=False)
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, order_id string, order_date string, region string, throughput_uph string,"
        " units_processed string, defect_rate_pct string, inventory_accuracy_pct double,"
        " dock_delay_hrs double",
    )
    out = quality.check(df, rules, require=False)
    ours = {r.i: r.rejection_reason for r in out.select("i", "rejection_reason").collect()}
    assert ours == {i: " ".join(r) for i, r in enumerate(reasons)}
    stats = quality.stats(out).first()
    assert stats.records_rejected == sum(map(bool, reasons))
    assert stats.records_in == stats.records_out + stats.records_rejected
    assert quality.passed(out).columns == df.columns
    assert quality.rejected(out).filter(F.col("rejection_reason") == "").count() == 0
    expected = pd.Series([" ".join(r) for r in reasons if r]).value_counts()
    top = quality.top_reasons(out).collect()
    assert [r.records for r in top] == expected.tolist()[:5]
    assert all(expected[r.rejection_reason] == r.records for r in top)
