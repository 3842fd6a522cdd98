"""Saved API responses: pages, nested records, and what is wrong with them."""

import json

import pytest

from tidewater.operators import quality
from tidewater.operators.rules import rules_for
from tidewater.schemas import UNREADABLE, WAREHOUSE_FEED
from tidewater.sources import api


def record(n, **more):
    return {"id": f"API-{n}", "date": "2024-01-02", "site": {"region": "R", "shift": "Day"},
            "metrics": {"throughput_uph": 1.5, "units_processed": n}, "cost": {"per_unit": "2.50"}, **more}


def page(n, total, data, request="r"):
    return {"request_id": request, "page": n, "total_pages": total, "data": data}


RESPONSES = [
    json.dumps(page(1, 4, [record(1), record(2, site=None, note="n/a"), record(3, metrics="down"), None, 7])),
    json.dumps(page("2", 4, [])),
    json.dumps(page(3, 4, {"id": "x"})),
    json.dumps({"error": "down"}),
    "[1, 2]",
    "null",
    "  ",
    '{"request_id": "r", "page": 4, "data": [',
    json.dumps(page(1, 1, [record(4)], "s")),
]


@pytest.mark.parametrize("whole_files", [False, True])
def test_records_are_unfolded(spark, tmp_path, whole_files):
    if whole_files:
        for i, text in enumerate(RESPONSES):
            (tmp_path / f"{i}.json").write_text(text.replace(", ", ",\n"))
    else:
        (tmp_path / "all.json").write_text("\n".join(RESPONSES))
    feed = api.read_api(spark, str(tmp_path), whole_files)
    assert feed.columns == [*WAREHOUSE_FEED, UNREADABLE]
    rows = feed.collect()
    good = {r.order_id: r for r in rows if r[UNREADABLE] is None}
    assert set(good) == {"API-1", "API-2", "API-4"}
    one = good["API-1"]
    assert (one.order_date, one.region, one.shift, one.throughput_uph) == ("2024-01-02", "R", "Day", "1.5")
    assert (one.units_processed, one.cost_per_unit, one.sla_hours) == ("1", "2.50", None)
    assert good["API-2"].region is None
    # Two records and a missing one, and five responses without a list of records.
    lost = sorted(r[UNREADABLE] for r in rows if r[UNREADABLE] is not None)
    assert len(lost) == 8 and "7" in lost and lost.count("null") == 2
    assert all(v is None for r in rows if r[UNREADABLE] is not None for v in r[:-1])
    checked = quality.check(feed, rules_for("api"))
    assert quality.rejected(checked).count() == 9 and quality.passed(checked).count() == 2


def test_missing_pages(spark):
    pages = api.parse_pages(spark.createDataFrame([(r,) for r in RESPONSES], "value string"))
    assert sorted(map(tuple, api.missing_pages(pages).collect())) == [("r", 3), ("r", 4)]
    none = spark.createDataFrame([], "value string")
    assert api.missing_pages(api.parse_pages(none)).count() == 0 and api.unfold_records(api.parse_pages(none)).count() == 0


def test_clashing_names(spark):
    given = spark.createDataFrame([(RESPONSES[0], "x", "y")], "value string, data string, _p string")
    assert api.unfold_records(api.parse_pages(given)).count() == 5
