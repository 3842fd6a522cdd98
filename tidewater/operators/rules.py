"""Quality rule sets per source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RuleSet:
    """What a row must satisfy to be accepted.

    ``required``: columns the feed must have. ``non_null``: columns that must hold a value.
    ``positive``: columns that must hold a number above zero. ``ranges``: inclusive bounds;
    a missing value or text passes.
    """

    required: tuple[str, ...] = ()
    non_null: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)


# The rules of the two known feeds.
RULES: dict[str, RuleSet] = {
    "warehouse": RuleSet(
        required=(
            "order_id",
            "order_date",
            "region",
            "shift",
            "throughput_uph",
            "defect_rate_pct",
            "units_processed",
        ),
        non_null=("order_id", "order_date", "region"),
        positive=("throughput_uph", "units_processed"),
        ranges={
            "defect_rate_pct": (0, 100),
            "inventory_accuracy_pct": (0, 100),
            "dock_delay_hrs": (0, 48),
        },
    ),
    "finance": RuleSet(
        required=(
            "record_id",
            "month",
            "business_unit",
            "cost_center",
            "amount",
            "record_type",
        ),
        non_null=("record_id", "month", "business_unit"),
        positive=("amount",),
    ),
}

# Records of the operations API have the warehouse feed's columns and meet its rules.
RULES["api"] = RULES["warehouse"]


def rules_for(source: str) -> RuleSet:
    """Rules of a source; a source without rules accepts every row."""
    return RULES.get(source, RuleSet())
