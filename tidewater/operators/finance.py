"""Finance facts from accepted finance rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.calendar import date_key, month_start

SOURCE = "finance_json"


def finance_cells(accepted: DataFrame) -> DataFrame:
    """Budget and actual sums per month, business unit and cost centre."""
    amount = F.col("amount").cast("decimal(18,2)")
    return accepted.groupBy("month", "business_unit", "cost_center").agg(
        F.sum(F.when(F.col("record_type") == "budget", amount)).alias("budget_amount"),
        F.sum(F.when(F.col("record_type") == "actual", amount)).alias("actual_amount"),
    )


class UnknownSourceError(LookupError):
    """The source dimension does not hold the finance feed."""


def _resolved(
    cells: DataFrame, dim_region: DataFrame, dim_cost_center: DataFrame, unit_regions: DataFrame
) -> DataFrame:
    """The cells with the keys that their names have, null where they have none."""
    regions = unit_regions.join(dim_region, unit_regions["region"] == dim_region["region_name"])
    centers = dim_cost_center.select("cost_center_key", F.col("cost_center_name").alias("cost_center"))
    return cells.join(regions.select("business_unit", "region_key"), "business_unit", "left").join(
        centers, "cost_center", "left"
    )


def finance_fact(
    cells: DataFrame,
    dim_region: DataFrame,
    dim_cost_center: DataFrame,
    dim_source: DataFrame,
    unit_regions: DataFrame,
) -> DataFrame:
    """The cells with their dimension keys and the variance, actual minus budget.

    ``unit_regions`` maps each business unit to a region name. Cells without a region or cost
    centre have no place in the fact table; ``finance_unmatched`` has them. The finance feed has
    no revenue or cost of goods, so those measures are not set. Raises when the source dimension
    does not hold the feed.
    """
    sources = dim_source.filter(F.col("source_name") == SOURCE).select("source_key").head(1)
    if not sources:
        raise UnknownSourceError(f"dim_source does not hold {SOURCE!r}")
    return (
        _resolved(cells, dim_region, dim_cost_center, unit_regions)
        .filter("region_key IS NOT NULL AND cost_center_key IS NOT NULL")
        .select(
            date_key(month_start(F.col("month"))).alias("date_key"),
            "region_key",
            "cost_center_key",
            F.lit(sources[0][0]).alias("source_key"),
            "budget_amount",
            "actual_amount",
            (F.col("actual_amount") - F.col("budget_amount")).alias("variance_amount"),
            F.lit(SOURCE).alias("record_source"),
        )
    )


def finance_unmatched(
    cells: DataFrame, dim_region: DataFrame, dim_cost_center: DataFrame, unit_regions: DataFrame
) -> DataFrame:
    """The cells that ``finance_fact`` leaves out, with their amounts and what has no key.

    ``unmatched`` names the columns, blank-separated.
    """
    reasons = [
        F.when(F.col("region_key").isNull(), F.lit("business_unit")),
        F.when(F.col("cost_center_key").isNull(), F.lit("cost_center")),
    ]
    found = _resolved(cells, dim_region, dim_cost_center, unit_regions)
    return found.filter("region_key IS NULL OR cost_center_key IS NULL").select(
        "month",
        "business_unit",
        "cost_center",
        "budget_amount",
        "actual_amount",
        F.concat_ws(" ", *reasons).alias("unmatched"),
    )
