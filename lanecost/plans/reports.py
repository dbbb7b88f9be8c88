"""Datasets behind the three report pages.

Every function takes optional ``filters`` (label -> chosen members), the page
slicers and any picked chart member alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecost.operators.measures import measures
from lanecost.operators.ranking import top_with_ties
from lanecost.schemas import Star

OVERVIEW_CARDS = (
    "total_shipments",
    "recorded_freight_inr",
    "modeled_baseline_inr",
    "cost_variance_inr",
    "cost_variance_pct",
    "freight_per_shipment_inr",
    "missing_delivery_dates",
)
CARRIER_CARDS = ("delayed_shipments", "on_time_delivery_pct", "average_delay_days")
MONTHLY_TREND = (
    "recorded_freight_inr",
    "modeled_baseline_inr",
    "cost_variance_pct",
    "cost_variance_inr",
)
CARRIER_BAR = (
    "on_time_delivery_pct",
    "average_delay_days",
    "delayed_shipments",
    "total_shipments",
    "cost_variance_pct",
)
CARRIER_SCATTER = (
    "freight_per_shipment_inr",
    "on_time_delivery_pct",
    "total_shipments",
    "average_delay_days",
    "cost_variance_pct",
    "delivery_date_coverage_pct",
)
ROUTE_BAR = (
    "cost_variance_inr",
    "on_time_delivery_pct",
    "average_delay_days",
    "total_shipments",
    "recorded_freight_inr",
)
DELAY_REASONS = (
    "delayed_shipments",
    "average_delay_days",
    "recorded_freight_inr",
    "cost_variance_inr",
)
MODE_DELAYS = (
    "delay_rate_pct",
    "total_shipments",
    "delayed_shipments",
    "average_delay_days",
    "delivery_date_coverage_pct",
)


def overview_cards(star: Star, filters=None) -> DataFrame:
    return measures(star, OVERVIEW_CARDS, filters=filters)


def carrier_cards(star: Star, filters=None) -> DataFrame:
    return measures(star, CARRIER_CARDS, filters=filters)


def monthly_trend(star: Star, filters=None) -> DataFrame:
    return measures(star, MONTHLY_TREND, ["year_month"], filters).orderBy("year_month")


def carrier_bar(star: Star, filters=None) -> DataFrame:
    """Carriers without shipments are listed too: their delayed count is zero,
    not blank."""
    bars = measures(star, CARRIER_BAR, ["carrier_name"], filters, dense=True)
    return bars.orderBy(F.desc_nulls_last("on_time_delivery_pct"), "carrier_name")


def carrier_scatter(star: Star, filters=None) -> DataFrame:
    return measures(star, CARRIER_SCATTER, ["carrier_name"], filters)


def route_top(star: Star, n: int = 8, filters=None) -> DataFrame:
    """The routes with the largest cost variance, ties included."""
    bars = measures(star, ROUTE_BAR, ["route"], filters)
    return top_with_ties(bars, "cost_variance_inr", n).orderBy(
        F.desc("cost_variance_inr"), "route"
    )


def delay_reasons(star: Star, filters=None) -> DataFrame:
    bars = measures(star, DELAY_REASONS, ["delay_reason"], filters)
    return bars.orderBy(F.desc("delayed_shipments"), "delay_reason")


def mode_delays(star: Star, filters=None) -> DataFrame:
    bars = measures(star, MODE_DELAYS, ["actual_mode"], filters)
    return bars.orderBy(F.desc_nulls_last("delay_rate_pct"), "actual_mode")


def slicer_values(star: Star) -> DataFrame:
    """Members each page slicer offers, as text, in order."""
    lists = (
        ("calendar_year", star.dim_date.select("calendar_year")),
        ("carrier_name", star.dim_carrier.select("carrier_name")),
        ("actual_mode", star.fact_shipment.select("actual_mode")),
    )
    members = [
        df.distinct().select(
            F.lit(name).alias("slicer"), F.col(name).cast("string").alias("member")
        )
        for name, df in lists
    ]
    return reduce(DataFrame.unionByName, members).orderBy("slicer", "member")
