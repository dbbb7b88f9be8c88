"""Shipment, monthly and growth views over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanecost.functions.scalars import safe_ratio
from lanecost.functions.shipments import (
    cost_variance,
    cost_variance_ratio,
    delay_days,
    on_time_flag,
)
from lanecost.schemas import FOREIGN_KEYS, Star

# Shipment columns the monthly view reads besides the dimension keys.
MONTHLY_COLUMNS = (
    "ship_date_key",
    "weight_kg",
    "promised_delivery_date",
    "actual_delivery_date",
    "expedite_fee_inr",
    "recorded_freight_inr",
    "modeled_baseline_inr",
    "expedited_flag",
)


def shipment_analysis(star: Star) -> DataFrame:
    """One row per shipment whose four keys resolve, with descriptions and derived
    columns. Customers grow with the shipments: they are merged at every size, so that
    what is shuffled grows as the input does. Spark broadcasts the other dimensions where
    they are small enough."""
    date = star.dim_date.select(
        F.col("date_key").alias("ship_date_key"),
        F.col("calendar_date").alias("ship_date"),
        "year_month",
    )
    customer = star.dim_customer.select("customer_id", "customer_name", "segment").hint("merge")
    carrier = star.dim_carrier.select("carrier_id", "carrier_name")
    route = star.dim_route.select(
        "route_id", "origin_city", "destination_city", "destination_country", "route_type"
    )
    fact = star.fact_shipment
    joined = (
        fact.join(date, "ship_date_key")
        .join(customer, "customer_id")
        .join(carrier, "carrier_id")
        .join(route, "route_id")
    )
    described = [c for d in (date, customer, carrier, route) for c in d.columns[1:]]
    return joined.select(
        *fact.columns,
        *described,
        delay_days().alias("delay_days"),
        on_time_flag().alias("on_time_flag"),
        cost_variance().alias("cost_variance_inr"),
        cost_variance_ratio().alias("cost_variance_ratio"),
    )


def monthly_logistics(
    star: Star, trusted_keys: bool = False, last_dispatch: bool = False
) -> DataFrame:
    """Totals and ratios per dispatch month.

    Like :func:`shipment_analysis` it leaves out shipments with an unknown key;
    semi joins do that without carrying any description. With ``trusted_keys``,
    for data that passed the foreign-key rules, those joins and the key columns
    they read are skipped. Either way shipments are first reduced to one row per
    dispatch day, and only days meet the calendar. ``last_dispatch`` adds the last
    dispatch date of each month, for :func:`monthly_growth_calendar`.
    """
    fact = star.fact_shipment
    if not trusted_keys:
        for key, (table, dimension_key) in FOREIGN_KEYS.items():
            if key != "ship_date_key":
                known = getattr(star, table).select(F.col(dimension_key).alias(key))
                fact = fact.join(known, key, "left_semi")
    daily = fact.groupBy("ship_date_key").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("recorded_freight_inr").alias("recorded"),
        F.sum("modeled_baseline_inr").alias("baseline"),
        F.sum(cost_variance()).alias("variance"),
        F.sum("weight_kg").alias("weight"),
        F.sum(on_time_flag()).alias("on_time"),
        F.sum("expedite_fee_inr").alias("fees"),
        F.sum("expedited_flag").alias("expedited"),
    )
    days = star.dim_date.select(
        F.col("date_key").alias("ship_date_key"), "calendar_date", "year_month"
    )
    month = (
        daily.join(days, "ship_date_key")
        .groupBy("year_month")
        .agg(
            *[F.sum(c).alias(c) for c in daily.columns[1:]],
            F.max("calendar_date").alias("last_dispatch_date"),
        )
    )

    def money(name: str):
        return F.col(name).cast("decimal(26,2)")

    return month.select(
        "year_month",
        "shipments",
        money("recorded").alias("recorded_freight_inr"),
        money("baseline").alias("modeled_baseline_inr"),
        money("variance").alias("cost_variance_inr"),
        safe_ratio(F.col("variance"), F.col("baseline")).alias("cost_variance_ratio"),
        safe_ratio(F.col("recorded"), F.col("weight")).alias("freight_per_kg_inr"),
        safe_ratio(F.col("on_time"), F.col("shipments")).alias("on_time_delivery_ratio"),
        money("fees").alias("expedite_fees_inr"),
        F.col("expedited").alias("expedited_shipments"),
        *(["last_dispatch_date"] if last_dispatch else []),
    )


def _growth(previous: str):
    change = F.col("recorded_freight_inr") - F.col(previous)
    return safe_ratio(change, F.col(previous))


def monthly_growth(monthly: DataFrame) -> DataFrame:
    """Adds the previous *available* month's freight and the growth over it.

    The window has no partition: its input is one row per month, whatever the
    number of shipments.
    """
    in_order = Window.orderBy("year_month")
    prior = F.lag("recorded_freight_inr").over(in_order)
    return monthly.withColumn("previous_month_freight_inr", prior).withColumn(
        "freight_growth_ratio", _growth("previous_month_freight_inr")
    )


def monthly_growth_calendar(monthly: DataFrame) -> DataFrame:
    """Growth that is NULL unless the row before is the calendar month before,
    and a flag on the last month when dispatches stop before its end. Takes the
    monthly view with ``last_dispatch``."""
    in_order = Window.orderBy("year_month")
    month = F.to_date(F.concat("year_month", F.lit("-01")))
    is_next = F.lag(month).over(in_order) == F.add_months(month, -1)
    ends_early = F.col("last_dispatch_date") < F.last_day("last_dispatch_date")
    is_last = F.lead("year_month").over(in_order).isNull()
    rows = monthly.select(
        "year_month",
        "recorded_freight_inr",
        F.when(is_next, F.lag("recorded_freight_inr").over(in_order)).alias(
            "previous_calendar_month_freight_inr"
        ),
        (is_last & F.coalesce(ends_early, F.lit(False))).alias("partial_month"),
    )
    return rows.withColumn(
        "calendar_growth_ratio", _growth("previous_calendar_month_freight_inr")
    )
