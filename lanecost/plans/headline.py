"""Headline figures and the rates behind the findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecost.functions.scalars import count_where, percent_2dp, safe_ratio
from lanecost.functions.shipments import (
    cost_variance,
    days_after_promise,
    is_late,
    is_on_time,
)
from lanecost.schemas import SYNTHETIC, Star


def is_not_synthetic():
    """Marker missing or other than SYNTHETIC, whatever its case and padding."""
    marker = F.col("data_type")
    return marker.isNull() | (F.upper(F.trim(marker)) != SYNTHETIC)


def headline_totals(star: Star) -> DataFrame:
    """One row of totals. Distinct ids are counted in a query of their own, so
    that only ids are shuffled and the sums stay map-side."""
    fact = star.fact_shipment
    distinct_ids = fact.agg(F.count_distinct("shipment_id")).scalar()
    zero = F.lit(0).cast("bigint")
    totals = fact.agg(
        F.count(F.lit(1)).alias("total_shipments"),
        count_where(
            F.col("actual_delivery_date").isNull() | F.col("promised_delivery_date").isNull()
        ).alias("missing"),
        count_where(is_not_synthetic()).alias("marked"),
        F.sum("recorded_freight_inr").alias("recorded"),
        F.sum("modeled_baseline_inr").alias("baseline"),
    )
    variance = F.col("recorded") - F.col("baseline")
    some = F.col("total_shipments") > zero
    return totals.select(
        "total_shipments",
        (F.col("total_shipments") - distinct_ids).alias("duplicate_or_null_ids"),
        F.when(some, F.col("missing")).alias("missing_delivery_dates"),
        F.when(some, F.col("marked")).alias("non_synthetic_rows"),
        F.col("recorded").alias("recorded_freight_inr"),
        F.col("baseline").alias("modeled_baseline_inr"),
        variance.cast("decimal(26,2)").alias("cost_variance_inr"),
        (safe_ratio(variance, F.col("baseline")) * F.lit(100.0)).alias("cost_variance_pct"),
        safe_ratio(F.col("recorded"), F.col("total_shipments")).alias(
            "freight_per_shipment_inr"
        ),
    )


def headline_delivery(fact: DataFrame) -> DataFrame:
    """On-time and delayed counts; the percentage is over rows with both dates."""
    both = F.col("actual_delivery_date").isNotNull() & F.col("promised_delivery_date").isNotNull()
    counts = fact.agg(
        count_where(is_on_time()).alias("on_time_shipments"),
        count_where(is_late()).alias("delayed_shipments"),
        count_where(both).alias("evaluable"),
        F.avg(F.when(is_late(), days_after_promise())).alias("average_delay_days_delayed_only"),
    )
    ratio = safe_ratio(F.col("on_time_shipments"), F.col("evaluable"))
    return counts.select(
        "on_time_shipments",
        "delayed_shipments",
        (ratio * F.lit(100.0)).alias("on_time_delivery_pct"),
        "average_delay_days_delayed_only",
    )


def delay_rate_by_mode(fact: DataFrame) -> DataFrame:
    """Delayed share of all shipments per executed mode."""
    counts = fact.groupBy("actual_mode").agg(
        F.count(F.lit(1)).alias("shipments"),
        count_where(is_late()).alias("delayed_shipments"),
    )
    rate = percent_2dp(F.col("delayed_shipments"), F.col("shipments"))
    return counts.withColumn("delay_rate_pct", rate).orderBy("actual_mode")


def ontime_by_carrier(star: Star) -> DataFrame:
    """On-time share of all shipments per carrier. Names join the totals."""
    counts = star.fact_shipment.groupBy("carrier_id").agg(
        F.count(F.lit(1)).alias("shipments"),
        count_where(is_on_time()).alias("on_time_shipments"),
    )
    rate = percent_2dp(F.col("on_time_shipments"), F.col("shipments"))
    named = counts.join(star.dim_carrier.select("carrier_id", "carrier_name"), "carrier_id")
    return named.select(
        "carrier_id",
        "carrier_name",
        "shipments",
        "on_time_shipments",
        rate.alias("on_time_delivery_pct"),
    ).orderBy(F.desc("on_time_delivery_pct"), "carrier_id")


def variance_by_route(star: Star) -> DataFrame:
    """Cost variance per route, in money and percent. Cities join the totals."""
    totals = star.fact_shipment.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum(cost_variance()).cast("decimal(26,2)").alias("cost_variance_inr"),
        F.sum("modeled_baseline_inr").alias("baseline"),
    )
    cities = star.dim_route.select("route_id", "origin_city", "destination_city")
    return (
        totals.join(cities, "route_id")
        .select(
            "route_id",
            "origin_city",
            "destination_city",
            "shipments",
            "cost_variance_inr",
            percent_2dp(F.col("cost_variance_inr"), F.col("baseline")).alias(
                "cost_variance_pct"
            ),
        )
        .orderBy(F.desc("cost_variance_inr"), "route_id")
    )
