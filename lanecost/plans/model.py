"""The planning model: rate card, baseline cost and promised dates."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecost.functions.scalars import count_where
from lanecost.functions.shipments import (
    baseline_fuel,
    is_late,
    mode_upgraded,
    modeled_baseline,
    planned_base,
    promised_date,
    reference_rate,
)
from lanecost.operators.measures import parts_by
from lanecost.schemas import RATE_CARD_ROWS, RATE_CARD_SCHEMA, Star


def rate_card(spark: SparkSession) -> DataFrame:
    """Planning assumptions per mode, three rows."""
    rows = [
        (mode, Decimal(rate), days, Decimal(fuel), Decimal(handling), kind)
        for mode, rate, days, fuel, handling, kind in RATE_CARD_ROWS
    ]
    return spark.createDataFrame(rows, RATE_CARD_SCHEMA)


def baseline_model(star: Star, card: DataFrame) -> DataFrame:
    """Reference rate, planned base, fuel, handling and modeled baseline of each
    shipment, recomputed from the planned mode, the route factor and the weight."""
    routes = star.dim_route.select("route_id", "rate_factor")
    rates = card.select(
        F.col("mode").alias("planned_mode"),
        "reference_rate_inr_kg",
        "baseline_fuel_fraction",
        F.col("baseline_handling_inr").alias("handling"),
    )
    rows = star.fact_shipment.select("shipment_id", "planned_mode", "route_id", "weight_kg")
    rated = rows.join(routes, "route_id").join(rates, "planned_mode")
    rated = rated.withColumn(
        "rate", reference_rate(F.col("reference_rate_inr_kg"), F.col("rate_factor"))
    )
    rated = rated.withColumn("planned_base", planned_base(F.col("weight_kg"), F.col("rate")))
    rated = rated.withColumn(
        "fuel", baseline_fuel(F.col("planned_base"), F.col("baseline_fuel_fraction"))
    )
    return rated.select(
        "shipment_id",
        F.col("rate").alias("baseline_rate_inr_kg"),
        F.col("planned_base").alias("planned_base_inr"),
        F.col("fuel").alias("baseline_fuel_inr"),
        F.col("handling").alias("baseline_handling_inr"),
        modeled_baseline(F.col("planned_base"), F.col("fuel"), F.col("handling")).alias(
            "modeled_baseline_inr"
        ),
    )


def promised_dates(
    star: Star,
    card: DataFrame,
    slow_destinations: Sequence[str] = ("United States",),
    extra_days: int = 3,
) -> DataFrame:
    """Promised date of each shipment recomputed from dispatch, mode and route."""
    days = card.select(F.col("mode").alias("planned_mode"), "planned_transit_days")
    dispatch = star.dim_date.select(F.col("date_key").alias("ship_date_key"), "calendar_date")
    routes = star.dim_route.select("route_id", "destination_country")
    rows = star.fact_shipment.select("shipment_id", "ship_date_key", "route_id", "planned_mode")
    return (
        rows.join(dispatch, "ship_date_key")
        .join(routes, "route_id")
        .join(days, "planned_mode")
        .select(
            "shipment_id",
            promised_date(
                F.col("calendar_date"),
                F.col("planned_transit_days"),
                F.col("destination_country"),
                slow_destinations,
                extra_days,
            ).alias("promised_delivery_date"),
        )
    )


def mode_upgrades(fact: DataFrame) -> DataFrame:
    """Shipments and expedite fees per planned and actual mode, and whether the
    shipment was moved by another mode than planned."""
    names = ("total_shipments", "sum_expedite_fee_inr")
    grouped = parts_by(fact, ["planned_mode", "actual_mode"], names)
    return grouped.select(
        "planned_mode",
        "actual_mode",
        mode_upgraded().alias("mode_changed"),
        F.col("n").alias("shipments"),
        F.col("sum_expedite_fee_inr").alias("expedite_fee_inr"),
    )


def dataset_profile(fact: DataFrame) -> DataFrame:
    """One row: counts, span of dispatch keys, money, late and expedited
    shipments. Shipments are reduced to days before months are counted."""
    daily = fact.groupBy("ship_date_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("recorded_freight_inr").alias("recorded"),
        F.sum("modeled_baseline_inr").alias("baseline"),
        count_where(is_late()).alias("late"),
        F.sum("expedited_flag").alias("expedited"),
    )
    return daily.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("shipment_count"),
        F.count_distinct(F.expr("ship_date_key DIV 100")).alias("months"),
        F.min("ship_date_key").alias("ship_date_min"),
        F.max("ship_date_key").alias("ship_date_max"),
        F.sum("recorded").cast("decimal(26,2)").alias("recorded_freight_inr"),
        F.sum("baseline").cast("decimal(26,2)").alias("modeled_baseline_inr"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("late_shipments"),
        F.sum("expedited").alias("expedited_shipments"),
    )


def write_profile(profile: DataFrame, path: str) -> None:
    """The profile as one JSON record."""
    profile.coalesce(1).write.json(path)
