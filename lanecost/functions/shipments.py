"""Columns derived from one shipment row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanecost.functions.scalars import round_money, safe_ratio

CHARGES = ("base_freight_inr", "fuel_surcharge_inr", "handling_charge_inr", "expedite_fee_inr")


def is_late() -> Column:
    """True, false, or NULL when either date is missing."""
    return F.col("actual_delivery_date") > F.col("promised_delivery_date")


def is_on_time() -> Column:
    """True, false, or NULL when either date is missing."""
    return F.col("actual_delivery_date") <= F.col("promised_delivery_date")


def days_after_promise() -> Column:
    """Days from promised to actual delivery, negative when early."""
    return F.datediff("actual_delivery_date", "promised_delivery_date")


def delay_days() -> Column:
    """Days late, zero when early. ``greatest`` skips NULL, hence the guard."""
    return F.when(days_after_promise().isNotNull(), F.greatest(days_after_promise(), F.lit(0)))


def on_time_flag() -> Column:
    """1 on time, else 0; a missing date counts as 0 here."""
    return F.when(is_on_time(), F.lit(1)).otherwise(F.lit(0))


def cost_variance() -> Column:
    return F.col("recorded_freight_inr") - F.col("modeled_baseline_inr")


def cost_variance_ratio() -> Column:
    return safe_ratio(cost_variance(), F.col("modeled_baseline_inr"))


def route_label(origin: Column, destination: Column) -> Column:
    """Origin and destination as one label; a missing part is empty text."""
    blank = F.lit("")
    return F.concat(F.coalesce(origin, blank), F.lit(" → "), F.coalesce(destination, blank))


def recorded_freight() -> Column:
    """Sum of the four charge components."""
    total = F.col(CHARGES[0])
    for name in CHARGES[1:]:
        total = total + F.col(name)
    return total.cast("decimal(16,2)")


def reference_rate(mode_rate: Column, rate_factor: Column) -> Column:
    """Planned-mode rate per kg scaled by the route."""
    return F.round(mode_rate * rate_factor, 2).cast("decimal(12,2)")


def planned_base(weight: Column, rate: Column) -> Column:
    return round_money(weight * rate)


def baseline_fuel(base: Column, fraction: Column) -> Column:
    return round_money(base * fraction)


def modeled_baseline(base: Column, fuel: Column, handling: Column) -> Column:
    return (base + fuel + handling).cast("decimal(16,2)")


def promised_date(
    dispatch: Column,
    transit_days: Column,
    destination: Column,
    slow_destinations: Sequence[str] = ("United States",),
    extra_days: int = 3,
) -> Column:
    """Dispatch plus planned transit, plus extra days for far destinations."""
    extra = F.when(destination.isin(*slow_destinations), F.lit(extra_days)).otherwise(F.lit(0))
    return F.date_add(dispatch, transit_days + extra)


def mode_upgraded() -> Column:
    """True when the shipment moved by another mode than planned."""
    return F.col("planned_mode") != F.col("actual_mode")
