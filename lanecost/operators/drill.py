"""Drilling measures down year, quarter, month and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.functions.calendar import DRILL_LEVELS, drill_columns
from lanecost.operators.measures import measure_columns, parts_by, sum_parts
from lanecost.schemas import Star

# Which date a drill-down follows -> the shipment column it groups by.
ROLES = {
    "dispatch": "ship_date_key",
    "promised": "promised_delivery_date",
    "actual": "actual_delivery_date",
}


def drill_down(star: Star, role: str, names: Sequence[str]) -> DataFrame:
    """Measures at every level of the date hierarchy.

    ``level`` is 4 for a day, 3 month, 2 quarter, 1 year, 0 the grand total.
    Shipments without a date are grouped under NULL at each level. They are
    reduced to one row per day first, so the rollup expands days, not shipments.
    The delivery calendars span all dates present, hence their attributes are
    taken from the date itself (date part only) instead of by a join.
    """
    column = ROLES[role]
    if role == "dispatch":
        days = star.dim_date.select(
            F.col("date_key").alias(column), F.col("calendar_date").alias("day")
        )
        daily = parts_by(star.fact_shipment, [column], names).join(days, column, "left")
    else:
        day = F.to_date(F.col(column)).alias("day")
        daily = parts_by(star.fact_shipment, [day], names)
    parts = [c for c in daily.columns if c not in (column, "day")]
    daily = daily.select(*drill_columns(F.col("day")), *parts)
    rolled = sum_parts(daily, daily.rollup(*DRILL_LEVELS), _level())
    return rolled.select("level", *DRILL_LEVELS, *measure_columns(names))


def _level() -> Column:
    # grouping_id sets one bit per level rolled away.
    kept = F.lit(len(DRILL_LEVELS)) - F.bit_count(F.grouping_id())
    return kept.cast("int").alias("level")
