"""Date tables: the dispatch calendar and the per-column drill calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecost.functions.scalars import key_of_date

DRILL_LEVELS = ("Year", "QuarterNo", "MonthNo", "Day")


def calendar_columns(date: Column) -> list[Column]:
    """The ``dim_date`` row of a date."""
    return [
        key_of_date(date).alias("date_key"),
        date.alias("calendar_date"),
        F.year(date).alias("calendar_year"),
        F.month(date).alias("month_number"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.date_format(date, "yyyy-MM").alias("year_month"),
        F.quarter(date).alias("quarter_number"),
    ]


def drill_columns(date: Column) -> list[Column]:
    """Year, quarter, month and day attributes used for drilling down."""
    quarter = F.floor((F.month(date) + 2) / 3).cast("int")
    return [
        date.alias("Date"),
        F.year(date).alias("Year"),
        F.month(date).alias("MonthNo"),
        F.date_format(date, "MMMM").alias("Month"),
        quarter.alias("QuarterNo"),
        F.concat(F.lit("Qtr "), quarter.cast("string")).alias("Quarter"),
        F.dayofmonth(date).alias("Day"),
    ]


def date_dimension(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One ``dim_date`` row per day of a closed range of ISO dates.

    Built from ``spark.range`` so that its size is known when Spark plans joins.
    """
    from datetime import date

    start = date.fromisoformat(first)
    days = (date.fromisoformat(last) - start).days + 1
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(days).select(day.alias("day")).select(*calendar_columns(F.col("day")))


def whole_years(values: DataFrame, column: str) -> DataFrame:
    """Every day (column ``day``) from 1 January of the first year in ``column``
    to 31 December of the last. Empty when the column holds no date."""
    date = F.to_date(F.col(column))
    span = values.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    one, twelve, end = F.lit(1), F.lit(12), F.lit(31)
    return span.where(F.col("first").isNotNull()).select(
        F.explode(
            F.sequence(
                F.make_date(F.year("first"), one, one),
                F.make_date(F.year("last"), twelve, end),
            )
        ).alias("day")
    )


def auto_calendar(values: DataFrame, column: str) -> DataFrame:
    """Drill calendar covering the years of one date column."""
    return whole_years(values, column).select(*drill_columns(F.col("day")))


def spanning_date_dimension(values: DataFrame, column: str) -> DataFrame:
    """``dim_date`` rows covering the years of one date column."""
    return whole_years(values, column).select(*calendar_columns(F.col("day")))
