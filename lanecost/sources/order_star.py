"""Star tables over order tables.

Reads ``lineitem orders customer supplier part nation region`` Parquet and
presents one line item as one shipment, the supplier as carrier, the pair of
nations as route. Every parent is joined LEFT on its primary key, so a parent
whose columns nobody asks for can be left out without changing the rows:
``columns`` names the shipment columns a query needs, and only the parents
behind those are read and joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecost.functions.calendar import calendar_columns, spanning_date_dimension
from lanecost.functions.scalars import key_of_date
from lanecost.functions.shipments import modeled_baseline, recorded_freight
from lanecost.schemas import SCHEMAS, SYNTHETIC, TEXT_LIMITS, Star

SHIPMENT_COLUMNS = tuple(SCHEMAS["fact_shipment"].fieldNames())

# The four-part shipment id grows with the tables.
SHIPMENT_TEXT_LIMITS = {"fact_shipment": TEXT_LIMITS["fact_shipment"] | {"shipment_id": 80}}

_BY_MODE = {"planned_mode", "actual_mode"}
_BY_DATE = {"promised_delivery_date", "delay_reason"}
_BY_RATE = {"baseline_rate_inr_kg", "baseline_fuel_inr", "modeled_baseline_inr"}

# Days always in the dispatch calendar. Data outside adds its years, see dates().
CALENDAR_SPAN = ("1970-01-01", "2069-12-31")


# Columns read from each table; given, so that opening a table needs no job.
_SOURCES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double",
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.schema(_SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _order_side(spark: SparkSession, sf_dir: str, with_nation: bool) -> DataFrame:
    """One row per order. Customer and nation are joined here, on the order
    side, so the far larger line items are shuffled once, by order."""
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    if not with_nation:
        return orders
    customer = source(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = source(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        nation, customer.c_nationkey == nation.n_nationkey, "left"
    )


def shipments(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """``fact_shipment`` rows with the named columns, in schema order."""
    wanted = set(SHIPMENT_COLUMNS if columns is None else columns)
    unknown = wanted - set(SHIPMENT_COLUMNS)
    if unknown:
        raise ValueError(f"unknown shipment columns: {sorted(unknown)}")

    # Values are read as what a shipment holds before they are shuffled: whole numbers of
    # cents and days take less than half the room of doubles and timestamps.
    df = source(spark, sf_dir, "lineitem").selectExpr(*_LINES)
    absent = []

    # Prices first: where part is too large to broadcast, line items are shuffled by part
    # before they carry anything of their order.
    if wanted & _BY_RATE:
        rate = F.col("p_retailprice").cast(SCHEMAS["fact_shipment"]["baseline_rate_inr_kg"].dataType)
        part = source(spark, sf_dir, "part").select("p_partkey", rate.alias("baseline_rate_inr_kg"))
        df = df.join(part, df.l_partkey == part.p_partkey, "left").drop("p_partkey")
    else:
        absent += ["CAST(NULL AS DECIMAL(12,2)) AS baseline_rate_inr_kg"]
    need_nation = bool(wanted & (_BY_DATE | {"route_id"}))
    if need_nation or wanted & (_BY_MODE | {"customer_id"}):
        orders = _order_side(spark, sf_dir, need_nation)
        df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
    else:
        absent += ["bigint(NULL) AS o_custkey", "string(NULL) AS o_orderpriority"]
    if not need_nation:
        absent += ["int(NULL) AS c_nationkey", "int(NULL) AS n_regionkey"]
    if "route_id" in wanted:
        supplier = source(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        df = df.join(supplier, df.l_suppkey == supplier.s_suppkey, "left")
        df = df.withColumn("route_base", route_base(spark, sf_dir))
    else:
        absent += ["int(NULL) AS s_nationkey", "int(NULL) AS route_base"]

    df = df.selectExpr("*", *absent)
    for step in _DERIVED:
        df = df.withColumns({name: F.expr(value) if isinstance(value, str) else value() for name, value in step.items()})
    return df.select(*[c for c in SHIPMENT_COLUMNS if c in wanted])


# What a shipment needs of its line item alone.
_LINES = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "CAST(l_shipdate AS DATE) AS ship_date",
    "CAST(l_quantity AS DECIMAL(12,2)) AS weight_kg",
    "CAST(l_extendedprice AS DECIMAL(16,2)) AS base_freight_inr",
    "CAST(l_tax AS DECIMAL(4,2)) AS tax",
    "CAST(l_discount AS DECIMAL(4,2)) AS discount",
    "IF(l_returnflag = 'R', 1, 0) AS expedited_flag",
)

# Shipment columns from the joined row, each step using the ones before it.
# Catalyst drops whatever a query does not select.
_DERIVED: tuple[dict[str, str | Callable[[], Column]], ...] = (
    {
        "planned_mode": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Air' "
        "WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'Road' ELSE 'Sea' END",
        "handling_charge_inr": "CAST(1800 AS DECIMAL(16,2))",
        "baseline_handling_inr": "CAST(1800 AS DECIMAL(16,2))",
        "shipment_id": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
        "customer_id": "o_custkey",
        "carrier_id": "l_suppkey",
        "route_id": "IF(c_nationkey BETWEEN 0 AND route_base - 1, s_nationkey * route_base + c_nationkey, NULL)",
        "actual_days": "CAST(1 + (l_orderkey + l_partkey) % 30 AS INT)",
        "data_type": f"'{SYNTHETIC}'",
    },
    {
        "ship_date_key": "year(ship_date) * 10000 + month(ship_date) * 100 + day(ship_date)",
        "actual_mode": "CASE WHEN planned_mode = 'Sea' AND expedited_flag = 1 THEN 'Air' "
        "ELSE planned_mode END",
        "fuel_surcharge_inr": "CAST(round(base_freight_inr * tax, 2) "
        "AS DECIMAL(16,2))",
        "expedite_fee_inr": "CAST(CASE WHEN expedited_flag = 1 THEN "
        "round(base_freight_inr * discount, 2) ELSE 0 END "
        "AS DECIMAL(16,2))",
        "planned_base_inr": "CAST(round(weight_kg * baseline_rate_inr_kg, 2) AS DECIMAL(16,2))",
        "planned_days": "CASE planned_mode WHEN 'Road' THEN 5 WHEN 'Sea' THEN 24 ELSE 4 END "
        "+ IF(n_regionkey = 1, 3, 0)",
    },
    {
        "promised_delivery_date": "date_add(ship_date, planned_days)",
        "actual_delivery_date": "date_add(ship_date, actual_days)",
        "baseline_fuel_inr": "CAST(round(planned_base_inr * 0.12, 2) AS DECIMAL(16,2))",
    },
    {
        "recorded_freight_inr": recorded_freight,
        "modeled_baseline_inr": lambda: modeled_baseline(
            F.col("planned_base_inr"), F.col("baseline_fuel_inr"), F.col("baseline_handling_inr")
        ),
        "delay_reason": "CASE WHEN actual_delivery_date <= promised_delivery_date THEN 'None' "
        "WHEN l_linenumber % 3 = 0 THEN 'Weather' "
        "WHEN l_linenumber % 3 = 1 THEN 'Capacity constraint' ELSE 'Documentation' END",
    },
)


def ordered_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant for the date rules: dispatched on the order date, delivered on the
    ship date. The two are unrelated in the data, so deliveries before dispatch
    are frequent. Other columns as in :func:`shipments`."""
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    delivered = F.col("l_shipdate").cast("date")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left").select(
        key_of_date(F.col("o_orderdate").cast("date")).alias("ship_date_key"),
        delivered.alias("promised_delivery_date"),
        delivered.alias("actual_delivery_date"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(SYNTHETIC).alias("data_type"),
    )


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("carrier_id"),
        F.col("s_name").alias("carrier_name"),
        F.lit(SYNTHETIC).alias("data_type"),
    )


def route_base(spark: SparkSession, sf_dir: str) -> Column:
    """The factor of the origin in a route key: more than any nation's key, so that no
    two lanes share one. Asked for by the query that reads it."""
    last = F.coalesce(F.max("n_nationkey"), F.lit(0))
    return source(spark, sf_dir, "nation").agg(F.greatest(last + 1, F.lit(100)).alias("base")).scalar()


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lanes between nations. Each origin lists the keys that a destination can have,
    and an equi-join keeps the ones that are nations."""
    region = source(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("region"), F.col("r_name").alias("destination_country")
    )
    nation = source(spark, sf_dir, "nation")
    base = route_base(spark, sf_dir)
    destination = nation.select(
        F.col("n_nationkey").alias("code"),
        F.col("n_name").alias("destination_city"),
        F.col("n_regionkey").alias("region"),
    ).join(region, "region", "inner")
    origin = nation.select(
        F.col("n_nationkey").alias("origin"),
        F.col("n_name").alias("origin_city"),
        F.col("n_regionkey").alias("origin_region"),
        base.alias("base"),
    ).withColumn("code", F.explode(F.sequence(F.lit(0), F.col("base") - 1)))
    return origin.join(destination, "code", "inner").select(
        (F.col("origin") * F.col("base") + F.col("code")).cast("int").alias("route_id"),
        "origin_city",
        "destination_city",
        "destination_country",
        F.when(F.col("origin_region") == F.col("region"), "Domestic")
        .otherwise("Export")
        .alias("route_type"),
        (F.lit(Decimal("0.8")) + F.lit(Decimal("0.2")) * F.col("region"))
        .cast("decimal(5,2)")
        .alias("rate_factor"),
        F.lit(SYNTHETIC).alias("data_type"),
    )


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch calendar for joins: the usual span, and all years from the first to the
    last one in which something was shipped. The years outside the span are asked for
    when the calendar is, and Parquet statistics answer whether there are any; the line
    items themselves are only read if so."""
    first, last = (date.fromisoformat(d) for d in CALENDAR_SPAN)
    outside = source(spark, sf_dir, "lineitem").where(
        (F.col("l_shipdate") < F.lit(f"{first}").cast("timestamp_ntz"))
        | (F.col("l_shipdate") >= F.lit(f"{last.year + 1}-01-01").cast("timestamp_ntz"))
    )
    year = F.year("l_shipdate")
    span = outside.agg(F.min(year).alias("low"), F.max(year).alias("high"))
    one, twelve, end = F.lit(1), F.lit(12), F.lit(31)
    start = F.make_date(F.least("low", F.lit(first.year)), one, one)
    stop = F.make_date(F.greatest("high", F.lit(last.year)), twelve, end)
    return span.select(F.explode(F.sequence(start, stop)).alias("day")).select(*calendar_columns(F.col("day")))


def observed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch calendar of the ship years present, for member lists."""
    return spanning_date_dimension(source(spark, sf_dir, "lineitem"), "l_shipdate")


def order_star(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> Star:
    """The star over one directory of order tables."""
    return Star(
        fact_shipment=shipments(spark, sf_dir, columns),
        dim_date=dates(spark, sf_dir),
        dim_customer=customers(spark, sf_dir),
        dim_carrier=carriers(spark, sf_dir),
        dim_route=routes(spark, sf_dir),
    )
