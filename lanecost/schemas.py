"""Column types, keys and limits of the five star tables and the rate card."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)
QUANTITY = T.DecimalType(12, 2)
# Sums of MONEY; room for ten billion rows of the largest amount.
MONEY_SUM = T.DecimalType(26, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_text, _int, _date = T.StringType(), T.IntegerType(), T.DateType()

SCHEMAS: dict[str, T.StructType] = {
    "dim_customer": _schema(
        customer_id=_int, customer_name=_text, segment=_text, data_type=_text
    ),
    "dim_carrier": _schema(carrier_id=_int, carrier_name=_text, data_type=_text),
    "dim_route": _schema(
        route_id=_int,
        origin_city=_text,
        destination_city=_text,
        destination_country=_text,
        route_type=_text,
        rate_factor=T.DecimalType(5, 2),
        data_type=_text,
    ),
    "dim_date": _schema(
        date_key=_int,
        calendar_date=_date,
        calendar_year=_int,
        month_number=_int,
        month_name=_text,
        year_month=_text,
        quarter_number=_int,
    ),
    "fact_shipment": _schema(
        shipment_id=_text,
        ship_date_key=_int,
        customer_id=_int,
        carrier_id=_int,
        route_id=_int,
        planned_mode=_text,
        actual_mode=_text,
        weight_kg=QUANTITY,
        promised_delivery_date=_date,
        actual_delivery_date=_date,
        base_freight_inr=MONEY,
        fuel_surcharge_inr=MONEY,
        handling_charge_inr=MONEY,
        expedite_fee_inr=MONEY,
        recorded_freight_inr=MONEY,
        baseline_rate_inr_kg=QUANTITY,
        baseline_fuel_inr=MONEY,
        baseline_handling_inr=MONEY,
        modeled_baseline_inr=MONEY,
        expedited_flag=_int,
        delay_reason=_text,
        data_type=_text,
    ),
}

# Tables in load order: dimensions first.
TABLES = tuple(SCHEMAS)

PRIMARY_KEYS = {
    "dim_customer": "customer_id",
    "dim_carrier": "carrier_id",
    "dim_route": "route_id",
    "dim_date": "date_key",
    "fact_shipment": "shipment_id",
}

# Shipment column -> the dimension and key it refers to.
FOREIGN_KEYS = {
    "customer_id": ("dim_customer", "customer_id"),
    "carrier_id": ("dim_carrier", "carrier_id"),
    "route_id": ("dim_route", "route_id"),
    "ship_date_key": ("dim_date", "date_key"),
}

# Longest text each column may hold.
TEXT_LIMITS = {
    "dim_customer": {"customer_name": 80, "segment": 40, "data_type": 30},
    "dim_carrier": {"carrier_name": 80, "data_type": 30},
    "dim_route": {
        "origin_city": 60,
        "destination_city": 60,
        "destination_country": 60,
        "route_type": 20,
        "data_type": 30,
    },
    "dim_date": {"month_name": 12, "year_month": 7},
    "fact_shipment": {
        "shipment_id": 16,
        "planned_mode": 10,
        "actual_mode": 10,
        "delay_reason": 40,
        "data_type": 30,
    },
}

# Fixed values of the data rules.
MODES = ("Road", "Sea", "Air")
SYNTHETIC = "SYNTHETIC"
NO_DELAY = "None"

RATE_CARD_SCHEMA = _schema(
    mode=_text,
    reference_rate_inr_kg=QUANTITY,
    planned_transit_days=_int,
    baseline_fuel_fraction=T.DecimalType(4, 2),
    baseline_handling_inr=MONEY,
    data_type=_text,
)

# The planning assumptions per mode.
RATE_CARD_ROWS = (
    ("Road", "18", 5, "0.12", "1800.00", "SYNTHETIC_ASSUMPTION"),
    ("Sea", "32", 24, "0.12", "1800.00", "SYNTHETIC_ASSUMPTION"),
    ("Air", "210", 4, "0.12", "1800.00", "SYNTHETIC_ASSUMPTION"),
)

RUN_LOG_SCHEMA = _schema(
    run_id=_text,
    ts=T.TimestampType(),
    status=_text,
    rows_processed=T.LongType(),
    message=_text,
)


def columns_of(table: str, kind: type[T.DataType]) -> list[str]:
    """Columns of a table that have the given Spark type."""
    return [f.name for f in SCHEMAS[table].fields if isinstance(f.dataType, kind)]


@dataclass(frozen=True)
class Star:
    """The five tables, bound by name. All are lazy DataFrames."""

    fact_shipment: DataFrame
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_carrier: DataFrame
    dim_route: DataFrame

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> Star:
        return cls(**{name: tables[name] for name in TABLES})

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}

    def with_fact(self, fact: DataFrame) -> Star:
        return replace(self, fact_shipment=fact)
