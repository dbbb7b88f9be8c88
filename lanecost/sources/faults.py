"""Shipments with known faults, to exercise the data rules on any amount of data.

Weights in the order tables are whole kilograms from 1 to 50; each weight from 33
up stands for one kind of fault, so about a third of all rows gets one.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecost.schemas import Star

# Weight -> (column, SQL of its faulty value): a missing amount, then a fault for each rule
# from C5 to C19 by its number, a blank text and a missing key.
FAULTS = {
    33: ("base_freight_inr", "CAST(NULL AS DECIMAL(16,2))"),
    34: ("handling_charge_inr", "CAST(-250 AS DECIMAL(16,2))"),
    35: ("ship_date_key", "19000101"),
    36: ("promised_delivery_date", "DATE '1969-07-20'"),
    37: ("weight_kg", "CAST(-weight_kg AS DECIMAL(12,2))"),
    38: ("planned_mode", "concat(planned_mode, ' by pipeline')"),
    39: ("expedited_flag", "expedited_flag - 2"),
    40: ("baseline_handling_inr", "CAST(-0.5 AS DECIMAL(16,2))"),
    41: ("modeled_baseline_inr", "CAST(0 AS DECIMAL(16,2))"),
    42: ("baseline_fuel_inr", "CAST(baseline_fuel_inr + 1 AS DECIMAL(16,2))"),
    43: ("route_id", "-route_id - 1"),
    44: ("expedite_fee_inr", "CAST(expedite_fee_inr + 0.01 AS DECIMAL(16,2))"),
    45: ("delay_reason", "'None'"),
    46: ("delay_reason", "'Port congestion'"),
    47: ("data_type", "lower(data_type)"),
    48: ("actual_delivery_date", "DATE '2150-06-30'"),
    49: ("actual_mode", "concat(chr(9), ' ')"),
    50: ("customer_id", "CAST(NULL AS BIGINT)"),
}


def with_faults(fact: DataFrame) -> DataFrame:
    """The shipments with one fault in each row of the listed weights."""
    return fact.selectExpr(*[f"{fault_sql(c)} AS {c}" for c in fact.columns])


def fault_sql(column: str) -> str:
    """A column with its faults, in SQL."""
    cases = [f"WHEN weight_kg = {w} THEN {value}" for w, (c, value) in FAULTS.items() if c == column]
    return f"CASE {' '.join(cases)} ELSE {column} END" if cases else column


def with_gaps(fact: DataFrame) -> DataFrame:
    """Shipments with missing dates, ids and markers, baselines of zero, repeated ids,
    and every fourth month left out; of the columns there are."""
    gaps = {
        "actual_delivery_date": "IF(weight_kg IN (50, 3), NULL, actual_delivery_date)",
        "promised_delivery_date": "IF(weight_kg IN (49, 3), NULL, promised_delivery_date)",
        "modeled_baseline_inr": "IF(route_id % 7 = 0, CAST(0 AS DECIMAL(16,2)), modeled_baseline_inr)",
        "data_type": "CASE weight_kg WHEN 48 THEN ' synthetic ' WHEN 47 THEN NULL "
        "WHEN 46 THEN 'MEASURED' ELSE data_type END",
        "shipment_id": "CASE weight_kg WHEN 45 THEN NULL WHEN 44 THEN 'again' ELSE shipment_id END",
    }
    kept = fact.where("ship_date_key DIV 100 % 4 <> 2")
    return kept.selectExpr(*[f"{gaps[c]} AS {c}" if c in gaps else c for c in fact.columns])


def with_dimension_faults(star: Star) -> Star:
    """The star with faulty rows in its dimensions: markers, rates, months, quarters,
    a missing text, and repeated keys and days."""
    customer = star.dim_customer.unionByName(star.dim_customer.where("customer_id % 500 = 1"))
    carrier = star.dim_carrier.selectExpr(
        "carrier_id",
        "IF(carrier_id % 9 = 1, NULL, carrier_name) AS carrier_name",
        "IF(carrier_id % 7 = 1, 'MEASURED', data_type) AS data_type",
    )
    route = star.dim_route.withColumn(
        "rate_factor", F.expr("CAST(IF(route_id % 10 = 3, -rate_factor, rate_factor) AS DECIMAL(5,2))")
    )
    date = star.dim_date.withColumns(
        {
            "month_number": F.expr("IF(date_key % 10000 = 229, 13, month_number)"),
            "quarter_number": F.expr("IF(date_key % 10000 = 229, 0, quarter_number)"),
            "calendar_date": F.expr("IF(date_key % 10000 = 229, date_add(calendar_date, 1), calendar_date)"),
        }
    )
    return replace(star, dim_customer=customer, dim_carrier=carrier, dim_route=route, dim_date=date)


# Text values that the typed conversion has to refuse, strip or pass on.
TEXT_FAULTS = {
    50: ("weight_kg", "''"),
    49: ("base_freight_inr", "'NaN'"),
    48: ("customer_id", "concat('c', customer_id)"),
    47: ("promised_delivery_date", "replace(promised_delivery_date, '-', '/')"),
    46: ("fuel_surcharge_inr", "'1.005'"),
    45: ("planned_mode", "concat('\\t ', planned_mode, ' ')"),
    44: ("route_id", "'  '"),
    43: ("recorded_freight_inr", "'12,50'"),
    42: ("actual_delivery_date", "'2025-02-30'"),
    41: ("expedited_flag", "'99999999999'"),
}


def as_text_with_faults(fact: DataFrame) -> DataFrame:
    """All columns as text, with one faulty value per row of the listed weights."""
    text = fact.selectExpr(
        "weight_kg AS _weight", *[f"CAST({c} AS STRING) AS {c}" for c in fact.columns]
    )
    faulty = {
        column: f"CASE WHEN _weight = {weight} THEN {value} ELSE {column} END AS {column}"
        for weight, (column, value) in TEXT_FAULTS.items()
    }
    return text.selectExpr(*[faulty.get(c, c) for c in fact.columns])
