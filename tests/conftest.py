import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lanecost.functions.calendar import date_dimension  # noqa: E402
from lanecost.schemas import SCHEMAS, Star  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lanecost-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def shipment(number, **changes):
    """A valid shipment by road, on time, of 100 kg; ``changes`` replace values."""
    row = {
        "shipment_id": f"SIM-{number:05d}",
        "ship_date_key": 20250110,
        "customer_id": 1,
        "carrier_id": 1,
        "route_id": 1,
        "planned_mode": "Road",
        "actual_mode": "Road",
        "weight_kg": Decimal("100.00"),
        "promised_delivery_date": date(2025, 1, 15),
        "actual_delivery_date": date(2025, 1, 15),
        "base_freight_inr": Decimal("2000.00"),
        "fuel_surcharge_inr": Decimal("200.00"),
        "handling_charge_inr": Decimal("1800.00"),
        "expedite_fee_inr": Decimal("0.00"),
        "recorded_freight_inr": Decimal("4000.00"),
        "baseline_rate_inr_kg": Decimal("18.00"),
        "baseline_fuel_inr": Decimal("216.00"),
        "baseline_handling_inr": Decimal("1800.00"),
        "modeled_baseline_inr": Decimal("3816.00"),
        "expedited_flag": 0,
        "delay_reason": "None",
        "data_type": "SYNTHETIC",
    }
    return row | changes


def late(days, **changes):
    return {
        "actual_delivery_date": date(2025, 1, 15 + days),
        "delay_reason": "Weather",
    } | changes


def table(spark, name, rows):
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(r[c] for c in schema.fieldNames()) for r in rows], schema)


def dimensions(spark):
    routes = [
        (1, "Pune", "Delhi", "India", "Domestic", Decimal("1.00"), "SYNTHETIC"),
        (2, "Mumbai", "Houston", "United States", "Export", Decimal("1.60"), "SYNTHETIC"),
        (3, "Pune", "Delhi", "India", "Domestic", Decimal("1.40"), "SYNTHETIC"),
    ]
    return {
        "dim_customer": spark.createDataFrame(
            [(i, f"Customer {i}", "Industrial", "SYNTHETIC") for i in (1, 2)],
            SCHEMAS["dim_customer"],
        ),
        "dim_carrier": spark.createDataFrame(
            [(1, "Fast", "SYNTHETIC"), (2, "Slow", "SYNTHETIC"), (3, "Idle", "SYNTHETIC")],
            SCHEMAS["dim_carrier"],
        ),
        "dim_route": spark.createDataFrame(routes, SCHEMAS["dim_route"]),
        "dim_date": date_dimension(spark, "2025-01-01", "2025-12-31"),
    }


def star_of(spark, rows):
    return Star.of({**dimensions(spark), "fact_shipment": table(spark, "fact_shipment", rows)})


def rows_of(df):
    return [r.asDict() for r in df.collect()]
