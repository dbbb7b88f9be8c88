from decimal import Decimal

import pytest
from conftest import late, rows_of, shipment, star_of

from lanecost.operators.drill import drill_down
from lanecost.operators.measures import MEASURES, measures, needed_columns
from lanecost.operators.ranking import top_with_ties
from lanecost.plans import reports

ALL = list(MEASURES)


def by_key(df, key):
    return {r[key]: r for r in rows_of(df)}


def test_values_and_null_dates(spark):
    star = star_of(
        spark,
        [
            shipment(1),
            shipment(2, **late(4)),
            shipment(3, **late(2)),
            shipment(4, actual_delivery_date=None),
        ],
    )
    (row,) = rows_of(measures(star, ALL))
    assert row["total_shipments"] == 4
    assert row["recorded_freight_inr"] == Decimal("16000.00")
    assert row["cost_variance_inr"] == Decimal("736.00")
    assert row["cost_variance_pct"] == 736.0 / 15264.0
    assert row["delayed_shipments"] == 2 and row["on_time_shipments"] == 1
    assert row["on_time_delivery_pct"] == 1 / 3
    assert row["delay_rate_pct"] == 2 / 3
    assert row["average_delay_days"] == 3.0
    assert row["delivery_evaluable_shipments"] == 3
    assert row["missing_delivery_dates"] == 1
    assert row["delivery_date_coverage_pct"] == 0.75
    assert row["freight_per_shipment_inr"] == 4000.0
    assert row["sum_weight_kg"] == Decimal("400.00") and row["sum_expedited_flag"] == 0


def test_blank_when_nothing_matches(spark):
    star = star_of(spark, [shipment(1)])
    (row,) = rows_of(measures(star, ALL, filters={"actual_mode": ["Air"]}))
    zero = {
        "delayed_shipments",
        "on_time_shipments",
        "delivery_evaluable_shipments",
        "missing_delivery_dates",
    }
    assert {name for name, value in row.items() if value is not None} == zero
    assert all(row[name] == 0 for name in zero)


def test_variance_with_one_side_missing(spark):
    star = star_of(
        spark, [shipment(1, modeled_baseline_inr=None), shipment(2, recorded_freight_inr=None)]
    )
    (row,) = rows_of(measures(star, ["cost_variance_inr"]))
    assert row["cost_variance_inr"] == Decimal("184.00")
    only = star_of(spark, [shipment(1, modeled_baseline_inr=None)])
    (row,) = rows_of(measures(only, ["cost_variance_inr", "cost_variance_pct"]))
    assert row == {"cost_variance_inr": Decimal("4000.00"), "cost_variance_pct": None}


def test_zero_baseline_gives_no_ratio(spark):
    star = star_of(spark, [shipment(1, modeled_baseline_inr=Decimal("0.00"))])
    (row,) = rows_of(measures(star, ["cost_variance_pct"]))
    assert row["cost_variance_pct"] is None


def test_unknown_keys_are_kept_under_a_blank_label(spark):
    star = star_of(spark, [shipment(1), shipment(2, carrier_id=99), shipment(3, carrier_id=None)])
    found = by_key(measures(star, ["total_shipments"], ["carrier_name"]), "carrier_name")
    assert {k: r["total_shipments"] for k, r in found.items()} == {"Fast": 1, None: 2}


def test_dense_lists_members_without_shipments(spark):
    star = star_of(spark, [shipment(1, **late(1)), shipment(2, carrier_id=99)])
    found = by_key(measures(star, ALL, ["carrier_name"], dense=True), "carrier_name")
    assert set(found) == {"Fast", "Slow", "Idle", None}
    idle = found["Idle"]
    assert idle["delayed_shipments"] == 0 and idle["missing_delivery_dates"] == 0
    assert idle["total_shipments"] is None and idle["recorded_freight_inr"] is None
    assert idle["on_time_delivery_pct"] is None
    assert found[None]["total_shipments"] == 1


def test_equal_labels_are_one_group(spark):
    star = star_of(spark, [shipment(1), shipment(2, route_id=3), shipment(3, route_id=2)])
    found = by_key(measures(star, ["total_shipments"], ["route"]), "route")
    counts = {k: r["total_shipments"] for k, r in found.items()}
    assert counts == {"Pune → Delhi": 2, "Mumbai → Houston": 1}


def test_several_labels_and_filters(spark):
    star = star_of(
        spark,
        [
            shipment(1),
            shipment(2, carrier_id=2, route_id=2, actual_mode="Sea"),
            shipment(3, carrier_id=2, ship_date_key=20250220),
        ],
    )
    by = ["carrier_name", "destination_country", "year_month"]
    rows = rows_of(measures(star, ["total_shipments"], by, {"carrier_name": ["Slow"]}))
    assert sorted((r["destination_country"], r["year_month"]) for r in rows) == [
        ("India", "2025-02"),
        ("United States", "2025-01"),
    ]
    chosen = {"calendar_year": [2025], "actual_mode": ["Road"], "carrier_name": []}
    (row,) = rows_of(measures(star, ["total_shipments"], filters=chosen))
    assert row["total_shipments"] == 2


def test_arguments_are_checked(spark):
    star = star_of(spark, [shipment(1)])
    with pytest.raises(ValueError, match="unknown measures"):
        measures(star, ["profit"])
    with pytest.raises(ValueError, match="dense"):
        measures(star, ["total_shipments"], ["actual_mode"], dense=True)
    assert needed_columns(["total_shipments"], ["route"], {"calendar_year": [1]}) == [
        "route_id",
        "ship_date_key",
    ]


def test_top_keeps_ties_and_drops_blanks(spark):
    df = spark.createDataFrame(
        [("a", 9), ("b", 7), ("c", 7), ("d", 7), ("e", 1), ("f", None)], "k string, v int"
    )
    assert {r.k for r in top_with_ties(df, "v", 2).collect()} == {"a", "b", "c", "d"}
    assert {r.k for r in top_with_ties(df, "v", 1).collect()} == {"a"}
    assert {r.k for r in top_with_ties(df, "v", 9).collect()} == {"a", "b", "c", "d", "e"}


def test_drill_down_levels_and_blank_dates(spark):
    star = star_of(
        spark,
        [
            shipment(1),
            shipment(2, ship_date_key=20250220),
            shipment(3, actual_delivery_date=None),
        ],
    )
    rows = rows_of(drill_down(star, "actual", ["total_shipments"]))
    total = [r for r in rows if r["level"] == 0]
    assert [r["total_shipments"] for r in total] == [3]
    years = {r["Year"]: r["total_shipments"] for r in rows if r["level"] == 1}
    assert years == {2025: 2, None: 1}
    days = {(r["MonthNo"], r["Day"]) for r in rows if r["level"] == 4 and r["Year"]}
    assert days == {(1, 15)}
    dispatch = rows_of(drill_down(star, "dispatch", ["total_shipments"]))
    months = {r["MonthNo"]: r["total_shipments"] for r in dispatch if r["level"] == 3}
    assert months == {1: 2, 2: 1}


def test_report_datasets(spark):
    star = star_of(
        spark,
        [shipment(1), shipment(2, **late(3), carrier_id=2), shipment(3, route_id=2)],
    )
    assert [r["carrier_name"] for r in rows_of(reports.carrier_bar(star))] == [
        "Fast",
        "Slow",
        "Idle",
    ]
    reasons = by_key(reports.delay_reasons(star), "delay_reason")
    assert {k: r["delayed_shipments"] for k, r in reasons.items()} == {"Weather": 1, "None": 0}
    assert len(rows_of(reports.route_top(star, n=1))) == 1
    (card,) = rows_of(reports.overview_cards(star, {"carrier_name": ["Slow"]}))
    assert card["total_shipments"] == 1
    slicers = {(r["slicer"], r["member"]) for r in rows_of(reports.slicer_values(star))}
    assert ("calendar_year", "2025") in slicers and ("carrier_name", "Idle") in slicers
    assert ("actual_mode", "Road") in slicers
