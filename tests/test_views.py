from decimal import Decimal

from conftest import late, rows_of, shipment, star_of

from lanecost.plans import headline, views


def test_analysis_drops_unknown_keys_and_guards_nulls(spark):
    star = star_of(
        spark,
        [
            shipment(1, **late(3)),
            shipment(2, actual_delivery_date=None),
            shipment(3, customer_id=99),
            shipment(4, modeled_baseline_inr=Decimal("0.00")),
        ],
    )
    rows = {r["shipment_id"]: r for r in rows_of(views.shipment_analysis(star))}
    assert set(rows) == {"SIM-00001", "SIM-00002", "SIM-00004"}
    first = rows["SIM-00001"]
    assert first["delay_days"] == 3 and first["on_time_flag"] == 0
    assert first["cost_variance_inr"] == Decimal("184.00")
    assert first["year_month"] == "2025-01" and first["carrier_name"] == "Fast"
    assert rows["SIM-00002"]["delay_days"] is None and rows["SIM-00002"]["on_time_flag"] == 0
    assert rows["SIM-00004"]["cost_variance_ratio"] is None


def test_monthly_counts_missing_dates_as_not_on_time(spark):
    star = star_of(
        spark,
        [shipment(1), shipment(2, actual_delivery_date=None), shipment(3, route_id=99)],
    )
    (row,) = rows_of(views.monthly_logistics(star))
    assert row["shipments"] == 2 and row["on_time_delivery_ratio"] == 0.5
    assert row["freight_per_kg_inr"] == 40.0
    (trusting,) = rows_of(views.monthly_logistics(star, trusted_keys=True))
    assert trusting["shipments"] == 3


def test_growth_over_a_gap(spark):
    star = star_of(
        spark,
        [
            shipment(1),
            shipment(2, ship_date_key=20250228, recorded_freight_inr=Decimal("6000.00")),
            shipment(3, ship_date_key=20250410, recorded_freight_inr=Decimal("3000.00")),
        ],
    )
    monthly = views.monthly_logistics(star, last_dispatch=True)
    growth = {r["year_month"]: r for r in rows_of(views.monthly_growth(monthly))}
    assert growth["2025-01"]["freight_growth_ratio"] is None
    assert growth["2025-02"]["freight_growth_ratio"] == 0.5
    assert growth["2025-04"]["freight_growth_ratio"] == -0.5

    rows = {r["year_month"]: r for r in rows_of(views.monthly_growth_calendar(monthly))}
    assert rows["2025-02"]["calendar_growth_ratio"] == 0.5
    assert rows["2025-04"]["calendar_growth_ratio"] is None
    assert [m for m, r in rows.items() if r["partial_month"]] == ["2025-04"]


def test_last_month_covered_to_its_end_is_not_partial(spark):
    star = star_of(spark, [shipment(1), shipment(2, ship_date_key=20250228)])
    monthly = views.monthly_logistics(star, last_dispatch=True)
    rows = rows_of(views.monthly_growth_calendar(monthly))
    assert not any(r["partial_month"] for r in rows)


def test_headline(spark):
    star = star_of(
        spark,
        [
            shipment(1),
            shipment(1, **late(3)),
            shipment(3, actual_delivery_date=None, data_type=" synthetic "),
            shipment(4, data_type=None),
        ],
    )
    (totals,) = rows_of(headline.headline_totals(star))
    assert totals["duplicate_or_null_ids"] == 1
    assert totals["missing_delivery_dates"] == 1 and totals["non_synthetic_rows"] == 1
    (delivery,) = rows_of(headline.headline_delivery(star.fact_shipment))
    assert delivery["on_time_shipments"] == 2
    assert delivery["on_time_delivery_pct"] == 2 / 3 * 100.0
    assert delivery["average_delay_days_delayed_only"] == 3.0


def test_rates_round_half_up(spark):
    # 1 of 16 is 6.25 %; 1 of 32 is 3.125 %, which rounds up.
    rows = [shipment(i) for i in range(31)] + [shipment(31, **late(1))]
    (rate,) = rows_of(headline.delay_rate_by_mode(star_of(spark, rows).fact_shipment))
    assert rate["delay_rate_pct"] == Decimal("3.13")


def test_rates_of_carriers_and_routes_are_ordered(spark):
    star = star_of(
        spark,
        [
            shipment(1, carrier_id=2),
            shipment(2, **late(1)),
            shipment(3, route_id=2, recorded_freight_inr=Decimal("9000.00")),
            shipment(4, carrier_id=99),
        ],
    )
    carriers = rows_of(headline.ontime_by_carrier(star))
    assert [(r["carrier_id"], r["on_time_delivery_pct"]) for r in carriers] == [
        (2, Decimal("100.00")),
        (1, Decimal("50.00")),
    ]
    routes = rows_of(headline.variance_by_route(star))
    assert [r["route_id"] for r in routes] == [2, 1]
    assert routes[0]["cost_variance_pct"] == Decimal("135.85")
