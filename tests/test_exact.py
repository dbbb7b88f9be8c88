"""Values at the edges: rounding once, telling rows apart, decimals, blanks, repeated days."""

from datetime import date
from decimal import Decimal

from conftest import dimensions, shipment, table
from pyspark.sql import functions as F

from lanecost.functions.scalars import percent_2dp
from lanecost.operators import rules
from lanecost.operators.convert import convert
from lanecost.operators.fingerprints import table_fingerprint
from lanecost.operators.measures import measures
from lanecost.schemas import SCHEMAS, Star
from lanecost.sources.order_star import dates


def test_percentages_are_rounded_once(spark):
    cases = [
        ("12344999999", "100000000000", "12.34"),
        ("1", "3", "33.33"),
        ("-1", "8", "-12.50"),
        ("1", "-800", "-0.13"),
        ("0.125", "100", "0.13"),
        ("5", "0", None),
        (None, "4", None),
        ("99999999999999999999.99", "99999999999999999999.99", "100.00"),
    ]
    rows = spark.createDataFrame(cases, "a string, b string, p string")
    money = [F.col(c).cast("decimal(26,3)").cast("decimal(26,2)") for c in "ab"]
    for row in rows.select(percent_2dp(*money).cast("string").alias("found"), "p").collect():
        assert row.found == row.p


def test_fingerprints_tell_rows_apart(spark):
    pairs = [((None, "c"), ("c", None)), (("a|b", "c"), ("a", "b|c")), (("", None), (None, "")), (("1:a", "b"), ("1", "a1:b"))]
    for one, two in pairs:
        for portable in (True, False):
            found = [table_fingerprint(spark.createDataFrame([x], "x string, y string"), portable).head() for x in (one, two)]
            assert found[0] != found[1]


def test_decimals_with_too_many_digits_are_rejected(spark):
    bad = ["100.0000000000000000004", "1e-19", "123456789012345678901234567890", "100.001", "0.0000000000000000000001"]
    good = {"100.000000000000000000000": 100, "1e2": 100, "0.00": 0, "1.50": Decimal("1.5"), "0e-30": 0}
    row = {f.name: str(shipment(1)[f.name]) for f in SCHEMAS["fact_shipment"].fields}
    texts = [row | {"shipment_id": t, "handling_charge_inr": t} for t in [*bad, *good]]
    raw = spark.createDataFrame([tuple(t.values()) for t in texts], ", ".join(f"{c} string" for c in row))
    converted = convert(raw, "fact_shipment")
    assert {(r.raw, r.rule) for r in converted.rejects().collect()} == {(t, "B4_scale") for t in bad}
    assert {r.shipment_id: r.handling_charge_inr for r in converted.accepted().collect()} == good


def test_blank_texts_are_found(spark):
    rows = [shipment(1, shipment_id=" \t\u2003"), shipment(2, delay_reason="", actual_delivery_date=date(2025, 1, 19))]
    star = Star.of({**dimensions(spark), "fact_shipment": table(spark, "fact_shipment", rows)})
    found = {(r.rule, r.column_name) for r in rules.violations(star).collect()}
    assert found == {("C21", "shipment_id"), ("C21", "delay_reason")}


def test_of_a_repeated_day_the_latest_date_counts(spark):
    parts = dimensions(spark)
    twice = parts["dim_date"].unionByName(parts["dim_date"].withColumn("calendar_date", F.date_add("calendar_date", 30)))
    rows = table(spark, "fact_shipment", [shipment(1)])
    for days in (twice, twice.orderBy(F.desc("calendar_date")), twice.repartition(5)):
        star = Star.of({**parts, "dim_date": days, "fact_shipment": rows})
        found = rules.row_findings(star, tables=["fact_shipment"]).collect()
        assert {r.column_name for r in found} == {"promised_delivery_date", "actual_delivery_date"}


def test_dense_groups_follow_the_slicer_of_their_dimension(spark):
    rows = [shipment(i, carrier_id=1) for i in range(3)]
    star = Star.of({**dimensions(spark), "fact_shipment": table(spark, "fact_shipment", rows)})
    names = [r.carrier_name for r in star.dim_carrier.orderBy("carrier_id").collect()]
    for chosen in (names[:1], names[1:2]):
        found = measures(star, ["delayed_shipments"], ["carrier_name"], {"carrier_name": chosen}, dense=True).collect()
        assert [(r.carrier_name, r.delayed_shipments) for r in found] == [(chosen[0], 0)]


def test_calendar_covers_what_was_shipped(spark, tmp_path):
    days = ["1969-12-31 23:00:00", "1995-05-05 00:00:00", "2071-01-01 00:00:00"]
    lines = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp_ntz").alias("l_shipdate"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    span = dates(spark, str(tmp_path)).agg(F.min("date_key"), F.max("date_key"), F.count("*")).head()
    assert tuple(span) == (19690101, 20711231, (date(2071, 12, 31) - date(1969, 1, 1)).days + 1)
