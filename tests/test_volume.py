"""What is shuffled and written: whole shipments once, lookups by their keys alone."""

import re

import catalogue
from lanecost.operators import rules
from lanecost.operators.measures import CUBE_KEYS, PARTS, cube
from lanecost.plans import views
from lanecost.sources.order_star import order_star


SF = "/root/testdata/sf0.001"


def shuffles(df):
    """Of every hash shuffle in the plan: what it is dealt by, and the columns it carries."""
    text = df._jdf.queryExecution().executedPlan().toString()
    nodes = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(([^)]*)\)", nodes)
    assert "Exchange" not in text or found or "hashpartitioning" not in text
    return [(re.sub(r"#\d+L?", "", keys), re.sub(r"#\d+L?", "", columns)) for columns, keys in found]


def without_broadcast(spark, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return shuffles(build())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_line_items_are_dealt_by_part_before_they_carry_their_order(spark):
    found = without_broadcast(spark, lambda: order_star(spark, SF).fact_shipment)
    by_part = [columns for keys, columns in found if keys.startswith("l_partkey")]
    assert by_part and not any("o_orderpriority" in columns for columns in by_part)


def test_customers_are_merged_at_every_size(spark):
    found = shuffles(views.shipment_analysis(order_star(spark, SF)))
    assert any(keys.startswith("customer_id") and "customer_name" in columns for keys, columns in found)


def test_keys_are_looked_up_without_the_rest_of_the_shipment(spark):
    star = order_star(spark, SF)
    found = without_broadcast(spark, lambda: rules.row_findings(star, tables=["fact_shipment"]))
    by_customer = [columns for keys, columns in found if keys.startswith("customer_id") and "shipment_id" in columns]
    assert by_customer and not any("delay_reason" in columns for columns in by_customer)


def test_parts_are_kept_without_a_shuffle_and_add_up(spark):
    fact = order_star(spark, SF).fact_shipment.selectExpr("*", "CAST(ship_date_key DIV 100 AS INT) AS ship_month")
    path = f"{catalogue.shared_folder(spark, 'parts')}/fact"
    fact.write.parquet(path)
    stored = spark.read.parquet(path)
    assert not shuffles(cube(stored))
    keys = ["ship_month", *CUBE_KEYS]
    want = stored.groupBy(*keys).agg(*[part.compute().cast(part.kind).alias(p) for p, part in PARTS.items()])
    sums = [f"CAST(sum({p}) AS {part.kind}) AS {p}" for p, part in PARTS.items()]
    got = cube(stored).groupBy(*keys).agg(*[catalogue.F.expr(s) for s in sums])
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_order_tables_are_joined_once_for_all_loads(spark, monkeypatch):
    given = []
    plain = catalogue.load

    def noted(store, tables, **more):
        given.append(tables["fact_shipment"].inputFiles())
        return plain(store, tables, **more)

    monkeypatch.setattr(catalogue, "load", noted)
    larger = "/root/testdata/sf0.01"  # keys of the smallest tables repeat
    catalogue._moved_store(spark, larger)
    assert len(given) == 2
    catalogue.load_two_sources(spark, larger)
    assert len(given) == 3
    assert not any("lineitem" in file for files in given for file in files)


def test_shipments_as_csv_take_less_than_half_of_their_text(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(catalogue, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    found = catalogue.csv_scan_roundtrip(spark, "/root/testdata/sf0.01")
    names = found.columns
    text = found.select(catalogue.F.sum(catalogue.F.octet_length(catalogue.F.concat_ws(",", *names)) + 1)).head()[0]
    written = sum(f.stat().st_size for f in (tmp_path / "csv").rglob("part-*"))
    assert 0 < written < text / 2


def test_shipments_copied_for_several_loads_are_written_small(spark, monkeypatch):
    given = []
    monkeypatch.setattr(catalogue, "load", lambda store, tables, **more: given.extend(tables["fact_shipment"].inputFiles()))
    catalogue._moved_store(spark, "/root/testdata/sf0.01")
    assert given and all(file.endswith(".zstd.parquet") for file in given)
