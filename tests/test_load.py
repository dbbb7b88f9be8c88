from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from conftest import dimensions, late, rows_of, shipment, table
from pyspark.sql import functions as F

from lanecost.operators import key_filter
from lanecost.operators.measures import where_members
from lanecost.operators.rules import RuleViolation
from lanecost.operators.upsert import insert_absent, upsert
from lanecost.plans import load as loading
from lanecost.plans import reports
from lanecost.plans.load import ReconciliationError, StaleStateError, Store, load, run_states
from lanecost.plans.quality import reconcile
from lanecost.schemas import SCHEMAS
from lanecost.streaming import batches
from lanecost.streaming.batches import load_arrivals

FEBRUARY = {
    "ship_date_key": 20250220,
    "promised_delivery_date": date(2025, 2, 25),
    "actual_delivery_date": date(2025, 2, 25),
}


def fact(spark, *rows):
    return table(spark, "fact_shipment", rows)


def keys(store):
    return sorted(r.shipment_id for r in store.table("fact_shipment").collect())


@pytest.fixture
def store(spark, tmp_path):
    """A store holding two shipments of January and one of February."""
    new = Store(spark, str(tmp_path / "store"))
    rows = fact(spark, shipment(1), shipment(2), shipment(3, **FEBRUARY))
    load(new, {**dimensions(spark), "fact_shipment": rows}, run_id="first")
    return new


def test_whole_load(store):
    version, tables = store.published()
    assert version == 1 and set(tables["fact_shipment"]) == {"202501", "202502"}
    assert keys(store) == ["SIM-00001", "SIM-00002", "SIM-00003"]
    (run,) = rows_of(store.runs())
    assert run["status"] == "SUCCESS" and run["rows_processed"] == 2 + 3 + 3 + 365 + 3
    assert run["finished_at"] >= run["started_at"]


def test_correction_batch_rewrites_only_the_months_it_touches(spark, store):
    fee = {"handling_charge_inr": Decimal("1900.00"), "recorded_freight_inr": Decimal("4100.00")}
    batch = {"fact_shipment": fact(spark, shipment(1, **fee), shipment(4))}
    for run in ("second", "third"):
        load(store, batch, whole=False, run_id=run)
        assert keys(store) == ["SIM-00001", "SIM-00002", "SIM-00003", "SIM-00004"]
    parts = store.published()[1]["fact_shipment"]
    assert parts == {"202501": "third", "202502": "first"}
    corrected = store.table("fact_shipment").where("shipment_id = 'SIM-00001'").collect()
    assert [r.recorded_freight_inr for r in corrected] == [Decimal("4100.00")]


def test_shipment_moves_to_another_month(spark, store):
    load(store, {"fact_shipment": fact(spark, shipment(3))}, whole=False)
    assert keys(store) == ["SIM-00001", "SIM-00002", "SIM-00003"]
    assert set(store.published()[1]["fact_shipment"]) == {"202501"}


def test_seed_keeps_present_rows(spark, store):
    rows = fact(spark, shipment(1, **FEBRUARY), shipment(9))
    load(store, {"fact_shipment": rows}, whole=False, seed=True)
    found = {r.shipment_id: r.ship_date_key for r in store.table("fact_shipment").collect()}
    assert found["SIM-00001"] == 20250110 and "SIM-00009" in found


def test_dimension_batch_leaves_shipments_alone(spark, store):
    row = (2, "New name", "Industrial", "SYNTHETIC")
    renamed = spark.createDataFrame([row], SCHEMAS["dim_customer"])
    load(store, {"dim_customer": renamed}, whole=False)
    names = {r.customer_id: r.customer_name for r in store.table("dim_customer").collect()}
    assert names == {1: "Customer 1", 2: "New name"}
    assert keys(store) == ["SIM-00001", "SIM-00002", "SIM-00003"]


def test_invalid_batch_changes_nothing(spark, store):
    bad = fact(spark, shipment(1, actual_mode="Teleport"))
    with pytest.raises(RuleViolation, match="Teleport"):
        load(store, {"fact_shipment": bad}, whole=False, run_id="bad")
    assert store.published()[0] == 1
    states = {r.run_id: (r.status, r.message) for r in store.runs().collect()}
    assert states["bad"] == ("FAILED", "SIM-00001: invalid actual_mode: Teleport")


@pytest.mark.parametrize("step", ["settle", "publish"])
def test_failure_during_a_load_leaves_the_old_state(spark, store, monkeypatch, step):
    def fail(*_):
        raise RuntimeError("intentional " + "x" * 600)

    if step == "settle":
        monkeypatch.setattr(loading, "settle", fail)
    else:
        monkeypatch.setattr(Store, "publish", fail)
    renamed = dimensions(spark)["dim_customer"].withColumn("customer_name", F.lit("ROLLBACK"))
    batch = {"dim_customer": renamed, "fact_shipment": fact(spark, shipment(4))}
    with pytest.raises(RuntimeError, match="intentional"):
        load(store, batch, whole=False, run_id="lost")
    assert "ROLLBACK" not in {r.customer_name for r in store.table("dim_customer").collect()}
    assert keys(store) == ["SIM-00001", "SIM-00002", "SIM-00003"]
    lost = {r.run_id: r for r in store.runs().collect()}["lost"]
    assert lost.status == "FAILED" and len(lost.message) == 500

    monkeypatch.undo()
    load(store, batch, whole=False, run_id="lost")
    assert len(keys(store)) == 4


def test_whole_load_must_hold_exactly_the_batch(spark, store):
    tables = {**dimensions(spark), "fact_shipment": fact(spark, shipment(1))}
    with pytest.raises(ReconciliationError, match="3 rows and 3 keys stored, 1 given"):
        load(store, tables)


def test_published_run_is_not_repeated(spark, store):
    with pytest.raises(ValueError, match="already published"):
        load(store, {"fact_shipment": fact(spark, shipment(1))}, whole=False, run_id="first")


def test_arriving_batches(spark, store, tmp_path):
    folder = str(tmp_path / "arrivals")
    fact(spark, shipment(4), shipment(1, **FEBRUARY)).coalesce(1).write.parquet(folder)
    load_arrivals(store, folder, str(tmp_path / "progress")).awaitTermination()
    assert len(keys(store)) == 4
    fact(spark, shipment(5)).coalesce(1).write.mode("append").parquet(folder)
    load_arrivals(store, folder, str(tmp_path / "progress")).awaitTermination()
    assert len(keys(store)) == 5
    # New progress: everything is applied again, to the same end.
    load_arrivals(store, folder, str(tmp_path / "other")).awaitTermination()
    assert len(keys(store)) == 5


def test_arrivals_from_two_folders(spark, store, tmp_path):
    for number in (4, 5):
        folder = str(tmp_path / f"arrivals-{number}")
        fact(spark, shipment(number)).coalesce(1).write.parquet(folder)
        load_arrivals(store, folder, str(tmp_path / f"progress-{number}")).awaitTermination()
    assert keys(store) == [f"SIM-{n:05d}" for n in range(1, 6)]


def test_published_batch_is_recognised_on_restart(spark, store, tmp_path, monkeypatch):
    folder, progress = str(tmp_path / "arrivals"), str(tmp_path / "progress")
    fact(spark, shipment(4)).coalesce(1).write.parquet(folder)

    def lost(*args, **options):
        load(*args, **options)
        raise RuntimeError("driver lost after publication")

    monkeypatch.setattr(batches, "load", lost)
    with pytest.raises(Exception, match="driver lost"):
        load_arrivals(store, folder, progress).awaitTermination()
    monkeypatch.undo()
    version = store.published()[0]
    load_arrivals(store, folder, progress).awaitTermination()
    assert store.published()[0] == version and len(keys(store)) == 4


def test_of_overlapping_loads_the_later_fails(spark, store, monkeypatch):
    """Another load publishes while one is being checked; it must not undo that."""
    inner = loading.settle

    def meanwhile(*args):
        monkeypatch.setattr(loading, "settle", inner)
        load(store, {"fact_shipment": fact(spark, shipment(8))}, whole=False, run_id="quick")
        return inner(*args)

    monkeypatch.setattr(loading, "settle", meanwhile)
    batch = {"fact_shipment": fact(spark, shipment(9))}
    with pytest.raises(StaleStateError, match="meanwhile"):
        load(store, batch, whole=False, run_id="slow")
    assert "SIM-00008" in keys(store) and "SIM-00009" not in keys(store)
    assert {r.run_id: r.status for r in store.runs().collect()}["slow"] == "FAILED"
    load(store, batch, whole=False, run_id="slow")
    assert {"SIM-00008", "SIM-00009"} <= set(keys(store))


def test_unused_runs_are_removed(spark, store):
    load(store, {"fact_shipment": fact(spark, shipment(1))}, whole=False, run_id="second")
    assert store.remove_unused() == []
    removed = store.remove_unused(older_than_hours=-1)
    assert "landed/fact_shipment/run=first" in removed
    assert "data/fact_shipment/run=first" not in removed  # still holds February
    assert keys(store) == ["SIM-00001", "SIM-00002", "SIM-00003"]


def test_business_rule_looks_at_the_whole_table(spark, store):
    """Rows that break it in a month which a batch does not touch still fail it."""
    version, parts, ledger = store.state()
    assert sum(e.rows for e in ledger["fact_shipment"].values()) == 3
    ledger["fact_shipment"]["202502"] = replace(ledger["fact_shipment"]["202502"], broken=1)
    store.publish("spoiled", parts, version, ledger)
    with pytest.raises(ReconciliationError, match="business_rules: 1 rows"):
        load(store, {"fact_shipment": fact(spark, shipment(9))}, whole=False)


def test_reports_from_maintained_parts(spark, store):
    """All pages, sliced and not, equal a scan of the shipments after rows moved, changed
    and came, and read none of them."""
    rows = [shipment(3, **late(4)), shipment(1, actual_mode="Air", **FEBRUARY), shipment(5, **late(2, carrier_id=2, route_id=2))]
    load(store, {"fact_shipment": fact(spark, *rows)}, whole=False)
    pages = [
        reports.overview_cards, reports.carrier_cards, reports.monthly_trend, reports.carrier_bar,
        reports.carrier_scatter, reports.route_top, reports.delay_reasons, reports.mode_delays,
    ]
    slices = [None, {"calendar_year": [2025], "actual_mode": ["Road"]}, {"carrier_name": ["Slow"]}, {"year_month": ["2025-02"]}]
    kept = store.report_star()
    assert "data/fact_shipment" not in "".join(kept.fact_shipment.inputFiles())
    for page in pages:
        for chosen in slices:
            assert rows_of(page(kept, filters=chosen)) == rows_of(page(store.star(), filters=chosen))


def test_year_slicer_skips_months(store):
    sliced = where_members(store.star(), {"calendar_year": [2025]})
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and sliced.count() == 3


@pytest.mark.parametrize("fault", ["missing", "doubled", "changed", "elsewhere"])
@pytest.mark.parametrize("whole", [True, False])
def test_reconciliation_finds_what_was_written_wrongly(spark, tmp_path, monkeypatch, fault, whole):
    """The rows that reach the files are not those that were merged."""
    new = Store(spark, str(tmp_path / "store"))
    rows = fact(spark, shipment(1), shipment(2), shipment(3, **FEBRUARY))
    tables = {**dimensions(spark), "fact_shipment": rows}
    if not whole:
        load(new, tables)
        tables = {"fact_shipment": fact(spark, shipment(2, weight_kg=Decimal("100.00")), shipment(4))}

    def spoiled(target, batch, key):
        merged = upsert(target, batch, key)
        if key != "shipment_id":
            return merged
        second = F.col(key) == "SIM-00002"
        if fault == "missing":
            return merged.where(~second)
        if fault == "doubled":
            return merged.unionByName(merged.where(second))
        if fault == "changed":
            return merged.withColumn("expedite_fee_inr", F.when(second, 7).otherwise(F.col("expedite_fee_inr")).cast("decimal(16,2)"))
        return merged.withColumn("ship_month", F.when(second, 202503).otherwise(F.col("ship_month")))

    monkeypatch.setattr(loading, "upsert", spoiled)
    version = new.published()
    with pytest.raises(ReconciliationError, match="fact_shipment"):
        load(new, tables, whole=whole)
    assert new.published() == version


def test_batch_opens_only_months_whose_filter_hits(spark, store, monkeypatch):
    opened = []
    inner = Store.read_parts

    def looked(self, table, parts):
        if table == "fact_shipment":
            opened.extend(parts)
        return inner(self, table, parts)

    monkeypatch.setattr(Store, "read_parts", looked)
    march = {k: v.replace(month=3) for k, v in FEBRUARY.items() if k != "ship_date_key"}
    load(store, {"fact_shipment": fact(spark, shipment(7, ship_date_key=20250320, **march))}, whole=False)
    assert set(opened) == {"202503"}
    opened.clear()
    load(store, {"fact_shipment": fact(spark, shipment(3))}, whole=False)
    assert "202502" in opened and "202503" not in opened
    assert len(keys(store)) == 4


def test_filters_find_every_key_and_few_others(spark):
    blocks = key_filter.blocks_for(20_000)
    rows = spark.range(20_000).selectExpr("concat('k', id) AS k", "CAST(id % 4 AS INT) AS part", f"{blocks // 4} AS blocks")
    filters = key_filter.build(rows, "k", "blocks", "part").cache()
    for part in range(4):
        asked = rows.where(f"part = {part}").limit(1).select("k")
        assert part in key_filter.parts_with(asked, filters, [blocks // 4], "part")
    others = [spark.sql(f"SELECT 'other{i}' AS k") for i in range(20)]
    assert sum(len(key_filter.parts_with(k, filters, [blocks // 4], "part")) for k in others) <= 2
    assert [key_filter.blocks_for(n) for n in (0, 1, 16, 17, 33, 100)] == [1, 1, 1, 2, 4, 8]


def test_claim_of_another_run_is_not_a_publication(spark, store):
    assert store.was_published("first") and not store.was_published("unknown")
    store._create("claims", "late.json", {"version": 1})
    store._create("claims", "early.json", {"version": 9})
    assert not store.was_published("late") and not store.was_published("early")


def test_upsert_and_insert_absent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    merged = sorted(map(tuple, upsert(target, batch, "k").collect()))
    assert merged == [(1, "a"), (2, "B"), (3, "C")]
    again = upsert(upsert(target, batch, "k"), batch, "k")
    assert again.count() == 3
    kept = sorted(map(tuple, insert_absent(target, batch, "k").collect()))
    assert kept == [(1, "a"), (2, "b"), (3, "C")]


def test_reconcile_reports_every_difference(spark):
    source = {**dimensions(spark), "fact_shipment": fact(spark, shipment(1), shipment(2))}
    broken = shipment(2, recorded_freight_inr=Decimal("-1.00"))
    target = source | {
        "fact_shipment": fact(spark, shipment(1), broken, broken),
        "dim_customer": source["dim_customer"].limit(0),
    }
    rows = {r["check_name"]: r for r in rows_of(reconcile(source, target))}
    assert rows["dim_carrier"]["passed"]
    assert (rows["dim_customer"]["found_rows"], rows["dim_customer"]["passed"]) == (0, False)
    assert (rows["fact_shipment"]["found_rows"], rows["fact_shipment"]["found_keys"]) == (3, 2)
    assert rows["business_rules"]["found_rows"] == 2 and not rows["business_rules"]["passed"]


def test_run_states(spark):
    events = spark.sql(
        """SELECT * FROM VALUES
        ('a', TIMESTAMP'2025-01-01 10:00:00', 'RUNNING', 0L, 'Started'),
        ('a', TIMESTAMP'2025-01-01 10:00:00', 'SUCCESS', 7L, 'Done'),
        ('b', TIMESTAMP'2025-01-01 11:00:00', 'RUNNING', 0L, 'Started')
        AS t(run_id, ts, status, rows_processed, message)"""
    )
    states = {r.run_id: r for r in run_states(events).collect()}
    assert states["a"].status == "SUCCESS" and states["a"].rows_processed == 7
    assert states["b"].status == "RUNNING" and states["b"].finished_at is None
