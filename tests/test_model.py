import json
import random
from decimal import Decimal
from hashlib import md5, sha256

import pytest
from conftest import dimensions, late, rows_of, shipment, star_of
from pyspark.sql import functions as F

from lanecost.functions.calendar import auto_calendar, date_dimension
from lanecost.operators import fingerprints
from lanecost.operators.numbering import sequential_ids
from lanecost.plans import model
from lanecost.sources.csv_files import write_csv

# SHA-256 of the two-year date table as CSV with LF line ends: a fixed value.
DATES_2025_2026 = "63604a8bd4e905281ee5a54d179c0e19231e781368210679b4a25c4a1fe65b91"


def test_date_table_matches_its_fingerprint(spark, tmp_path):
    dates = date_dimension(spark, "2025-01-01", "2026-12-31")
    assert dates.count() == 730
    write_csv(dates.orderBy("date_key").coalesce(1), str(tmp_path / "unix"))
    (unix,) = rows_of(fingerprints.file_fingerprints(spark, str(tmp_path / "unix")))
    assert unix["sha256"] == DATES_2025_2026

    text = next((tmp_path / "unix").glob("*.csv")).read_bytes()
    (tmp_path / "dos").mkdir()
    (tmp_path / "dos" / "dates.csv").write_bytes(text.replace(b"\n", b"\r\n"))
    (dos,) = rows_of(fingerprints.file_fingerprints(spark, str(tmp_path / "dos")))
    assert dos["sha256"] == DATES_2025_2026


def test_large_files_have_no_fingerprint_of_the_whole(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("0123456789")
    (tmp_path / "b.csv").write_text("0123")
    monkeypatch.setattr(fingerprints, "MAX_FILE_BYTES", 5)
    found = {r.path[-5:]: r.sha256 for r in fingerprints.file_fingerprints(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": None, "b.csv": sha256(b"0123").hexdigest()}


def digest_of(text: bytes):
    lines = text.split(b"\n")
    ended = not lines[-1]
    lines = lines[:-1] if ended else lines
    sums = [0] * 4
    for i, line in enumerate(lines):
        h = sha256(line.removesuffix(b"\r")).hexdigest()
        for k, base in enumerate(fingerprints.BASES):
            sums[k] += int(h[7 * k : 7 * k + 7], 16) * pow(base, i, fingerprints.MODULUS)
    told = ":".join(map(str, [len(lines), int(ended), *(s % fingerprints.MODULUS for s in sums)]))
    return len(text), len(lines), sha256(told.encode()).hexdigest()


@pytest.mark.parametrize("split", [17, 1000, 1 << 20])
def test_digests_of_files_do_not_depend_on_their_splits(spark, tmp_path, split):
    rng = random.Random(3)
    body = b"\n".join(rng.randbytes(rng.randrange(30)).replace(b"\n", b"").replace(b"\r", b"") for _ in range(400))
    texts = {"a": body, "b": body + b"\n", "c": body.replace(b"\n", b"\r\n"), "d": b"", "e": b"\n", "f": b"x" * 5000, "g": body[::-1]}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = fingerprints.file_digests(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {r.path[-5]: (r.bytes, r.lines, r.digest) for r in rows}
    assert found == {name: digest_of(text) for name, text in texts.items() if text}
    assert found["a"][2] == found["c"][2] and len({f[2] for f in found.values()}) == 5


def test_a_file_above_the_limit_is_digested_by_several_tasks(spark, tmp_path):
    """More than 256 MB, without a whole-file hash."""
    path = str(tmp_path / "large")
    spark.range(0, 2_700_000, 1, 1).selectExpr("concat(id, repeat('x', 95)) AS value").write.option("compression", "none").text(path)
    (row,) = fingerprints.file_digests(spark, path, "*.txt").collect()
    assert row.bytes > fingerprints.MAX_FILE_BYTES and row.lines == 2_700_000
    assert spark.read.text(path).rdd.getNumPartitions() > 1
    assert fingerprints.file_fingerprints(spark, path, "*.txt").head().sha256 is None


@pytest.mark.parametrize("portable", [False, True])
def test_table_fingerprint(spark, portable):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")

    def of(rows):
        return fingerprints.table_fingerprint(rows, portable).collect()[0]

    assert of(df) == of(df.orderBy(F.desc("k")).repartition(3))
    assert of(df) != of(df.distinct())
    assert of(df) != of(df.fillna("x"))


def test_auto_calendar_covers_whole_years(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'2024-05-05'), (DATE'2025-02-01'), (NULL) AS t(d)")
    rows = rows_of(auto_calendar(df, "d"))
    assert len(rows) == 366 + 365
    leap = next(r for r in rows if str(r["Date"]) == "2024-02-29")
    assert (leap["Month"], leap["QuarterNo"], leap["Quarter"]) == ("February", 1, "Qtr 1")
    assert auto_calendar(df.where("d IS NULL"), "d").count() == 0


def test_sequential_ids_equal_a_full_sort(spark):
    """A third of the rows share one day, and one part of the key is hot."""
    rng = random.Random(7)
    rows = [
        (f"k{i}", 20250101 if i % 3 == 0 else 20250101 + rng.randint(0, 27)) for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "id string, day int").repartition(7)
    found = {r.id: r.sequence_id for r in sequential_ids(df, "day", "id").collect()}
    ordered = sorted(rows, key=lambda r: (r[1], md5(r[0].encode()).hexdigest(), r[0]))
    assert found == {r[0]: f"SIM-{n:05d}" for n, r in enumerate(ordered, 1)}


def test_rows_without_an_order_value_come_first(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 4)], "id string, day int")
    found = {r.id: r.sequence_id for r in sequential_ids(df, "day", "id").collect()}
    assert found == {"b": "SIM-00001", "c": "SIM-00002", "a": "SIM-00003"}


def test_ids_beside_columns_named_like_helpers(spark):
    df = spark.createDataFrame([("a", 5, "x", "y"), ("b", 4, "x", "y")], "id string, day int, task string, hash string")
    found = {r.id: (r.sequence_id, r.task, r.hash) for r in sequential_ids(df, "day", "id").collect()}
    assert found == {"b": ("SIM-00001", "x", "y"), "a": ("SIM-00002", "x", "y")}


def test_long_numbers_are_not_cut(spark):
    df = spark.range(12).select(F.col("id").cast("string"), F.lit(1).alias("day"))
    ids = {r.sequence_id for r in sequential_ids(df, "day", "id", "N", 1).collect()}
    assert ids == {f"N{i}" for i in range(1, 13)}


def test_planning_formulas(spark):
    star = star_of(
        spark,
        [
            shipment(1),
            shipment(2, route_id=2, planned_mode="Sea", weight_kg=Decimal("785.72")),
        ],
    )
    card = model.rate_card(spark)
    rows = {r["shipment_id"]: r for r in rows_of(model.baseline_model(star, card))}
    road = rows["SIM-00001"]
    assert road["baseline_rate_inr_kg"] == Decimal("18.00")
    assert road["modeled_baseline_inr"] == Decimal("3816.00")
    sea = rows["SIM-00002"]
    assert sea["baseline_rate_inr_kg"] == Decimal("51.20")
    assert sea["planned_base_inr"] == Decimal("40228.86")
    assert sea["baseline_fuel_inr"] == Decimal("4827.46")
    promised = {
        r["shipment_id"]: str(r["promised_delivery_date"])
        for r in rows_of(model.promised_dates(star, card))
    }
    assert promised == {"SIM-00001": "2025-01-15", "SIM-00002": "2025-02-06"}


def test_profile_and_upgrades(spark, tmp_path):
    star = star_of(
        spark,
        [
            shipment(1),
            shipment(2, **late(2), planned_mode="Sea", actual_mode="Air", expedited_flag=1),
            shipment(3, ship_date_key=20250220),
        ],
    )
    model.write_profile(model.dataset_profile(star.fact_shipment), str(tmp_path / "profile"))
    (text,) = [p.read_text() for p in (tmp_path / "profile").glob("*.json")]
    profile = json.loads(text)
    assert profile["shipment_count"] == 3 and profile["months"] == 2
    assert profile["ship_date_min"] == 20250110 and profile["late_shipments"] == 1
    changed = {
        (r["planned_mode"], r["actual_mode"]): r["mode_changed"]
        for r in rows_of(model.mode_upgrades(star.fact_shipment))
    }
    assert changed == {("Road", "Road"): False, ("Sea", "Air"): True}
    assert dimensions(spark)["dim_date"].count() == 365


def test_shared_folder_follows_the_session(spark):
    from lanecost.sources.folders import shared_folder

    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]

    class Conf:
        def get(self, key, default):
            return self.value

    class Session:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    Conf.value = "hdfs:///shared/"
    assert shared_folder(Session(), "x").startswith("hdfs:///shared/x-")
    Conf.value = None
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")


def test_shared_folders_are_removed_on_request(spark, monkeypatch):
    from lanecost.sources import folders

    monkeypatch.setattr(folders, "_given", [])
    used, unused = folders.shared_folder(spark, "x"), folders.shared_folder(spark, "y")
    spark.range(3).write.parquet(used)
    (removed,) = folders.remove_shared_folders(spark)
    assert removed.removeprefix("file:") == used.removeprefix("file:") and unused not in removed
    assert folders.remove_shared_folders(spark) == []
