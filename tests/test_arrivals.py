"""Files that arrive over time, runs that go on from one another, and what a run must not touch."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from helpers import rows
from test_pipeline import FILES, write_stage

from innledger.operators import scd
from innledger.plans.pipeline import finished_runs, run, run_arrivals
from innledger.plans.warehouse import BUILDERS, Clock
from innledger.sources.bronze import bronze_rows
from innledger.streaming.arrivals import load_arrivals, loads
from innledger.streaming.incremental import merge_increments_in_place

LATER = {
    "guests/guests_2.csv": [
        FILES["guests/guests_1.csv"][0],
        "1000,Eve,1985-01-01,F,eve@mail.test,9,Road 9,Graz,Austria,Gold,2024-02-20",
    ],
    "guests/guests_inc_2.csv": [
        FILES["guests/guests_1.csv"][0],
        "1002,Bob,1980-01-01,M,bob@new.test,2,Road 2,Graz,Austria,Silver,2022-04-19",
    ],
    "reservations/reservations_0.csv": [
        FILES["reservations/reservations_1.csv"][0],
        "R0,1000,301,2024-03-01,2024-03-04,Website,2024-02-21 10:00:00,,Confirmed",
    ],
    "housekeeping/housekeeping_2.csv": [
        FILES["housekeeping/housekeeping_1.csv"][0],
        "T4,302,maintenance,Ravi,soon,2024-01-10 08:00:00,,false,Completed",
    ],
}


def clock_of(month):
    at = dt.datetime(2024, month, 1, 0, 0, 0, 250)
    return Clock(loaded=at, merged=at, cancels_as_of=dt.datetime(2024, 1, 5, 12), cancels_threshold=0)


def layers(w):
    return {name: rows(w.table(name), "*") for name in BUILDERS}


def files_below(folder):
    found = {}
    for at, _, names in os.walk(folder):
        for name in names:
            path = os.path.join(at, name)
            found[path] = (os.stat(path).st_mtime_ns, os.stat(path).st_size)
    return found


def test_runs_over_arrivals(spark, tmp_path):
    stage, root = write_stage(tmp_path / "stage", FILES), str(tmp_path / "root")
    first = run_arrivals(spark, stage, root, clock_of(2), reports=["kpi2_conversion"])
    batch = run(spark, stage, str(tmp_path / "batch"), clock_of(2), reports=())
    assert layers(first) == layers(batch)
    assert finished_runs(spark, root) == ["20240201T000000000250"]
    rejects = spark.read.parquet(f"{root}/bronze/housekeeping_rejects")
    assert rows(rejects, "rejected_columns") == [("start_time",)]

    # The same run again reads no file and changes nothing.
    bronze = files_below(tmp_path / "root" / "bronze")
    again = run_arrivals(spark, stage, root, clock_of(2), reports=())
    assert layers(again) == layers(batch)
    assert files_below(tmp_path / "root" / "bronze") == bronze

    # New files only, in folders of their own; keys and versions go on.
    write_stage(tmp_path / "stage", LATER)
    second = run_arrivals(spark, stage, root, clock_of(3), reports=())
    now = files_below(tmp_path / "root" / "bronze")
    assert bronze.items() <= now.items()
    assert rows(loads(spark, f"{root}/bronze", "guests"), "load", "loaded_rows", "files") == [
        ("regular-0000000000", 4, 2),
        ("regular-0000000001", 2, 2),
    ]
    guests = rows(second.table("dim_guest"), "guest_id", "scd_version", "loyalty_tier", "is_current")
    assert guests == [
        ("1000", 1, "Gold", True),
        ("1001", 1, "Gold", False),
        ("1001", 2, "Platinum", True),
        ("1002", 1, "Bronze", False),
        ("1002", 2, "Silver", True),
    ]
    for table, natural, key in (
        ("dim_guest", ["guest_id", "scd_version"], "guest_sk"),
        ("dim_room", ["room_id", "scd_version"], "room_sk"),
        ("reservation_load", ["reservation_id"], "reservation_sk"),
        ("fact_billing", ["bill_id"], "billing_sk"),
    ):
        old, new = rows(first.table(table), key, *natural), rows(second.table(table), key, *natural)
        assert set(old) <= set(new)  # no key has changed, though new ones sort before old ones
        keys = sorted(r[0] for r in new)
        assert keys == list(range(1, len(new) + 1))
    assert rows(second.table("fact_reservation").where("reservation_id = 'R0'"), "guest_id", "length_of_stay") == [("1000", 3)]


def test_force_loads_once_more(spark, tmp_path):
    incoming = tmp_path / "in"
    write_stage(tmp_path / "in", {"a.csv": FILES["reservations/reservations_1.csv"]})
    bronze, history = str(tmp_path / "bronze"), str(tmp_path / "history")

    def load(force=None):
        load_arrivals(spark, "reservations", str(incoming), bronze, history, dt.datetime(2024, 1, 1), force)
        return bronze_rows(spark, bronze, "reservations").count()

    assert [load(), load()] == [5, 5]
    assert [load("x"), load("x"), load()] == [10, 10, 10]
    assert load("y") == 15
    write_stage(tmp_path / "in", {"b.csv": FILES["reservations/reservations_1.csv"][:2]})
    assert load() == 16


def test_batches_of_single_files(spark, tmp_path):
    head, *lines = FILES["reservations/reservations_1.csv"]
    write_stage(tmp_path / "in", {f"{i}.csv": [head, line] for i, line in enumerate(lines)})
    bronze = str(tmp_path / "bronze")
    load_arrivals(
        spark, "reservations", str(tmp_path / "in"), bronze, str(tmp_path / "h"), dt.datetime(2024, 1, 1), files_per_batch=2
    )
    assert rows(loads(spark, bronze, "reservations"), "loaded_rows") == [(1,), (2,), (2,)]


VERSIONS = (
    "room_id string, hotel_id string, room_type string, floor int, capacity int, amenities string, status string, "
    "base_price decimal(18,2), scd_start_date date, scd_end_date date, is_current boolean, scd_version int, "
    "_loaded_at timestamp_ntz, _source_file string"
)


BUSINESS = VERSIONS.split(", scd_start_date")[0]


def arriving(spark, *changes):
    """Increment rows of rooms with a new price and status."""
    at, name = dt.datetime(2024, 2, 1), "rooms_inc.csv"
    data = [(key, "H001", "Suite", 1, 2, "WiFi", "Occupied", Decimal(price), at, name) for key, price in changes]
    return spark.createDataFrame(data, f"{BUSINESS}, _loaded_at timestamp_ntz, _file_name string")


@pytest.fixture
def rooms(spark):
    at, end = dt.datetime(2024, 1, 1), dt.date(9999, 12, 31)
    stamp = (at.date(), end, True, 1, at, "rooms.csv")
    data = [(f"r{i}", "H001", "Suite", 1, 2, "WiFi", "Available", Decimal(100), *stamp) for i in range(200)]
    return spark.createDataFrame(data, VERSIONS)


def merge(old, new):
    return scd.merge_rooms(old, new, dt.datetime(2024, 2, 1))


def test_partitions_without_arrivals_keep_their_files(spark, tmp_path, rooms):
    table, staging = str(tmp_path / "t"), str(tmp_path / "s")
    scd.write_versions(rooms, table, "room_id", 16)
    before = files_below(table)
    new = arriving(spark, ("r3", 120), ("r77", 90), ("new", 10), (None, 5))
    touched = {f"{scd.BUCKET}={r[0]}" for r in new.where("room_id is not null").select(scd.bucket_of("room_id", 16)).collect()}
    merged = scd.merge_buckets(table, new, "room_id", 16, merge, staging)
    after = files_below(table)
    kept = {p for p in before if p.endswith(".parquet") and os.path.basename(os.path.dirname(p)) not in touched}
    assert kept and all(after.get(p) == before[p] for p in kept)
    assert not any(p in after for p in before if os.path.basename(os.path.dirname(p)) in touched and p.endswith(".parquet"))

    whole = merge(rooms, new)
    columns = rooms.columns
    assert rows(spark.read.parquet(table), *columns) == rows(whole, *columns)
    changed = merged.where("action in ('expired', 'new_version', 'inserted', 'overwritten')")
    assert rows(changed, "room_id", "action") == rows(whole.where("action not in ('unchanged', 'history')"), "room_id", "action")

    scd.merge_buckets(table, new, "room_id", 16, merge, staging)  # the same again changes nothing
    assert rows(spark.read.parquet(table), *columns) == rows(whole, *columns)


def test_stream_into_partitions(spark, tmp_path, rooms):
    table, incoming = str(tmp_path / "t"), str(tmp_path / "in")
    scd.write_versions(rooms, table, "room_id", 8)
    first, second = arriving(spark, ("r1", 101)), arriving(spark, ("r2", 102), ("r1", 101))
    for batch in (first, second):
        batch.coalesce(1).write.mode("append").parquet(incoming)
        found = merge_increments_in_place(
            spark, incoming, first.schema, table, "room_id", 8, str(tmp_path / "checkpoint"), merge
        )
    expected = merge(merge(rooms, first).drop("action"), second).drop("action")
    assert rows(found.drop(scd.BUCKET), *rooms.columns) == rows(expected, *rooms.columns)


def test_nothing_arrives(spark, tmp_path, rooms):
    table = str(tmp_path / "t")
    scd.write_versions(rooms, table, "room_id", 4)
    before = files_below(table)
    assert scd.merge_buckets(table, arriving(spark, (None, 1)), "room_id", 4, merge, str(tmp_path / "s")).count() == 0
    data = {p: s for p, s in files_below(table).items() if p.endswith(".parquet")}
    assert data == {p: s for p, s in before.items() if p.endswith(".parquet")}
