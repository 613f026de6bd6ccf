"""Version merges: the worked scenario and the edges around it."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from innledger.operators import scd, silver

DAY1, DAY2, DAY3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
TS1, TS2, TS3 = (dt.datetime.combine(d, dt.time(6)) for d in (DAY1, DAY2, DAY3))
GUEST = (
    "guest_id string, name string, dob date, gender string, email string, phone string, address string, "
    "city string, country string, loyalty_tier string, registration_date date, _loaded_at timestamp_ntz, "
    "_file_name string"
)
ROOM = (
    "room_id string, hotel_id string, room_type string, floor int, capacity int, amenities string, "
    "status string, base_price decimal(18,2), _loaded_at timestamp_ntz, _file_name string"
)


def guest(key, tier, ts, email="a@mail.test", file="guests_inc.csv"):
    born, joined = dt.date(1990, 1, 1), dt.date(2020, 1, 1)
    return (key, f"Name {key}", born, "F", email, "1", "Street", "City", "Land", tier, joined, ts, file)


def room(key, amenities, price, ts, status="Available", capacity=2):
    return (key, "H001", "Deluxe", 3, capacity, amenities, status, Decimal(price), ts, "rooms_inc.csv")


@pytest.fixture(scope="module")
def guests(spark):
    data = [guest("1001", "Gold", TS1), guest("1002", "Gold", TS1), guest("1005", "Bronze", TS1), guest("1", "Gold", TS1)]
    return silver.silver_guests(spark.createDataFrame(data, GUEST), TS1)


@pytest.fixture(scope="module")
def increment(spark):
    return spark.createDataFrame(
        [guest("1001", "Platinum", TS2), guest("1002", "Platinum", TS2), guest("1005", "Silver", TS2)], GUEST
    )


def versions(df, *columns):
    return rows(df, *columns, "scd_version", "is_current", "scd_start_date", "scd_end_date")


OPEN = dt.date(9999, 12, 31)
ENDED = dt.date(2024, 1, 31)


def test_tier_changes(guests, increment):
    merged = scd.merge_guests(guests, increment, TS2)
    assert versions(merged, "guest_id", "loyalty_tier") == [
        ("1", "Gold", 1, True, DAY1, OPEN),
        ("1001", "Gold", 1, False, DAY1, ENDED),
        ("1001", "Platinum", 2, True, DAY2, OPEN),
        ("1002", "Gold", 1, False, DAY1, ENDED),
        ("1002", "Platinum", 2, True, DAY2, OPEN),
        ("1005", "Bronze", 1, False, DAY1, ENDED),
        ("1005", "Silver", 2, True, DAY2, OPEN),
    ]
    summary = scd.merge_summary(merged, "VAL_GUESTS").first()
    assert (summary.expired_rows, summary.new_version_rows, summary.unchanged_rows) == (3, 3, 1)
    assert len({r.guest_id for r in scd.changed_history(merged, "guest_id").collect()}) == 3


def test_same_increment_twice_changes_nothing(guests, increment):
    once = scd.merge_guests(guests, increment, TS2)
    twice = scd.merge_guests(once.drop("action"), increment, TS3)
    assert rows(once.drop("action"), "*") == rows(twice.drop("action"), "*")
    assert {r.action for r in twice.collect()} == {"history", "unchanged"}


def test_third_version(spark, guests, increment):
    once = scd.merge_guests(guests, increment, TS2).drop("action")
    again = scd.merge_guests(once, spark.createDataFrame([guest("1001", "Gold", TS3)], GUEST), TS3)
    assert versions(again.where("guest_id = '1001'"), "loyalty_tier") == [
        ("Gold", 1, False, DAY1, ENDED),
        ("Gold", 3, True, DAY3, OPEN),
        ("Platinum", 2, False, DAY2, dt.date(2024, 2, 29)),
    ]


def test_contact_data_is_overwritten_without_a_version(spark, guests):
    source = spark.createDataFrame(
        [guest("1001", "Gold", TS2, "new@mail.test"), guest("1002", "Diamond", TS2, "other@mail.test")], GUEST
    )
    merged = scd.merge_guests(guests, source, TS2)
    assert rows(merged.where("action = 'overwritten'"), "guest_id", "loyalty_tier", "email", "scd_version") == [
        ("1001", "Gold", "new@mail.test", 1),
        ("1002", "Gold", "other@mail.test", 1),
    ]


def test_unknown_keys(spark, guests):
    source = spark.createDataFrame(
        [guest("2", "Silver", TS2), guest("3", "Diamond", TS2), guest(None, "Silver", TS2)], GUEST
    )
    merged = scd.merge_guests(guests, source, TS2)
    new = merged.where("action = 'inserted'").collect()
    assert [(r.guest_id, r.loyalty_tier, r.scd_version, r.dob) for r in new] == [
        ("2", "Silver", 1, dt.date(1990, 1, 1))
    ]
    assert merged.count() == 5


def test_latest_valid_row_decides_the_version_and_latest_row_the_contact(spark, guests):
    source = spark.createDataFrame(
        [guest("1001", "Platinum", TS2, "valid@mail.test"), guest("1001", "Diamond", TS3, "last@mail.test")], GUEST
    )
    merged = scd.merge_guests(guests, source, TS2)
    current = merged.where("guest_id = '1001' and is_current").first()
    assert (current.loyalty_tier, current.email, current.scd_version) == ("Platinum", "last@mail.test", 2)


def test_null_tier_counts_as_change_only_if_asked(spark, guests):
    target = guests.withColumn("loyalty_tier", F.when(F.col("guest_id") != "1", F.col("loyalty_tier")))
    source = spark.createDataFrame([guest("1", "Gold", TS2)], GUEST)

    def actions(null_safe):
        merged = scd.scd2_merge(
            target, source, "guest_id", ["loyalty_tier"], ["email"], TS2, silver.valid_guest(),
            null_safe=null_safe,
        )
        return sorted(r.action for r in merged.where("guest_id = '1'").collect())

    assert actions(False) == ["unchanged"]
    assert actions(True) == ["expired", "new_version"]


def test_room_changes(spark):
    before = [
        room("301", "WiFi;TV", "120", TS1),
        room("302", "WiFi;TV", "250", TS1, "Occupied"),
        room("305", "WiFi", "300", TS1, "Occupied"),
        room("310", "WiFi", "125", TS1),
        room("311", "WiFi", "90", TS1),
    ]
    after = [
        room("301", "WiFi;TV", "150", TS2),
        room("302", "WiFi;TV;Balcony", "250", TS2, "Occupied"),
        room("305", "WiFi;Jacuzzi", "350", TS2, "Occupied"),
        room("310", "WiFi", "110", TS2),
        room("311", "WiFi", "90", TS2, "Maintenance", capacity=0),
    ]
    rooms = silver.silver_rooms(spark.createDataFrame(before, ROOM), TS1)
    merged = scd.merge_rooms(rooms, spark.createDataFrame(after, ROOM), TS2)
    current = merged.where("is_current")
    assert rows(current, "room_id", "amenities", F.col("base_price").cast("int"), "scd_version", "capacity") == [
        ("301", "WiFi;TV", 150, 2, 2),
        ("302", "WiFi;TV;Balcony", 250, 2, 2),
        ("305", "WiFi;Jacuzzi", 350, 2, 2),
        ("310", "WiFi", 110, 2, 2),
        ("311", "WiFi", 90, 1, 2),
    ]
    assert merged.count() == 9


def test_same_day_change_ends_the_day_before(guests, increment):
    merged = scd.merge_guests(guests, increment, TS1)
    ended = merged.where("action = 'expired'").first()
    assert (ended.scd_start_date, ended.scd_end_date) == (DAY1, dt.date(2023, 12, 31))
