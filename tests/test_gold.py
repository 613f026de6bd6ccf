import datetime as dt
from decimal import Decimal

from helpers import rows
from innledger.operators import gold
from pyspark.sql import functions as F

DAY, TS = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1)


def dims(spark):
    guests = spark.createDataFrame(
        [(1, "g1", False), (2, "g1", True)], "guest_sk bigint, guest_id string, is_current boolean"
    )
    rooms = spark.createDataFrame(
        [(1, "r1", "H001", Decimal("100"), True), (2, "r2", "H006", Decimal("80"), True)],
        "room_sk bigint, room_id string, hotel_id string, base_price decimal(18,2), is_current boolean",
    )
    return guests, gold.dim_room(rooms, gold.dim_hotel(spark))


def stays(spark):
    data = [
        (1, "a", "g1", "r1", 2),
        (2, "b", "nobody", "r2", 3),
        (3, "c", "g1", "nowhere", 1),
    ]
    df = spark.createDataFrame(
        data, "reservation_sk bigint, reservation_id string, guest_id string, room_id string, length_of_stay int"
    )
    return df.withColumns(
        {
            "check_in_date": F.lit(DAY),
            "check_out_date": F.date_add(F.lit(DAY), F.col("length_of_stay")),
            "booking_channel": F.lit("web"),
            "booking_time": F.lit(TS),
            "cancellation_time": F.lit(None).cast("timestamp_ntz"),
            "status": F.lit("confirmed"),
        }
    )


def test_lookups_take_current_versions_and_keep_unmatched_rows(spark):
    guests, rooms = dims(spark)
    fact = gold.load_reservations(stays(spark), guests, rooms)
    assert rows(fact, "reservation_id", "guest_sk", "room_sk", "hotel_sk", "guest_id", "room_id", "hotel_id") == [
        ("a", 2, 1, 1, "g1", "r1", "H001"),
        ("b", None, 2, None, None, "r2", None),
        ("c", 2, None, None, "g1", None, None),
    ]


def test_bills(spark):
    guests, rooms = dims(spark)
    fact = gold.load_reservations(stays(spark), guests, rooms)
    bills = spark.createDataFrame(
        [
            (1, "b1", "a", "g1", Decimal("700"), Decimal("7.005"), Decimal("1")),
            (2, "b2", "a", "g1", Decimal("700.01"), Decimal("0"), Decimal("0")),
            (3, "b3", "c", "g1", Decimal("9999"), Decimal("0"), Decimal("0")),
            (4, "b4", "lost", None, Decimal("9999"), Decimal("0"), Decimal("0")),
        ],
        "billing_sk bigint, bill_id string, reservation_id string, guest_id string, total_amount decimal(18,2), "
        "taxes decimal(18,2), discounts decimal(18,2)",
    ).withColumns({"payment_mode": F.lit("card"), "payment_time": F.lit(TS), "is_flagged": F.lit(False)})
    loaded = gold.load_billing(bills, fact, guests)
    assert rows(loaded, "bill_id", "reservation_sk", "guest_sk", "billing_mismatch") == [
        ("b1", 1, 2, False),
        ("b2", 1, 2, True),
        ("b3", 3, 2, False),
        ("b4", None, None, False),
    ]


def test_hotels_are_broadcast(spark):
    _, rooms = dims(spark)
    assert "BroadcastHashJoin" in rooms._jdf.queryExecution().executedPlan().toString()
