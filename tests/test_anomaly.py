import datetime as dt
import random
from decimal import Decimal

from helpers import rows
from innledger.operators import anomaly
from pyspark.sql import functions as F

STAY = (
    "reservation_sk bigint, reservation_id string, room_sk bigint, check_in_date date, check_out_date date, "
    "status string"
)
DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def double_booked(spark, stays):
    data = [(i, str(i), room, day(a), day(b), status) for i, (room, a, b, status) in enumerate(stays)]
    unflagged = spark.createDataFrame(data, STAY).withColumn("is_double_booked", F.lit(False))
    flagged = anomaly.flag_double_bookings(unflagged)
    return {int(r.reservation_id) for r in flagged.collect() if r.is_double_booked}


def pairwise(stays):
    live = [(i, s) for i, s in enumerate(stays) if s[3] != "cancelled" and s[0] is not None]
    return {
        i
        for i, a in live
        if any(j != i and b[0] == a[0] and b[1] < a[2] and a[1] < b[2] for j, b in live)
    }


def test_named_cases(spark):
    assert double_booked(spark, [(1, 0, 3, "c"), (1, 3, 5, "c")]) == set()  # back to back
    assert double_booked(spark, [(1, 0, 3, "c"), (1, 2, 5, "c")]) == {0, 1}
    assert double_booked(spark, [(1, 0, 3, "c"), (2, 0, 3, "c")]) == set()  # other room
    assert double_booked(spark, [(1, 0, 3, "c"), (1, 0, 3, "cancelled")]) == set()
    assert double_booked(spark, [(1, 2, 2, "c"), (1, 0, 5, "c")]) == {0, 1}  # no night, inside another stay
    assert double_booked(spark, [(1, 0, 0, "c"), (1, 0, 5, "c")]) == set()  # no night, on the edge
    assert double_booked(spark, [(1, 5, 5, "c"), (1, 0, 5, "c")]) == set()
    assert double_booked(spark, [(1, 0, 9, "c"), (1, 1, 2, "c"), (1, 7, 8, "c")]) == {0, 1, 2}
    assert double_booked(spark, [(None, 0, 3, "c"), (None, 0, 3, "c")]) == set()


def test_equals_pairwise_comparison(spark):
    pick = random.Random(5)
    for density in (6, 20, 60):
        stays = []
        for _ in range(300):
            start = pick.randrange(density)
            status = pick.choice(["confirmed", "completed", "cancelled"])
            stays.append((pick.choice([1, 1, 1, 2, 3, None]), start, start + pick.randrange(4), status))
        assert double_booked(spark, stays) == pairwise(stays)


def test_one_crowded_room(spark):
    """All stays in one room: the answer is right and the room is folded to its days before it is gathered."""
    pick = random.Random(9)
    stays = []
    for _ in range(3000):
        start = pick.randrange(0, 9000, 3)
        stays.append((1, start, start + pick.choice([0, 1, 2, 3, 4]), "confirmed"))
    assert double_booked(spark, stays) == pairwise(stays)


def cancels(spark, data, **options):
    schema = "reservation_id string, guest_sk bigint, cancellation_time timestamp_ntz, status string"
    df = spark.createDataFrame(data, schema).withColumns(
        {"is_suspicious_cancel": F.lit(False), "reservation_sk": F.xxhash64("reservation_id")}
    )
    flagged = anomaly.flag_suspicious_cancels(df, dt.datetime(2024, 1, 2), **options)
    assert flagged.count() == len(data)
    return [r[0] for r in rows(flagged.where("is_suspicious_cancel"), "reservation_id")]


def test_cancel_threshold_is_exceeded_not_met(spark):
    recent, old = dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1)
    three = [(f"a{i}", 1, recent, "cancelled") for i in range(3)]
    four = [(f"b{i}", 2, recent, "cancelled") for i in range(4)]
    others = [("b-old", 2, old, "cancelled"), ("b-kept", 2, None, "completed")]
    nobody = [(f"n{i}", None, recent, "cancelled") for i in range(9)]
    assert cancels(spark, three + four + others + nobody) == ["b-old", "b0", "b1", "b2", "b3"]
    assert cancels(spark, three, threshold=2) == ["a0", "a1", "a2"]
    assert cancels(spark, three, threshold=2, hours=23) == []


def test_mismatch_tolerance(spark):
    bills = spark.createDataFrame(
        [("exact", 1, Decimal("200")), ("edge", 1, Decimal("700")), ("over", 1, Decimal("700.01")),
         ("lost", None, Decimal("9999"))],
        "bill_id string, reservation_sk bigint, total_amount decimal(18,2)",
    )
    price = F.when(F.col("reservation_sk").isNotNull(), F.lit(200)).cast("decimal(18,2)")
    bills = bills.withColumn("agreed_amount", price)
    flagged = anomaly.flag_billing_mismatches(bills.withColumn("billing_mismatch", F.lit(False)))
    assert rows(flagged.where("billing_mismatch"), "bill_id") == [("over",)]
    lower = anomaly.flag_billing_mismatches(bills.withColumn("billing_mismatch", F.lit(False)), 499.5)
    assert rows(lower.where("billing_mismatch"), "bill_id") == [("edge",), ("over",)]
