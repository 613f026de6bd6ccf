"""Counts on the sample views that were worked out beforehand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import sample_dir
from innledger.operators import anomaly, dq, gold, scd
from innledger.operators.keys import assign_keys
from innledger.plans.warehouse import SAMPLE_CLOCK, warehouse

SCALES = ("0.001", "0.01")
SILVER = {
    "silver_guests": (146, 1485),
    "silver_rooms": (187, 1865),
    "silver_reservations": (1444, 14472),
    "silver_housekeeping": (790, 7891),
    "silver_billing": (4520, 44880),
}
RULES = {
    "dq_guest_missing": (3, 29),
    "dq_room_values": (9, 90),
    "dq_room_status": (5, 47),
    "dq_res_dates": (8, 77),
    "dq_res_cancel_late": (41, 382),
    "dq_res_orphan_guest": (52, 227),
    "dq_res_orphan_room": (60, 610),
    "dq_res_status": (8, 76),
    "dq_hk_times": (11, 111),
    "dq_hk_orphan_room": (60, 401),
    "dq_hk_task_type": (201, 2014),
    "dq_billing_negative": (120, 1649),
    "dq_billing_orphan_res": (235, 2208),
    "dq_billing_payment_before_booking": (2658, 27771),
    "vc_total_amount": (67, 618),
    "vc_taxes": (51, 562),
    "vc_discounts": (73, 535),
    "vc_capacity": (5, 49),
    "vc_hk_status": (11, 104),
}


@pytest.mark.parametrize("scale", range(2), ids=SCALES)
def test_silver_sizes(spark, scale):
    w = warehouse(spark, sample_dir(SCALES[scale]))
    assert {n: w.table(n).count() for n in SILVER} == {n: c[scale] for n, c in SILVER.items()}


@pytest.mark.parametrize("scale", range(2), ids=SCALES)
def test_rule_hits(spark, scale):
    from innledger.plans.registry import QUERIES

    w = warehouse(spark, sample_dir(SCALES[scale]))
    assert {n: QUERIES[n](w).count() for n in RULES} == {n: c[scale] for n, c in RULES.items()}
    invalid = dq.guest_tier_profile(w.raw("raw_guests")).where("is_invalid")
    assert invalid.agg(F.sum("guest_count")).first()[0] == (4, 15)[scale]


@pytest.mark.parametrize("scale", range(2), ids=SCALES)
def test_billing_sums_with_ties(spark, scale):
    bills = warehouse(spark, sample_dir(SCALES[scale])).table("silver_billing")
    sums = bills.agg(*[F.sum(c).cast("string") for c in ("total_amount", "taxes", "discounts")]).first()
    assert tuple(sums) == (
        ("239934490.07", "9632168.73", "12270960.62"),
        ("2378458887.08", "94921226.50", "118845963.53"),
    )[scale]


@pytest.mark.parametrize("scale", range(2), ids=SCALES)
def test_anomalies_on_first_versions(spark, scale):
    """Star schema straight from the first load, before any increment."""
    w = warehouse(spark, sample_dir(SCALES[scale]))
    guests = w.table("silver_guests").withColumn("guest_sk", F.col("guest_id").cast("bigint"))
    rooms = gold.dim_room(
        w.table("silver_rooms").withColumn("room_sk", F.col("room_id").cast("bigint")), gold.dim_hotel(spark)
    )
    stays = gold.load_reservations(
        assign_keys(w.stored("silver_reservations"), "reservation_sk"), guests, rooms
    ).cache()
    bills = gold.load_billing(assign_keys(w.stored("silver_billing"), "billing_sk"), stays, guests)

    doubles = anomaly.flag_double_bookings(stays)
    assert doubles.where("is_double_booked").count() == (12, 160)[scale]

    cancels = anomaly.flag_suspicious_cancels(stays, dt.datetime(2001, 8, 1), hours=8760, threshold=1)
    assert cancels.where("is_suspicious_cancel").count() == (59, 607)[scale]
    strict = anomaly.flag_suspicious_cancels(stays, dt.datetime(2001, 8, 1))
    assert strict.where("is_suspicious_cancel").count() == 0

    for tolerance, expected in ((500, (4040, 39892)), (30000, (2790, 27400))):
        flagged = anomaly.flag_billing_mismatches(bills, tolerance)
        assert flagged.where("billing_mismatch").count() == expected[scale]
    assert bills.where("billing_mismatch").count() == (4040, 39892)[scale]


@pytest.mark.parametrize("scale", range(2), ids=SCALES)
def test_merge_of_the_changed_tenth(spark, scale):
    """Only the keys that really change, as a small increment."""
    w = warehouse(spark, sample_dir(SCALES[scale]))
    guest_part = w.raw("raw_guests_inc").where("cast(guest_id as bigint) % 10 = 3")
    room_part = w.raw("raw_rooms_inc").where("cast(room_id as bigint) % 10 = 7")
    guests = scd.merge_guests(w.table("silver_guests"), guest_part, SAMPLE_CLOCK.merged)
    rooms = scd.merge_rooms(w.table("silver_rooms"), room_part, SAMPLE_CLOCK.merged)
    assert guests.where("action = 'new_version'").count() == (12, 110)[scale]
    assert rooms.where("action = 'new_version'").count() == (12, 123)[scale]
    assert rooms.where("action = 'inserted'").count() == (1, 13)[scale]
