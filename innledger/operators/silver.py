"""Raw to validated tables: keep valid rows, take the latest per key, derive and clean columns.

The filter comes before the choice of the latest row, so the latest *valid* row wins. The predicates are
exposed on their own because the data-quality checks report what they drop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.functions.columns import minutes_between, truthy
from innledger.operators.dedup import dedup_latest
from innledger.values import (
    LOYALTY_TIERS,
    OPEN_END_DATE,
    RESERVATION_STATUSES,
    ROOM_STATUSES,
    TASK_TYPES,
)

# Bills of one load time are told apart by their amounts first.
BILL_TIES = ("total_amount", "taxes", "discounts")


def clock(ts: dt.datetime) -> Column:
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def valid_guest() -> Column:
    return F.col("guest_id").isNotNull() & F.col("loyalty_tier").isin(*LOYALTY_TIERS)


def valid_room() -> Column:
    return (
        F.col("room_id").isNotNull()
        & (F.col("capacity") > 0)
        & (F.col("base_price") >= 0)
        & F.col("status").isin(*ROOM_STATUSES)
    )


def valid_reservation() -> Column:
    cancelled_on = F.col("cancellation_time").cast("date")
    return (
        F.col("reservation_id").isNotNull()
        & F.col("guest_id").isNotNull()
        & F.col("room_id").isNotNull()
        & (F.col("check_out_date") >= F.col("check_in_date"))
        & (cancelled_on.isNull() | (cancelled_on <= F.col("check_in_date")))
        & F.lower("status").isin(*RESERVATION_STATUSES)
    )


def valid_task() -> Column:
    return (
        F.col("task_id").isNotNull()
        & F.col("room_id").isNotNull()
        & (F.col("end_time").isNull() | (F.col("end_time") >= F.col("start_time")))
        & F.lower(F.trim("task_type")).isin(*TASK_TYPES)
    )


def valid_bill() -> Column:
    return (
        F.col("bill_id").isNotNull()
        & (F.col("total_amount") >= 0)
        & (F.col("taxes") >= 0)
        & (F.col("discounts") >= 0)
    )


def _first_version(valid: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    business = [c for c in valid.columns if not c.startswith("_")]
    return valid.select(
        *business,
        F.lit(batch_ts.date()).alias("scd_start_date"),
        F.lit(OPEN_END_DATE).cast("date").alias("scd_end_date"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("scd_version"),
        clock(batch_ts).alias("_loaded_at"),
        F.col("_file_name").alias("_source_file"),
    )


def silver_guests(raw: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    return _first_version(dedup_latest(raw, ["guest_id"], valid=valid_guest()), batch_ts)


def silver_rooms(raw: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    return _first_version(dedup_latest(raw, ["room_id"], valid=valid_room()), batch_ts)


def silver_reservations(raw: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    latest = dedup_latest(raw, ["reservation_id"], valid=valid_reservation())
    return latest.select(
        "reservation_id",
        "guest_id",
        "room_id",
        "check_in_date",
        "check_out_date",
        F.datediff("check_out_date", "check_in_date").alias("length_of_stay"),
        "booking_channel",
        "booking_time",
        "cancellation_time",
        F.lower("status").alias("status"),
        clock(batch_ts).alias("_loaded_at"),
        F.col("_file_name").alias("_source_file"),
    )


def silver_housekeeping(raw: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    latest = dedup_latest(raw, ["task_id"], valid=valid_task())
    return latest.select(
        "task_id",
        "room_id",
        F.lower(F.trim("task_type")).alias("task_type"),
        "assigned_staff",
        "scheduled_time",
        "start_time",
        "end_time",
        minutes_between("start_time", "end_time").alias("duration_minutes"),
        truthy(F.col("issue_detected_flag")).alias("issue_detected_flag"),
        F.trim("status").alias("status"),
        clock(batch_ts).alias("_loaded_at"),
        F.col("_file_name").alias("_source_file"),
    )


def silver_billing(raw: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    latest = dedup_latest(raw, ["bill_id"], BILL_TIES, valid_bill())
    return latest.select(
        "bill_id",
        "reservation_id",
        "guest_id",
        "total_amount",
        "taxes",
        "discounts",
        "payment_mode",
        "payment_time",
        truthy(F.col("is_flagged")).alias("is_flagged"),
        clock(batch_ts).alias("_loaded_at"),
        F.col("_file_name").alias("_source_file"),
    )


def net_amount() -> Column:
    return F.round(F.col("total_amount") - F.col("discounts") + F.col("taxes"), 2).cast("decimal(18,2)")


def billing_net_amount(bills: DataFrame) -> DataFrame:
    return bills.select(
        "bill_id",
        "reservation_id",
        "guest_id",
        "total_amount",
        "taxes",
        "discounts",
        net_amount().alias("net_amount"),
        "payment_mode",
        "payment_time",
        "is_flagged",
        "_loaded_at",
        "_source_file",
    )
