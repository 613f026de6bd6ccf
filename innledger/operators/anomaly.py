"""Anomaly detection over the facts. All flags are recomputed from their inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innledger.functions.columns import holds, sla_breached
from innledger.operators.silver import clock
from innledger.operators.skew import salted_join
from innledger.values import CANCEL_THRESHOLD, CANCEL_WINDOW_HOURS, MISMATCH_TOLERANCE


def double_booked_keys(reservations: DataFrame) -> DataFrame:
    """Keys of live stays that share a night in a room with another one; needs check-out >= check-in.

    A stay overlaps another one exactly if an earlier arrival leaves after it begins, or another stay
    of at least one night arrives on the same day, or someone arrives before it ends. All three can be
    read from one row per room and arrival day. Rows are folded into these before any room is gathered,
    so a room's window holds at most one row per calendar day, however many reservations it has.
    """
    check_in, check_out = F.col("check_in_date"), F.col("check_out_date")
    live = reservations.where((F.col("status") != "cancelled") & F.col("room_sk").isNotNull()).select(
        "reservation_sk", "room_sk", "check_in_date", "check_out_date"
    )
    days = live.groupBy(F.col("room_sk").alias("_room_sk"), check_in.alias("_day")).agg(
        F.max("check_out_date").alias("_last_out"),
        F.count_if(check_out > check_in).alias("_staying"),
    )
    by_day = Window.partitionBy("_room_sk").orderBy("_day")
    earlier = by_day.rowsBetween(Window.unboundedPreceding, -1)
    around = days.select(
        "_room_sk",
        "_day",
        F.max("_last_out").over(earlier).alias("_earlier_out"),
        F.lead("_day").over(by_day).alias("_next_in"),
        "_staying",
    )
    clash = (
        holds(F.col("_earlier_out") > check_in)
        | holds((F.col("_staying") > 1) & (check_out > check_in))
        | holds(F.col("_next_in") < check_out)
    )
    same_day = (F.col("room_sk") == F.col("_room_sk")) & (check_in == F.col("_day"))
    return live.join(around, same_day).where(clash).select("reservation_sk")


def suspicious_cancel_keys(
    reservations: DataFrame,
    as_of: dt.datetime,
    hours: int = CANCEL_WINDOW_HOURS,
    threshold: int = CANCEL_THRESHOLD,
) -> DataFrame:
    """Keys of all cancellations of guests with more than `threshold` recent ones."""
    cancelled = reservations.where((F.col("status") == "cancelled") & F.col("guest_sk").isNotNull())
    since = clock(as_of - dt.timedelta(hours=hours))
    suspects = (
        cancelled.where(F.col("cancellation_time") >= since)
        .groupBy(F.col("guest_sk").alias("_suspect"))
        .count()
        .where(F.col("count") > threshold)
        .select("_suspect")
    )
    narrow = cancelled.select("reservation_sk", "guest_sk")
    return salted_join(narrow, suspects, "guest_sk", "_suspect", ["reservation_sk"], "left_semi").select(
        "reservation_sk"
    )


def _mark(reservations: DataFrame, keys: DataFrame, flag: str) -> DataFrame:
    """Sets the flag on the given keys. Detection moves narrow rows; only this moves whole ones."""
    marked = keys.select(F.col("reservation_sk").alias("_marked"))
    joined = reservations.join(marked, F.col("reservation_sk") == F.col("_marked"), "left")
    return joined.withColumn(flag, F.col("_marked").isNotNull()).select(*reservations.columns)


def flag_double_bookings(reservations: DataFrame) -> DataFrame:
    """Sets `is_double_booked`."""
    return _mark(reservations, double_booked_keys(reservations), "is_double_booked")


def flag_suspicious_cancels(
    reservations: DataFrame,
    as_of: dt.datetime,
    hours: int = CANCEL_WINDOW_HOURS,
    threshold: int = CANCEL_THRESHOLD,
) -> DataFrame:
    """Sets `is_suspicious_cancel`."""
    keys = suspicious_cancel_keys(reservations, as_of, hours, threshold)
    return _mark(reservations, keys, "is_suspicious_cancel")


def refresh_sla_flags(tasks: DataFrame) -> DataFrame:
    return tasks.withColumn("sla_breached", sla_breached(F.col("task_type"), F.col("duration_minutes")))


def flag_billing_mismatches(
    bills: DataFrame, tolerance: float = MISMATCH_TOLERANCE
) -> DataFrame:
    """Sets `billing_mismatch` where a bill is off the price of its stay, which it carries, by more than `tolerance`."""
    off = F.abs(F.col("total_amount") - F.col("agreed_amount")) > tolerance
    return bills.withColumn("billing_mismatch", holds(off))


def flag_reservations(
    reservations: DataFrame,
    as_of: dt.datetime,
    hours: int = CANCEL_WINDOW_HOURS,
    threshold: int = CANCEL_THRESHOLD,
) -> DataFrame:
    """Both reservation flags. Both sets of keys meet the rows on the same key, in one shuffle."""
    doubles = double_booked_keys(reservations)
    cancels = suspicious_cancel_keys(reservations, as_of, hours, threshold)
    return _mark(_mark(reservations, doubles, "is_double_booked"), cancels, "is_suspicious_cancel")


def run_anomalies(
    reservations: DataFrame,
    tasks: DataFrame,
    bills: DataFrame,
    as_of: dt.datetime,
    hours: int = CANCEL_WINDOW_HOURS,
    threshold: int = CANCEL_THRESHOLD,
    tolerance: float = MISMATCH_TOLERANCE,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All four detections: the flagged reservation, housekeeping and billing facts."""
    return (
        flag_reservations(reservations, as_of, hours, threshold),
        refresh_sla_flags(tasks),
        flag_billing_mismatches(bills, tolerance),
    )


def anomaly_summary(reservations: DataFrame, tasks: DataFrame, bills: DataFrame) -> DataFrame:
    """One row with the number of rows behind each flag."""
    from_tasks = tasks.agg(
        F.struct(
            F.count_if("sla_breached").alias("sla_breaches"), F.count_if("issue_detected_flag").alias("issues_found")
        )
    )
    from_bills = bills.agg(
        F.struct(
            F.count_if("is_flagged").alias("flagged_bills"), F.count_if("billing_mismatch").alias("billing_mismatches")
        )
    )
    return (
        reservations.agg(
            F.count_if("is_double_booked").alias("double_bookings"),
            F.count_if("is_suspicious_cancel").alias("suspicious_cancels"),
        )
        .withColumn("_t", from_tasks.scalar())
        .withColumn("_b", from_bills.scalar())
        .select("double_bookings", "suspicious_cancels", "_t.*", "_b.*")
    )
