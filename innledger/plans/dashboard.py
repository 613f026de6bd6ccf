"""Data behind the operations dashboard, from the wide facts and current dimensions.

Group-bys follow the dashboard's habit of leaving out rows without a group value. Slicers narrow
reservations and guests only; bills, rooms and tasks are always shown whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.functions.columns import histogram_bin, mean, pct, sla_limit
from innledger.operators.dq import union_all
from innledger.plans.kpi import not_cancelled
from innledger.plans.reports import money
from innledger.values import CANCEL_WARNING, GAUGES, HISTOGRAM_BINS, PASS_THRESHOLDS, TASK_TYPES


def slice_reservations(
    reservations: DataFrame, hotel: str | None = None, channels: Sequence[str] = ()
) -> DataFrame:
    """No hotel and no channel chosen means no filter."""
    if hotel is not None:
        reservations = reservations.where(F.col("hotel_id") == hotel)
    if channels:
        reservations = reservations.where(F.col("booking_channel").isin(*channels))
    return reservations


def slice_guests(guests: DataFrame, tiers: Sequence[str] = ()) -> DataFrame:
    return guests.where(F.col("loyalty_tier").isin(*tiers)) if tiers else guests


def sliced_rows(
    reservations: DataFrame, guests: DataFrame, hotel: str, channels: Sequence[str], tiers: Sequence[str]
) -> DataFrame:
    """What remains under a slicer setting, as one listing of both entities."""
    kept = slice_reservations(reservations, hotel, channels)
    people = slice_guests(guests, tiers)
    return kept.select(
        F.lit("reservation").alias("entity"),
        F.col("reservation_id").alias("record_id"),
        F.col("booking_channel").alias("slice_value"),
    ).unionByName(
        people.select(
            F.lit("guest").alias("entity"),
            F.col("guest_id").alias("record_id"),
            F.col("loyalty_tier").alias("slice_value"),
        )
    )


def at_least_one(count: Column) -> Column:
    return F.greatest(count, F.lit(1))


def share_met(breached: str) -> Column:
    """Percent of rows that are not in breach, from the share of those that are."""
    return F.round(100.0 * (1.0 - F.avg(F.col(breached).cast("double"))), 1)


def header_kpis(reservations: DataFrame, rooms: DataFrame, tasks: DataFrame, bills: DataFrame) -> DataFrame:
    """The header cards in one row; each table is read once and leaves one row behind."""
    room_count = rooms.agg(F.count("*")).scalar()
    task_measures = tasks.agg(F.struct(share_met("sla_breached").alias("sla_pct"))).scalar()
    bill_measures = bills.agg(
        F.struct(
            F.coalesce(money("total_amount"), F.lit(0)).cast("decimal(38,2)").alias("total_revenue"),
            F.count("*").alias("total_bills"),
            F.count_if("is_flagged").alias("flagged_bills"),
        )
    ).scalar()
    counts = reservations.agg(
        F.count("*").alias("total_reservations"),
        F.count_if(F.col("status") == "cancelled").alias("cancellations"),
        F.count_if(F.col("status") == "completed").alias("completed_stays"),
        F.count_if(not_cancelled()).alias("_kept"),
    )
    rooms_n, all_n = at_least_one(F.col("_rooms")), at_least_one(F.col("total_reservations"))
    return (
        counts.withColumn("_rooms", room_count)
        .withColumn("_t", task_measures)
        .withColumn("_b", bill_measures)
        .select(
            "total_reservations",
            "cancellations",
            "completed_stays",
            "_b.*",
            pct(F.col("_kept"), rooms_n, 1).alias("occupancy_pct"),
            F.round(F.col("_b.total_revenue").cast("double") / rooms_n.cast("double"), 2).alias("revpar"),
            F.col("_t.sla_pct").alias("sla_pct"),
            F.round(
                1.0 - F.col("_b.flagged_bills").cast("double") / at_least_one(F.col("_b.total_bills")), 4
            ).alias("billing_accuracy"),
            pct(F.col("completed_stays"), all_n, 2).alias("conversion_pct"),
            pct(F.col("cancellations"), all_n, 1).alias("cancel_rate_pct"),
            (F.col("cancellations") > CANCEL_WARNING).alias("cancel_warning"),
        )
    )


def monthly_bookings(reservations: DataFrame) -> DataFrame:
    month = F.date_format("check_in_date", "yyyy-MM").alias("month")
    dated = reservations.where(F.col("check_in_date").isNotNull())
    return dated.groupBy(month).agg(F.count("*").alias("bookings")).orderBy("month")


def value_counts(frames: Sequence[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Rows per value for several columns in long form, one scan per frame."""
    parts = []
    for df, columns in frames:
        pairs = [F.struct(F.lit(dim).alias("dimension"), F.col(c).alias("value")) for dim, c in columns.items()]
        counts = df.select(F.inline(F.array(*pairs))).where("value is not null").groupBy("dimension", "value")
        parts.append(counts.agg(F.count("*").alias("count")))
    return union_all(parts)


def los_distribution(reservations: DataFrame) -> DataFrame:
    nights = reservations.where(F.col("length_of_stay").isNotNull())
    return nights.groupBy(F.col("length_of_stay").alias("nights")).agg(F.count("*").alias("count")).orderBy("nights")


def revenue_by_channel(reservations: DataFrame, bills: DataFrame) -> DataFrame:
    """Revenue and bookings per channel; a reservation counts once per bill, at least once.

    Bills are folded per reservation before the join, which keeps the count of bills exact.
    """
    billed = bills.groupBy("reservation_id").agg(
        F.sum("total_amount").alias("_amount"), F.count("*").alias("_bills")
    )
    rows = at_least_one(F.coalesce(F.col("_bills"), F.lit(0)))
    return (
        reservations.where(F.col("booking_channel").isNotNull())
        .select("reservation_id", "booking_channel")
        .join(billed, "reservation_id", "left")
        .groupBy("booking_channel")
        .agg(
            F.coalesce(F.sum("_amount"), F.lit(0)).cast("decimal(38,2)").alias("revenue"),
            F.sum(rows).alias("bookings"),
        )
        .orderBy(F.desc("revenue"), "booking_channel")
    )


def reservation_listing(reservations: DataFrame) -> DataFrame:
    """Newest arrivals first, with those of the wanted columns that exist."""
    wanted = [
        "reservation_id",
        "guest_id",
        "room_id",
        "hotel_id",
        "check_in_date",
        "check_out_date",
        "length_of_stay",
        "booking_channel",
        "status",
    ]
    shown = [c for c in wanted if c in reservations.columns]
    return reservations.select(*shown).orderBy(F.desc("check_in_date"), "reservation_id")


def sla_split(tasks: DataFrame) -> DataFrame:
    counts = (
        tasks.where(F.col("task_type").isNotNull())
        .groupBy("task_type")
        .agg(F.count("task_id").alias("total"), F.count_if("sla_breached").alias("breached"))
    )
    return counts.withColumn("passed", F.col("total") - F.col("breached"))


def _histogram(df: DataFrame, column: str, groups: Sequence[str], count: str) -> DataFrame:
    """Rows per bin between the lowest and highest value, which come from a scalar subquery."""
    values = df.where(F.col(column).isNotNull()).withColumn("_x", F.col(column).cast("double"))
    bounds = values.agg(F.struct(F.min("_x").alias("low"), F.max("_x").alias("high"))).scalar()
    low, high = F.col("_range.low"), F.col("_range.high")
    step = (high - low) / HISTOGRAM_BINS
    bins = (
        values.withColumn("_range", bounds)
        .groupBy(*groups, "_range", histogram_bin(F.col("_x"), low, high, HISTOGRAM_BINS).alias("bin"))
        .agg(F.count("*").alias(count))
    )
    edges = [
        F.round(low + F.col("bin") * step, 4).alias("bin_start"),
        F.round(low + (F.col("bin") + 1) * step, 4).alias("bin_end"),
    ]
    return bins.select(*groups, "bin", *edges, count)


def duration_histogram(tasks: DataFrame) -> DataFrame:
    """Durations per task type next to the service level of the type."""
    bins = _histogram(tasks, "duration_minutes", ["task_type"], "tasks")
    return bins.withColumn("sla_minutes", sla_limit(F.col("task_type")))


def amount_histogram(bills: DataFrame) -> DataFrame:
    return _histogram(bills, "total_amount", [], "bills")


def staff(tasks: DataFrame) -> DataFrame:
    return (
        tasks.where(F.col("assigned_staff").isNotNull())
        .groupBy("assigned_staff")
        .agg(
            F.count("task_id").alias("tasks"),
            mean("duration_minutes", 1).alias("avg_dur"),
            F.count_if("issue_detected_flag").alias("issues"),
            F.count_if("sla_breached").alias("breaches"),
        )
        .orderBy(F.desc("tasks"), "assigned_staff")
    )


def issue_pct_by_hotel(tasks: DataFrame) -> DataFrame:
    counts = (
        tasks.where(F.col("hotel_id").isNotNull())
        .groupBy("hotel_id")
        .agg(F.count_if("issue_detected_flag").alias("issues"), F.count("task_id").alias("total"))
    )
    return counts.withColumn("issue_pct", pct(F.col("issues"), F.col("total"), 1))


def revenue_by_mode(bills: DataFrame) -> DataFrame:
    named = bills.where(F.col("payment_mode").isNotNull())
    return (
        named.groupBy("payment_mode")
        .agg(F.coalesce(money("total_amount"), F.lit(0)).cast("decimal(38,2)").alias("revenue"))
        .orderBy(F.desc("revenue"), "payment_mode")
    )


def flagged(bills: DataFrame) -> DataFrame:
    columns = ["bill_id", "reservation_id", "guest_id", "total_amount", "payment_mode", "is_flagged"]
    return bills.where("is_flagged").select(*columns)


def billing_listing(bills: DataFrame) -> DataFrame:
    return bills.select(
        "bill_id",
        "reservation_id",
        "total_amount",
        "taxes",
        "discounts",
        "net_amount",
        "payment_mode",
        "is_flagged",
    ).orderBy(F.desc("total_amount"), "bill_id")


def flag_count(df: DataFrame, column: str) -> Column:
    """Rows with the flag set; a table without the column counts none."""
    return F.count_if(column) if column in df.columns else F.lit(0).cast("bigint")


def anomaly_counts(reservations: DataFrame, tasks: DataFrame, bills: DataFrame) -> DataFrame:
    return (
        reservations.agg(
            flag_count(reservations, "is_double_booked").alias("double_bookings"),
            flag_count(reservations, "is_suspicious_cancel").alias("suspicious_cancels"),
        )
        .withColumn("sla_breaches", tasks.agg(F.count_if("sla_breached")).scalar())
        .withColumn("billing_mismatches", bills.agg(flag_count(bills, "billing_mismatch")).scalar())
    )


def double_booked(reservations: DataFrame) -> DataFrame:
    columns = ["reservation_id", "guest_id", "room_id", "check_in_date", "check_out_date", "status"]
    return reservations.where("is_double_booked").select(*columns)


def suspicious(reservations: DataFrame) -> DataFrame:
    columns = ["reservation_id", "guest_id", "check_in_date", "status"]
    return reservations.where("is_suspicious_cancel").select(*columns)


def sla_breaches(tasks: DataFrame) -> DataFrame:
    columns = ["task_id", "room_id", "hotel_id", "task_type", "assigned_staff", "duration_minutes", "status"]
    return tasks.where("sla_breached").select(*columns)


# Indicator code, label and formula, in display order.
SUMMARY = (
    ("occupancy", "KPI 1 — Room Occupancy Rate", "Occupied rooms / Total rooms × 100"),
    ("conversion", "KPI 2 — Booking Conversion Efficiency", "(Completed stays / Total reservations) × 100"),
    ("sla_cleaning", "KPI 3 — Housekeeping SLA (Cleaning)", "% cleaning tasks completed ≤ 45 min"),
    ("sla_maintenance", "KPI 3 — Housekeeping SLA (Maintenance)", "% maintenance tasks completed ≤ 120 min"),
    ("revpar", "KPI 4 — RevPAR", "Total revenue / Total available rooms"),
    ("billing_accuracy", "KPI 5 — Billing Accuracy Index", "1 − (billing anomalies / total bills)"),
)


def kpi_summary(reservations: DataFrame, rooms: DataFrame, tasks: DataFrame, bills: DataFrame) -> DataFrame:
    """One row per indicator: value, PASS or LOW, and for the gauges target, distance to it and band."""

    def met(task_type: str) -> Column:
        breached = F.when(F.col("task_type") == task_type, F.col("sla_breached").cast("double"))
        return F.coalesce(F.round(100.0 * (1.0 - F.avg(breached)), 1), F.lit(0.0)).alias(task_type)

    per_type = tasks.agg(F.struct(*[met(t) for t in TASK_TYPES])).scalar()
    header = header_kpis(reservations, rooms, tasks, bills).withColumn("_sla", per_type)
    values = {
        "occupancy": F.col("occupancy_pct"),
        "conversion": F.col("conversion_pct"),
        "sla_cleaning": F.col("_sla.cleaning"),
        "sla_maintenance": F.col("_sla.maintenance"),
        "revpar": F.col("revpar"),
        "billing_accuracy": F.col("billing_accuracy"),
    }

    def entry(code: str, label: str, formula: str) -> Column:
        value = values[code]
        passed = F.when(value > PASS_THRESHOLDS[code], "PASS").otherwise("LOW")
        target, delta, band = F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("string")
        if code in GAUGES:
            goal, low_edge, middle_edge = GAUGES[code]
            shown = F.round(value * 100, 2) if code == "billing_accuracy" else value
            target, delta = F.lit(float(goal)), F.round(shown - goal, 2)
            band = F.when(shown < low_edge, "low").when(shown < middle_edge, "middle").otherwise("high")
        return F.struct(
            F.lit(label).alias("kpi"),
            F.lit(formula).alias("formula"),
            value.cast("double").alias("value"),
            passed.alias("status"),
            target.alias("target"),
            delta.alias("delta"),
            band.alias("band"),
        )

    return header.select(F.inline(F.array(*[entry(*line) for line in SUMMARY])))
