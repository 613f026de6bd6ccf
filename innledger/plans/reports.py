"""Reports over the validated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.functions.columns import holds, mean, pct, safe_ratio, sla_limit


def share_of_total(df: DataFrame, column: str, count: str) -> DataFrame:
    """Rows per value with the share of all rows; the total is a scalar subquery over the groups."""
    groups = df.groupBy(column).agg(F.count("*").alias(count))
    total = groups.agg(F.sum(count)).scalar()
    return groups.withColumn("pct", pct(F.col(count), total, 1)).orderBy(F.desc(count), column)


def guest_tier_distribution(guests: DataFrame) -> DataFrame:
    return share_of_total(guests.where("is_current"), "loyalty_tier", "guest_count")


def guests_by_country(guests: DataFrame) -> DataFrame:
    counts = guests.where("is_current").groupBy("country").agg(F.count("*").alias("guest_count"))
    return counts.orderBy(F.desc("guest_count"), "country")


def current_guests(guests: DataFrame) -> DataFrame:
    return guests.where("is_current").drop("action").orderBy("guest_id")


def current_rooms(rooms: DataFrame) -> DataFrame:
    return rooms.where("is_current").drop("action").orderBy("room_id")


def guest_versions(guests: DataFrame) -> DataFrame:
    columns = ["guest_id", "name", "loyalty_tier", "scd_start_date", "scd_end_date", "is_current", "scd_version"]
    return guests.select(*columns, "_source_file").orderBy("guest_id", "scd_version")


def room_status_stats(rooms: DataFrame) -> DataFrame:
    return (
        rooms.where("is_current")
        .groupBy("status")
        .agg(
            F.count("*").alias("room_count"),
            mean("base_price", 2).alias("avg_price"),
            F.min("base_price").alias("min_price"),
            F.max("base_price").alias("max_price"),
        )
        .orderBy(F.desc("room_count"), "status")
    )


def rooms_by_hotel(rooms: DataFrame) -> DataFrame:
    def with_status(status: str) -> Column:
        return F.count_if(F.col("status") == status).alias(status.lower())

    return (
        rooms.where("is_current")
        .groupBy("hotel_id")
        .agg(
            F.count("*").alias("total_rooms"),
            with_status("Available"),
            with_status("Occupied"),
            with_status("Maintenance"),
            mean("base_price", 2).alias("avg_price"),
        )
        .orderBy("hotel_id")
    )


def reservation_status_stats(reservations: DataFrame) -> DataFrame:
    return (
        reservations.groupBy("status")
        .agg(
            F.count("*").alias("total"),
            mean("length_of_stay", 1).alias("avg_stay_days"),
            F.min("check_in_date").alias("earliest_checkin"),
            F.max("check_out_date").alias("latest_checkout"),
        )
        .orderBy(F.desc("total"), "status")
    )


def bookings_by_channel(reservations: DataFrame) -> DataFrame:
    return share_of_total(reservations, "booking_channel", "bookings")


def cancelled_detail(reservations: DataFrame) -> DataFrame:
    ahead = F.datediff("check_in_date", F.col("cancellation_time").cast("date"))
    return (
        reservations.where(F.lower("status") == "cancelled")
        .select(
            "reservation_id",
            "guest_id",
            "room_id",
            "check_in_date",
            "cancellation_time",
            ahead.alias("days_before_checkin"),
        )
        .orderBy("reservation_id")
    )


def sla_by_task_type(tasks: DataFrame) -> DataFrame:
    limit = sla_limit(F.col("task_type"))
    counts = (
        tasks.where(F.col("duration_minutes").isNotNull())
        .groupBy("task_type")
        .agg(
            F.count("*").alias("total_tasks"),
            mean("duration_minutes", 1).alias("avg_duration_min"),
            F.min("duration_minutes").alias("min_duration"),
            F.max("duration_minutes").alias("max_duration"),
            F.count_if(holds(F.col("duration_minutes") > limit)).alias("sla_breaches"),
            F.count_if(holds(F.col("duration_minutes") <= limit)).alias("_met"),
        )
    )
    return counts.withColumn("sla_compliance_pct", pct(F.col("_met"), F.col("total_tasks"), 1)).drop("_met")


def issues_by_room(tasks: DataFrame) -> DataFrame:
    return (
        tasks.groupBy("room_id")
        .agg(
            F.count("*").alias("total_tasks"),
            F.count_if("issue_detected_flag").alias("issues_found"),
            mean("duration_minutes", 1).alias("avg_duration_min"),
        )
        .orderBy(F.desc("issues_found"), "room_id")
    )


def staff_performance(tasks: DataFrame) -> DataFrame:
    return (
        tasks.groupBy("assigned_staff")
        .agg(
            F.count("*").alias("tasks_done"),
            mean("duration_minutes", 1).alias("avg_duration_min"),
            F.count_if("issue_detected_flag").alias("issues_reported"),
        )
        .orderBy(F.desc("tasks_done"), "assigned_staff")
    )


def housekeeping_listing(tasks: DataFrame) -> DataFrame:
    return tasks.select(
        "task_id",
        "room_id",
        "task_type",
        "assigned_staff",
        "scheduled_time",
        "start_time",
        "end_time",
        "duration_minutes",
        "issue_detected_flag",
        "status",
        "_loaded_at",
        "_source_file",
    ).orderBy("task_id")


def money(column: str) -> Column:
    return F.sum(column).cast("decimal(38,2)")


def revenue_by_payment_mode(bills: DataFrame) -> DataFrame:
    return (
        bills.groupBy("payment_mode")
        .agg(
            F.count("*").alias("transactions"),
            money("total_amount").alias("total_revenue"),
            mean("total_amount", 2).alias("avg_bill"),
            money("taxes").alias("total_taxes"),
            money("discounts").alias("total_discounts"),
        )
        .orderBy(F.desc("total_revenue"), "payment_mode")
    )


def flagged_bills(bills: DataFrame) -> DataFrame:
    columns = ["bill_id", "reservation_id", "guest_id", "total_amount", "payment_mode", "payment_time", "is_flagged"]
    return bills.where("is_flagged").select(*columns).orderBy("bill_id")


def billing_stats(bills: DataFrame) -> DataFrame:
    """Totals over all bills; accuracy here counts flagged bills only."""
    totals = bills.agg(
        F.count("*").alias("total_bills"),
        money("total_amount").alias("total_revenue"),
        mean("total_amount", 2).alias("avg_bill_amount"),
        money("taxes").alias("total_taxes"),
        money("discounts").alias("total_discounts"),
        F.count_if("is_flagged").alias("flagged_count"),
    )
    flagged, bill_count = F.col("flagged_count"), F.col("total_bills")
    return totals.select(
        "*",
        pct(flagged, bill_count, 2).alias("fraud_pct"),
        F.round(1.0 - safe_ratio(flagged, bill_count), 4).alias("billing_accuracy_index"),
    )
