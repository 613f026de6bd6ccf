"""The five business indicators over the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innledger.functions.columns import mean, pct, safe_ratio, sla_limit


def current_rooms(rooms: DataFrame) -> Column:
    """Number of current rooms as a scalar subquery, evaluated once per query."""
    return rooms.where("is_current").agg(F.count("*").alias("total_rooms")).scalar()


def not_cancelled() -> Column:
    return F.col("status") != "cancelled"


def kpi1_occupancy(reservations: DataFrame, rooms: DataFrame) -> DataFrame:
    """Rooms with an arrival per day, as a share of all rooms."""
    days = (
        reservations.where(not_cancelled())
        .groupBy(F.col("check_in_date").alias("date"))
        .agg(F.count_distinct("room_sk").alias("occupied_rooms"))
    )
    return _occupancy(days, rooms)


def kpi1_occupancy_nightly(reservations: DataFrame, rooms: DataFrame) -> DataFrame:
    """Rooms in use per night, as a share of all rooms; every night of a stay counts.

    A sweep over the boundaries of stays: a stay adds a room on the first night no earlier stay of the room covers, and
    takes it away after the last. So a stay costs two boundaries however long it is. Stays are folded to one per room
    and arrival day first, which bounds a room's window by the calendar; so is the running sum over the calendar.
    """
    stays = (
        reservations.where(not_cancelled() & (F.col("check_out_date") > F.col("check_in_date")))
        .where(F.col("room_sk").isNotNull())
        .groupBy("room_sk", "check_in_date")
        .agg(F.max("check_out_date").alias("check_out_date"))
    )
    earlier = Window.partitionBy("room_sk").orderBy("check_in_date").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.max("check_out_date").over(earlier)
    free = stays.select("room_sk", F.greatest("check_in_date", covered).alias("opens"), F.col("check_out_date").alias("closes"))
    boundaries = (
        free.where("closes > opens")
        .unpivot("room_sk", ["opens", "closes"], "boundary", "date")
        .groupBy("date")
        .agg(F.sum(F.when(F.col("boundary") == "opens", 1).otherwise(-1)).alias("change"))
    )
    first, last = boundaries.agg(F.min("date")).scalar(), boundaries.agg(F.max("date")).scalar()
    days = calendar(reservations.sparkSession).where((F.col("date") >= first) & (F.col("date") < last))
    in_use = F.sum(F.coalesce("change", F.lit(0))).over(Window.orderBy("date"))
    nights = days.join(boundaries, "date", "left").select("date", in_use.alias("occupied_rooms"))
    return _occupancy(nights.where("occupied_rooms > 0"), rooms)


def calendar(spark: SparkSession) -> DataFrame:
    """Every day a date can be, some 3.7 million."""
    first = dt.date(1, 1, 1)
    day = F.date_add(F.lit("0001-01-01").cast("date"), F.col("id").cast("int"))
    return spark.range((dt.date(9999, 12, 31) - first).days + 1).select(day.alias("date"))


def _occupancy(days: DataFrame, rooms: DataFrame) -> DataFrame:
    return (
        days.withColumn("total_rooms", current_rooms(rooms))
        .withColumn("occupancy_rate_pct", pct(F.col("occupied_rooms"), F.col("total_rooms"), 2))
        .orderBy("date")
    )


# Fixed value: label of the read-out.
FIRST_DAYS_LABEL = "KPI 1 — Occupancy Rate"


def kpi1_first_days(reservations: DataFrame, rooms: DataFrame, days: int = 5) -> DataFrame:
    """The labelled read-out of the first days."""
    occupancy = kpi1_occupancy(reservations, rooms)
    return occupancy.orderBy("date").limit(days).select(F.lit(FIRST_DAYS_LABEL).alias("kpi"), "*")


def kpi2_conversion(reservations: DataFrame) -> DataFrame:
    counts = reservations.agg(
        F.count("*").alias("total_reservations"),
        F.count_if(F.col("status") == "completed").alias("completed_stays"),
        F.count_if(F.col("status") == "cancelled").alias("cancellations"),
    )
    return counts.withColumn("conversion_pct", pct(F.col("completed_stays"), F.col("total_reservations"), 2))


def kpi3_sla(tasks: DataFrame) -> DataFrame:
    counts = (
        tasks.where(F.col("duration_minutes").isNotNull())
        .groupBy("task_type")
        .agg(
            F.count("*").alias("total_tasks"),
            F.count_if(~F.col("sla_breached")).alias("on_time_tasks"),
            F.count_if("sla_breached").alias("breached_tasks"),
            mean("duration_minutes", 1).alias("avg_duration_min"),
        )
    )
    return counts.select(
        "*",
        pct(F.col("on_time_tasks"), F.col("total_tasks"), 2).alias("sla_compliance_pct"),
        sla_limit(F.col("task_type")).alias("sla_threshold_min"),
    )


def kpi4_revpar(bills: DataFrame, reservations: DataFrame, rooms: DataFrame) -> DataFrame:
    """Revenue of stays that took place per room.

    Bills are summed per reservation first; the join then moves one row per reservation and task.
    """
    billed = bills.groupBy("reservation_sk").agg(F.sum("total_amount").alias("_amount"))
    kept = reservations.where(not_cancelled()).select("reservation_sk")
    revenue = billed.join(kept, "reservation_sk").agg(
        F.sum("_amount").cast("decimal(38,2)").alias("total_revenue")
    )
    return revenue.withColumn("total_rooms", current_rooms(rooms)).withColumn(
        "revpar", F.round(safe_ratio(F.col("total_revenue"), F.col("total_rooms")), 2)
    )


def kpi5_billing_accuracy(bills: DataFrame) -> DataFrame:
    anomaly = F.col("is_flagged") | F.col("billing_mismatch")
    counts = bills.agg(
        F.count("*").alias("total_bills"),
        F.count_if("is_flagged").alias("flagged_bills"),
        F.count_if("billing_mismatch").alias("mismatch_bills"),
        F.count_if(anomaly).alias("total_anomalies"),
    )
    accuracy = 1.0 - safe_ratio(F.col("total_anomalies"), F.col("total_bills"))
    return counts.withColumn("billing_accuracy_index", F.round(accuracy, 4))
