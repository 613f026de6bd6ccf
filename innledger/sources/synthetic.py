"""Deterministic synthetic hotel rows derived from the keys of any table.

Every draw is a hash of seed, key and label, so rows come out the same on any number of machines and for
any partitioning, and the volume follows the key table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.functions.columns import sla_breached

# Categories with their weights, and ranges of the draws.
TIERS = (("Bronze", 0.35), ("Silver", 0.30), ("Gold", 0.25), ("Platinum", 0.10))
CHANNELS = (("Website", 0.30), ("Mobile App", 0.25), ("OTA", 0.25), ("Corporate", 0.15), ("Walk-in", 0.05))
STATUSES = (("confirmed", 0.35), ("cancelled", 0.15), ("completed", 0.50))
TASKS = (("cleaning", 0.70), ("maintenance", 0.30))
MODES = (("Credit Card", 0.40), ("UPI", 0.30), ("Cash", 0.10), ("Net Banking", 0.10), ("Debit Card", 0.10))
DISCOUNTS = ((0, 0.6), (20, 0.2), (50, 0.15), (100, 0.05))
ROOM_TYPES = (("Standard", 0.45), ("Deluxe", 0.40), ("Suite", 0.15))
ROOM_STATES = (("Available", 0.50), ("Occupied", 0.40), ("Maintenance", 0.10))
TASK_STATES = (("Completed", 0.80), ("Pending", 0.10), ("In Progress", 0.10))
CAPACITIES = (2, 2, 4)
PRICES = (80, 100, 120, 150, 200, 250, 300)
COUNTRIES = ("India", "USA", "UK", "Australia", "UAE")
CITIES = ("Mumbai", "Delhi", "Bangalore", "Hyderabad", "Chennai")
STAFF = 5
HOTEL_IDS = ("H001", "H002", "H003", "H004", "H005")
FIRST_DAY = "2024-01-01"
DAYS = 365
ROOMS_FROM, ROOMS = 300, 50
# task type -> mean, deviation, lowest and highest duration
DURATIONS = {"cleaning": (40, 15, 10, 90), "maintenance": (100, 40, 20, 200)}


def uniform(key: str, label: str, seed: int) -> Column:
    """Draw in [0, 1) from the first 32 bits of a digest; a missing key draws like an empty one."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{label}:"), F.coalesce(F.col(key), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def weighted(draw: Column, choices: Sequence[tuple[object, float]]) -> Column:
    """The choice whose slice of cumulative weight holds the draw."""
    picked, reached = None, 0.0
    for value, weight in choices[:-1]:
        reached = round(reached + weight, 6)
        test = draw < reached
        picked = F.when(test, F.lit(value)) if picked is None else picked.when(test, F.lit(value))
    return picked.otherwise(F.lit(choices[-1][0]))


def uniform_int(draw: Column, low: int, high: int) -> Column:
    """Integer in [low, high)."""
    return (F.floor(draw * (high - low)) + low).cast("int")


def any_one(draw: Column, choices: Sequence[object]) -> Column:
    """One of the choices, all equally likely."""
    return F.element_at(F.array(*map(F.lit, choices)), uniform_int(draw, 0, len(choices)) + 1)


def normal(first: Column, second: Column, mean: float, deviation: float) -> Column:
    """Normal draw from two uniform ones."""
    radius = F.sqrt(-2.0 * F.ln(1.0 - first))
    return mean + deviation * radius * F.cos(2.0 * math.pi * second)


def chance(draw: Column, probability: float) -> Column:
    return draw < probability


def synthetic_guests(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    def draw(label: str) -> Column:
        return uniform(key, label, seed)

    return keys.select(
        F.concat(F.lit("G"), F.col(key)).alias("guest_id"),
        weighted(draw("tier"), TIERS).alias("loyalty_tier"),
        any_one(draw("country"), COUNTRIES).alias("country"),
        any_one(draw("city"), CITIES).alias("city"),
    )


def synthetic_rooms(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    def draw(label: str) -> Column:
        return uniform(key, label, seed)

    return keys.select(
        F.col(key).alias("room_id"),
        any_one(draw("hotel"), HOTEL_IDS).alias("hotel_id"),
        weighted(draw("type"), ROOM_TYPES).alias("room_type"),
        any_one(draw("capacity"), CAPACITIES).alias("capacity"),
        any_one(draw("price"), PRICES).cast("decimal(18,2)").alias("base_price"),
        weighted(draw("state"), ROOM_STATES).alias("status"),
    )


def synthetic_reservations(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    def draw(label: str) -> Column:
        return uniform(key, label, seed)

    stays = keys.select(
        F.concat(F.lit("R"), F.col(key)).alias("reservation_id"),
        F.concat(F.lit("G"), F.col(key)).alias("guest_id"),
        uniform_int(draw("room"), ROOMS_FROM, ROOMS_FROM + ROOMS).cast("string").alias("room_id"),
        any_one(draw("hotel"), HOTEL_IDS).alias("hotel_id"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), uniform_int(draw("day"), 0, DAYS)).alias("check_in_date"),
        uniform_int(draw("stay"), 1, 10).alias("length_of_stay"),
        weighted(draw("channel"), CHANNELS).alias("booking_channel"),
        weighted(draw("status"), STATUSES).alias("status"),
        chance(draw("double"), 0.05).alias("is_double_booked"),
        chance(draw("cancel"), 0.04).alias("is_suspicious_cancel"),
    )
    return stays.withColumn("check_out_date", F.date_add("check_in_date", F.col("length_of_stay")))


def synthetic_housekeeping(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    def draw(label: str) -> Column:
        return uniform(key, label, seed)

    def duration(task: str) -> Column:
        mean, deviation, low, high = DURATIONS[task]
        minutes = normal(draw("d1"), draw("d2"), mean, deviation).cast("int")
        return F.greatest(F.lit(low), F.least(F.lit(high), minutes))

    tasks = keys.select(
        F.concat(F.lit("T"), F.col(key)).alias("task_id"),
        uniform_int(draw("room"), ROOMS_FROM, ROOMS_FROM + ROOMS).cast("string").alias("room_id"),
        any_one(draw("hotel"), HOTEL_IDS).alias("hotel_id"),
        weighted(draw("task"), TASKS).alias("task_type"),
        F.concat(F.lit("Staff "), uniform_int(draw("staff"), 1, STAFF + 1)).alias("assigned_staff"),
        weighted(draw("state"), TASK_STATES).alias("status"),
        duration("cleaning").alias("_cleaning"),
        duration("maintenance").alias("_maintenance"),
        chance(draw("issue"), 0.20).alias("issue_detected_flag"),
    )
    minutes = F.when(F.col("task_type") == "cleaning", F.col("_cleaning")).otherwise(F.col("_maintenance"))
    timed = tasks.withColumn("duration_minutes", minutes).drop("_cleaning", "_maintenance")
    return timed.withColumn("sla_breached", sla_breached(F.col("task_type"), F.col("duration_minutes")))


def synthetic_billing(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    def draw(label: str) -> Column:
        return uniform(key, label, seed)

    amount = F.round(200.0 + draw("amount") * 1300.0, 2).cast("decimal(18,2)")
    bills = keys.select(
        F.concat(F.lit("B"), F.col(key)).alias("bill_id"),
        F.concat(F.lit("R"), F.col(key)).alias("reservation_id"),
        F.concat(F.lit("G"), F.col(key)).alias("guest_id"),
        amount.alias("total_amount"),
        weighted(draw("discount"), DISCOUNTS).cast("decimal(18,2)").alias("discounts"),
        weighted(draw("mode"), MODES).alias("payment_mode"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), uniform_int(draw("paid"), 0, DAYS)).alias("payment_time"),
        chance(draw("flag"), 0.08).alias("is_flagged"),
        chance(draw("mismatch"), 0.05).alias("billing_mismatch"),
    )
    tax = F.round(F.col("total_amount") * F.lit("0.10").cast("decimal(3,2)"), 2).cast("decimal(18,2)")
    net = F.col("total_amount") - F.col("discounts") + F.col("taxes")
    return bills.withColumn("taxes", tax).withColumn("net_amount", net.cast("decimal(18,2)"))
