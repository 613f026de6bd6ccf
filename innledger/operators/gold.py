"""Star schema: dimensions with all versions, facts with the keys of the current versions.

Every function takes frames whose surrogate key is already assigned and returns a new frame. The wide
facts carry the natural keys found through the dimensions next to the surrogate keys, so reports need
no second join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.functions.columns import holds, sla_breached
from innledger.operators.dq import union_all
from innledger.operators.silver import net_amount
from innledger.values import HOTEL_LAYOUT, HOTELS, MISMATCH_TOLERANCE

# Column names of the facts.
FACT_RESERVATION = (
    "reservation_sk",
    "reservation_id",
    "guest_sk",
    "room_sk",
    "hotel_sk",
    "check_in_date",
    "check_out_date",
    "length_of_stay",
    "booking_channel",
    "booking_time",
    "cancellation_time",
    "status",
    "is_double_booked",
    "is_suspicious_cancel",
)
FACT_HOUSEKEEPING = (
    "housekeeping_sk",
    "task_id",
    "room_sk",
    "hotel_sk",
    "task_type",
    "assigned_staff",
    "scheduled_time",
    "start_time",
    "end_time",
    "duration_minutes",
    "issue_detected_flag",
    "sla_breached",
    "status",
)
FACT_BILLING = (
    "billing_sk",
    "bill_id",
    "reservation_sk",
    "guest_sk",
    "total_amount",
    "taxes",
    "discounts",
    "net_amount",
    "payment_mode",
    "payment_time",
    "is_flagged",
    "billing_mismatch",
)


def dim_hotel(spark: SparkSession) -> DataFrame:
    rows = [(sk, *hotel) for sk, hotel in enumerate(HOTELS, start=1)]
    return spark.createDataFrame(rows, HOTEL_LAYOUT)


def dim_guest(guests: DataFrame) -> DataFrame:
    return guests.drop("_loaded_at", "_source_file", "action")


def dim_room(rooms: DataFrame, hotels: DataFrame) -> DataFrame:
    """Rooms with the key of their hotel; the hotel list has a handful of rows, so it is broadcast."""
    keys = F.broadcast(hotels.select("hotel_id", "hotel_sk"))
    columns = [c for c in rooms.columns if c not in ("room_sk", "room_id", "_loaded_at", "_source_file", "action")]
    return rooms.join(keys, "hotel_id", "left").select("room_sk", "room_id", "hotel_sk", *columns)


def _current_rooms(rooms: DataFrame) -> DataFrame:
    known_hotel = F.when(F.col("hotel_sk").isNotNull(), F.col("hotel_id"))
    return rooms.where("is_current").select(
        F.col("room_id").alias("_room"), "room_sk", "hotel_sk", known_hotel.alias("hotel_id"), "base_price"
    )


def _current_guests(guests: DataFrame) -> DataFrame:
    return guests.where("is_current").select(F.col("guest_id").alias("_guest"), "guest_sk")


def load_reservations(reservations: DataFrame, guests: DataFrame, rooms: DataFrame) -> DataFrame:
    """Wide reservation fact. Unknown guests and rooms keep the row and leave the keys empty.

    `agreed_amount` is what the stay should cost, kept here so that bills need not look up rooms.
    """
    looked_up = reservations.join(
        _current_guests(guests), F.col("guest_id") == F.col("_guest"), "left"
    ).join(_current_rooms(rooms), F.col("room_id") == F.col("_room"), "left")
    return looked_up.select(
        "reservation_sk",
        "reservation_id",
        "guest_sk",
        "room_sk",
        "hotel_sk",
        F.col("_guest").alias("guest_id"),
        F.col("_room").alias("room_id"),
        "hotel_id",
        "check_in_date",
        "check_out_date",
        "length_of_stay",
        "booking_channel",
        "booking_time",
        "cancellation_time",
        "status",
        F.lit(False).alias("is_double_booked"),
        F.lit(False).alias("is_suspicious_cancel"),
        (F.col("base_price") * F.col("length_of_stay")).cast("decimal(18,2)").alias("agreed_amount"),
    )


def load_housekeeping(tasks: DataFrame, rooms: DataFrame) -> DataFrame:
    looked_up = tasks.join(_current_rooms(rooms), F.col("room_id") == F.col("_room"), "left")
    return looked_up.select(
        "housekeeping_sk",
        "task_id",
        "room_sk",
        "hotel_sk",
        F.col("_room").alias("room_id"),
        "hotel_id",
        "task_type",
        "assigned_staff",
        "scheduled_time",
        "start_time",
        "end_time",
        "duration_minutes",
        "issue_detected_flag",
        sla_breached(F.col("task_type"), F.col("duration_minutes")).alias("sla_breached"),
        "status",
    )


def load_billing(
    bills: DataFrame, reservations: DataFrame, guests: DataFrame, tolerance: float = MISMATCH_TOLERANCE
) -> DataFrame:
    """Wide billing fact. The stay's price comes along with the reservation, in one join."""
    stays = reservations.select(F.col("reservation_id").alias("_stay"), "reservation_sk", "agreed_amount")
    looked_up = bills.join(stays, F.col("reservation_id") == F.col("_stay"), "left").join(
        _current_guests(guests), F.col("guest_id") == F.col("_guest"), "left"
    )
    mismatch = F.abs(F.col("total_amount") - F.col("agreed_amount")) > tolerance
    return looked_up.select(
        "billing_sk",
        "bill_id",
        "reservation_sk",
        "guest_sk",
        F.col("_stay").alias("reservation_id"),
        F.col("_guest").alias("guest_id"),
        "total_amount",
        "taxes",
        "discounts",
        net_amount().alias("net_amount"),
        "payment_mode",
        "payment_time",
        "is_flagged",
        "agreed_amount",
        holds(mismatch).alias("billing_mismatch"),
    )


def load_audit(
    guests: DataFrame, rooms: DataFrame, reservations: DataFrame, tasks: DataFrame, bills: DataFrame
) -> DataFrame:
    """Row counts and load measures of every gold table in long form, one pass per table."""

    def flags(df: DataFrame, table: str, names: dict[str, object]) -> DataFrame:
        total = F.struct(F.lit("total_rows").alias("measure"), F.count("*").cast("decimal(38,2)").alias("value"))
        entries = [total] + [
            F.struct(F.lit(n).alias("measure"), value.cast("decimal(38,2)").alias("value"))
            for n, value in names.items()
        ]
        counts = df.agg(F.array(*entries).alias("_m")).select(F.inline("_m"))
        return counts.select(F.lit(table).alias("table_name"), "measure", "value")

    versions = {"current_rows": F.count_if("is_current"), "historical_rows": F.count_if(~F.col("is_current"))}
    by_status = {s: F.count_if(F.col("status") == s) for s in ("confirmed", "cancelled", "completed")}
    return union_all(
        [
            flags(guests, "DIM_GUEST", versions),
            flags(rooms, "DIM_ROOM", versions),
            flags(reservations, "FACT_RESERVATION", by_status),
            flags(
                tasks,
                "FACT_HOUSEKEEPING",
                {"sla_breaches": F.count_if("sla_breached"), "issues_found": F.count_if("issue_detected_flag")},
            ),
            flags(
                bills,
                "FACT_BILLING",
                {
                    "flagged_bills": F.count_if("is_flagged"),
                    "mismatch_bills": F.count_if("billing_mismatch"),
                    "total_revenue": F.sum("total_amount"),
                },
            ),
        ]
    )
