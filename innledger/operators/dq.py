"""Data-quality rules and the exception log.

A rule is data: which rows break it and how they are reported. All rules of one table run in one scan;
rules that need a second table are anti joins or joins on the referenced key. Table names, messages and
labels are fixed values that readers of the log rely on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from innledger.functions.columns import any_of, clock_text, holds
from innledger.operators import silver
from innledger.session import remove_folder
from innledger.values import (
    LOYALTY_TIERS,
    RESERVATION_STATUSES,
    ROOM_STATUSES,
    TASK_STATUSES,
    TASK_TYPES,
)

LOG_COLUMNS = ("source_table", "record_id", "error_type", "error_message", "raw_value")


@dataclass(frozen=True)
class Rule:
    name: str
    source_table: str
    id_column: str
    error_type: str
    message: str
    broken: Column
    raw_value: Column

    def entry(self) -> Column:
        return F.struct(
            F.lit(self.source_table).alias("source_table"),
            F.coalesce(F.col(self.id_column).cast("string"), F.lit("NULL")).alias("record_id"),
            F.lit(self.error_type).alias("error_type"),
            F.lit(self.message).alias("error_message"),
            self.raw_value.alias("raw_value"),
        )


def _text(*parts: str | Column) -> Column:
    """Labels and values side by side; a NULL value makes the whole text NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("NULL"))


def _unlisted(value: Column, accepted: Sequence[str]) -> Column:
    return ~value.isin(*accepted)


def guest_rules() -> list[Rule]:
    return [
        Rule(
            "dq_guest_missing",
            "RAW_GUESTS",
            "guest_id",
            "VALUE",
            "Missing required field — guest_id or email is NULL",
            F.col("guest_id").isNull() | F.col("email").isNull(),
            _text("guest_id=", _shown("guest_id"), " | email=", _shown("email")),
        )
    ]


def room_rules() -> list[Rule]:
    known = F.col("room_id").isNotNull()
    bad_status = _unlisted(F.trim("status"), ROOM_STATUSES) & known
    capacity, price, status = F.col("capacity"), F.col("base_price"), F.col("status")
    return [
        Rule(
            "dq_room_values",
            "RAW_ROOMS",
            "room_id",
            "VALUE",
            "Invalid room — capacity <= 0 or base_price < 0",
            ((capacity <= 0) | (price < 0)) & known,
            _text("capacity=", capacity, " | base_price=", price),
        ),
        Rule(
            "dq_room_status",
            "RAW_ROOMS",
            "room_id",
            "VALUE",
            "Invalid status — must be Available/Occupied/Maintenance",
            bad_status,
            _text("status=", status),
        ),
        Rule(
            "vc_capacity",
            "RAW_ROOMS",
            "room_id",
            "VALUE",
            "room_capacity must be > 0",
            (capacity <= 0) & known,
            _text("room_id=", F.col("room_id"), " | capacity=", capacity),
        ),
        Rule(
            "vc_room_status",
            "RAW_ROOMS",
            "room_id",
            "VALUE",
            "status must be Available/Occupied/Maintenance",
            bad_status,
            _text("room_id=", F.col("room_id"), " | status=", status),
        ),
    ]


def reservation_rules() -> list[Rule]:
    known = F.col("reservation_id").isNotNull()
    check_in, check_out = F.col("check_in_date"), F.col("check_out_date")
    cancelled, status = F.col("cancellation_time"), F.col("status")
    bad_status = _unlisted(F.lower(F.trim(status)), RESERVATION_STATUSES) & known
    return [
        Rule(
            "dq_res_dates",
            "RAW_RESERVATIONS",
            "reservation_id",
            "TEMPORAL",
            "check_out_date is before check_in_date",
            (check_out < check_in) & known,
            _text("check_in=", check_in, " | check_out=", check_out),
        ),
        Rule(
            "dq_res_cancel_late",
            "RAW_RESERVATIONS",
            "reservation_id",
            "TEMPORAL",
            "cancellation_time is after check_in_date",
            (cancelled.cast("date") > check_in) & known,
            _text("cancellation=", clock_text(cancelled), " | check_in=", check_in),
        ),
        Rule(
            "dq_res_status",
            "RAW_RESERVATIONS",
            "reservation_id",
            "VALUE",
            "Invalid status — must be Confirmed/Cancelled/Completed",
            bad_status,
            _text("status=", status),
        ),
        Rule(
            "vc_res_status",
            "RAW_RESERVATIONS",
            "reservation_id",
            "VALUE",
            "status must be Confirmed/Cancelled/Completed",
            bad_status,
            _text("reservation_id=", F.col("reservation_id"), " | status=", status),
        ),
    ]


def housekeeping_rules() -> list[Rule]:
    known = F.col("task_id").isNotNull()
    start, end = F.col("start_time"), F.col("end_time")
    return [
        Rule(
            "dq_hk_times",
            "RAW_HOUSEKEEPING",
            "task_id",
            "TEMPORAL",
            "end_time is before start_time",
            (end < start) & known,
            _text("start=", clock_text(start), " | end=", clock_text(end)),
        ),
        Rule(
            "dq_hk_task_type",
            "RAW_HOUSEKEEPING",
            "task_id",
            "VALUE",
            "Invalid task_type — must be cleaning or maintenance",
            _unlisted(F.lower(F.trim("task_type")), TASK_TYPES) & known,
            _text("task_type=", F.col("task_type")),
        ),
        Rule(
            "vc_hk_status",
            "RAW_HOUSEKEEPING",
            "task_id",
            "VALUE",
            "status must be Completed/Pending/In Progress/Pending Review",
            _unlisted(F.lower(F.trim("status")), TASK_STATUSES) & known,
            _text("task_id=", F.col("task_id"), " | status=", F.col("status")),
        ),
    ]


def billing_rules() -> list[Rule]:
    known = F.col("bill_id").isNotNull()

    def negative(column: str) -> Column:
        return F.col(column) < 0

    def one_amount(column: str) -> Rule:
        return Rule(
            f"vc_{column}",
            "RAW_BILLING",
            "bill_id",
            "VALUE",
            f"{column} must be >= 0",
            negative(column) & known,
            _text("bill_id=", F.col("bill_id"), f" | {column}=", F.col(column)),
        )

    return [
        Rule(
            "dq_billing_negative",
            "RAW_BILLING",
            "bill_id",
            "VALUE",
            "Negative amount — total/taxes/discounts must be >= 0",
            (negative("total_amount") | negative("taxes") | negative("discounts")) & known,
            _text(
                "total=", F.col("total_amount"), " | taxes=", F.col("taxes"), " | discounts=", F.col("discounts")
            ),
        ),
        one_amount("total_amount"),
        one_amount("taxes"),
        one_amount("discounts"),
    ]


ROW_RULES = {
    "raw_guests": guest_rules,
    "raw_rooms": room_rules,
    "raw_reservations": reservation_rules,
    "raw_housekeeping": housekeeping_rules,
    "raw_billing": billing_rules,
}
VALIDITY = {
    "raw_guests": ("guest_id", silver.valid_guest),
    "raw_rooms": ("room_id", silver.valid_room),
    "raw_reservations": ("reservation_id", silver.valid_reservation),
    "raw_housekeeping": ("task_id", silver.valid_task),
    "raw_billing": ("bill_id", silver.valid_bill),
}


def is_value_check(rule: Rule) -> bool:
    """The second round of value checks, which replaces the value entries of the first round."""
    return rule.name.startswith("vc_")


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Log entries of all rules from a single scan, one entry per broken rule."""
    broken = df.where(any_of(r.broken for r in rules))
    if len(rules) == 1:
        return broken.select(F.inline(F.array(rules[0].entry())))
    hits = F.array_compact(F.array(*[F.when(r.broken, r.entry()) for r in rules]))
    return broken.select(F.inline(hits))


def run_orphans(
    child: DataFrame, parent: DataFrame, id_column: str, key: str, source_table: str, parent_table: str
) -> DataFrame:
    """Log entries of rows whose reference has no counterpart."""
    orphans = child.where(F.col(id_column).isNotNull() & F.col(key).isNotNull()).join(
        parent.select(key), key, "left_anti"
    )
    rule = Rule(
        "orphan",
        source_table,
        id_column,
        "REFERENTIAL",
        f"{key} not found in {parent_table}",
        F.lit(True),
        _text(f"{key}=", F.col(key)),
    )
    return orphans.select(F.inline(F.array(rule.entry())))


def billing_relation_rules() -> list[Rule]:
    """Rules over bills with the booking they refer to; both come from one join."""
    known = F.col("bill_id").isNotNull()
    paid, booked = F.col("payment_time"), F.col("_booking_time")
    return [
        Rule(
            "dq_billing_orphan_res",
            "RAW_BILLING",
            "bill_id",
            "REFERENTIAL",
            "reservation_id not found in VAL_RESERVATIONS",
            known & F.col("reservation_id").isNotNull() & F.col("_booking_id").isNull(),
            _text("reservation_id=", F.col("reservation_id")),
        ),
        Rule(
            "dq_billing_payment_before_booking",
            "RAW_BILLING",
            "bill_id",
            "TEMPORAL",
            "payment_time is before booking_time",
            known & F.col("_booking_id").isNotNull() & (paid < booked),
            _text("payment=", clock_text(paid), " | booking=", clock_text(booked)),
        ),
    ]


def bills_with_bookings(bills: DataFrame, reservations: DataFrame) -> DataFrame:
    booked = reservations.select(
        F.col("reservation_id").alias("_booking_id"), F.col("booking_time").alias("_booking_time")
    )
    paid = bills.select("bill_id", "reservation_id", "payment_time")
    return paid.join(booked, F.col("reservation_id") == F.col("_booking_id"), "left")


def relation_checks(
    raw: dict[str, DataFrame], guests: DataFrame, rooms: DataFrame, reservations: DataFrame
) -> list[DataFrame]:
    """Log entries of all rules that compare two tables; dimensions count with their current rows."""
    guests, rooms = guests.where("is_current"), rooms.where("is_current")
    res, hk = raw["raw_reservations"], raw["raw_housekeeping"]
    bills = bills_with_bookings(raw["raw_billing"], reservations)
    return [
        run_orphans(res, guests, "reservation_id", "guest_id", "RAW_RESERVATIONS", "VAL_GUESTS"),
        run_orphans(res, rooms, "reservation_id", "room_id", "RAW_RESERVATIONS", "VAL_ROOMS"),
        run_orphans(hk, rooms, "task_id", "room_id", "RAW_HOUSEKEEPING", "VAL_ROOMS"),
        run_rules(bills, billing_relation_rules()),
    ]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    total, *more = frames
    for frame in more:
        total = total.unionByName(frame)
    return total


def first_log(
    raw: dict[str, DataFrame], guests: DataFrame, rooms: DataFrame, reservations: DataFrame
) -> DataFrame:
    """The log after the first round: row rules and rules over two tables."""
    per_table = [
        run_rules(raw[table], [r for r in rules() if not is_value_check(r)]) for table, rules in ROW_RULES.items()
    ]
    return union_all([*per_table, *relation_checks(raw, guests, rooms, reservations)])


def value_checks(raw: dict[str, DataFrame]) -> DataFrame:
    """The second round: one value check per column."""
    checks = {t: [r for r in rules() if is_value_check(r)] for t, rules in ROW_RULES.items()}
    return union_all([run_rules(raw[t], rules) for t, rules in checks.items() if rules])


def rebuild_log(log: DataFrame, checks: DataFrame) -> DataFrame:
    """Drops the value entries of the first round and adds those of the second."""
    return log.where("error_type <> 'VALUE'").unionByName(checks)


def write_log(log: DataFrame, table: str) -> None:
    """The log as a table partitioned by type, of which `replace_value_entries` can change a part."""
    writer = log.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("error_type").parquet(table)


def replace_value_entries(checks: DataFrame, table: str) -> None:
    """`rebuild_log` in place: the checks replace the VALUE partition of a table of `write_log`, other files stay.

    Without any check the partition goes, which an overwrite by partitions would leave as it was. A rebuild that is cut
    short may be repeated.
    """
    spark, seen = checks.sparkSession, Observation()
    values = checks.where("error_type = 'VALUE'").observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = values.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("error_type").parquet(table)
    if not seen.get.get("rows"):
        remove_folder(spark, f"{table}/error_type=VALUE")


def log_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("source_table", "error_type", "error_message").agg(F.count("*").alias("violations"))


def log_by_table(log: DataFrame) -> DataFrame:
    return log.groupBy("source_table").agg(F.count("*").alias("total_violations"))


def unexplained_drops(raw: dict[str, DataFrame]) -> DataFrame:
    """Raw rows that the validated tables leave out although no row rule reports them."""
    parts = []
    for table, (key, valid) in VALIDITY.items():
        reported = holds(any_of(r.broken for r in ROW_RULES[table]()))
        dropped = raw[table].where(~holds(valid()) & ~reported)
        parts.append(dropped.select(F.lit(table).alias("source_table"), F.col(key).alias("record_id")))
    return union_all(parts)


def guest_tier_profile(raw_guests: DataFrame) -> DataFrame:
    """Guests per tier, with a mark on tiers outside the accepted list."""
    invalid = ~holds(F.col("loyalty_tier").isin(*LOYALTY_TIERS))
    return (
        raw_guests.groupBy("loyalty_tier")
        .agg(F.count("*").alias("guest_count"))
        .select("loyalty_tier", "guest_count", invalid.alias("is_invalid"))
    )


def broken_references(child: DataFrame, parent: DataFrame, key: str, label: str) -> DataFrame:
    """Number of rows without counterpart, as one labelled row.

    Rows are counted per key before they meet the parent, so a key shared by very many rows travels
    as one row per task, and the join reuses the partitioning of the count.
    """
    per_key = child.groupBy(key).agg(F.count("*").alias("_rows"))
    broken = per_key.join(parent.select(key), key, "left_anti")
    total = F.coalesce(F.sum("_rows"), F.lit(0)).alias("broken_refs")
    return broken.agg(total).select(F.lit(label).alias("ri_check"), "broken_refs")


def integrity_checks(
    guests: DataFrame, rooms: DataFrame, reservations: DataFrame, housekeeping: DataFrame, bills: DataFrame
) -> DataFrame:
    guests, rooms = guests.where("is_current"), rooms.where("is_current")
    return union_all(
        [
            broken_references(reservations, guests, "guest_id", "reservations.guest_id → guests"),
            broken_references(reservations, rooms, "room_id", "reservations.room_id → rooms"),
            broken_references(housekeeping, rooms, "room_id", "housekeeping.room_id → rooms"),
            broken_references(
                bills, reservations, "reservation_id", "billing.reservation_id → reservations"
            ),
        ]
    )


def temporal_checks(reservations: DataFrame, housekeeping: DataFrame, bills: DataFrame) -> DataFrame:
    """Counts of impossible time orders, one pass per table."""
    late_cancel = F.col("cancellation_time").cast("date") > F.col("check_in_date")
    per_reservation = labelled_counts(
        reservations,
        {
            "RES: check_out < check_in": F.col("check_out_date") < F.col("check_in_date"),
            "RES: cancellation > check_in": late_cancel,
        },
        "temporal_check",
        "violations",
    )
    per_task = labelled_counts(
        housekeeping,
        {"HK: end_time < start_time": F.col("end_time") < F.col("start_time")},
        "temporal_check",
        "violations",
    )
    booked = reservations.select("reservation_id", "booking_time")
    per_bill = labelled_counts(
        bills.select("reservation_id", "payment_time").join(booked, "reservation_id"),
        {"BILLING: payment < booking_time": F.col("payment_time") < F.col("booking_time")},
        "temporal_check",
        "violations",
    )
    return union_all([per_reservation, per_task, per_bill])


def labelled_counts(df: DataFrame, conditions: dict[str, Column], label: str, count: str) -> DataFrame:
    """One row per condition with the number of rows that meet it, all from one scan."""
    entries = [
        F.struct(F.lit(name).alias(label), F.count_if(holds(cond)).alias(count))
        for name, cond in conditions.items()
    ]
    return df.agg(F.array(*entries).alias("_counts")).select(F.inline("_counts"))


def scd2_audit(versions: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(
            F.max("scd_version").alias("max_version"),
            F.count_if("is_current").alias("current_records"),
            F.count_if(~F.col("is_current")).alias("historical_records"),
            F.count("*").alias("total_records"),
        ).select(F.lit(name).alias("scd2_table"), "*")
        for name, df in versions.items()
    ]
    return union_all(parts)


def silver_row_counts(
    guests: DataFrame,
    rooms: DataFrame,
    reservations: DataFrame,
    housekeeping: DataFrame,
    bills: DataFrame,
    log: DataFrame,
) -> DataFrame:
    everything, current = F.lit(True), F.col("is_current")

    def versioned(name: str) -> dict[str, Column]:
        return {
            f"{name} (all versions)": everything,
            f"{name} (current)": current,
            f"{name} (SCD2 history)": ~current,
        }

    tables = [
        (guests, versioned("VAL_GUESTS")),
        (rooms, versioned("VAL_ROOMS")),
        (reservations, {"VAL_RESERVATIONS": everything}),
        (housekeeping, {"VAL_HOUSEKEEPING": everything}),
        (bills, {"VAL_BILLING": everything}),
        (log, {"DQ_EXCEPTION_LOG": everything}),
    ]
    return union_all([labelled_counts(df, names, "table_name", "total_rows") for df, names in tables])


def key_uniqueness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: rows, distinct keys that repeat, and rows beyond the first of their key."""
    parts = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count("*").alias("_rows"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
                F.count_if(F.col("_rows") > 1).alias("repeated_keys"),
                F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("surplus_rows"),
            ).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "*")
        )
    return union_all(parts)
