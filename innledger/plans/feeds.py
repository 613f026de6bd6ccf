"""Queries over files: raw tables written out as extracts, then read back through the ingest path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.operators import scd, silver
from innledger.plans.warehouse import Warehouse
from innledger.session import new_folder
from innledger.sources.bronze import bronze_rows
from innledger.sources.csv_ingest import (
    append_raw,
    cast_lenient,
    increment_rows,
    parse_layout,
    read_csv_raw,
    store_strict,
)
from innledger.streaming.arrivals import load_arrivals, loads
from innledger.streaming.incremental import merge_increments, merge_increments_in_place
from innledger.values import RAW_LAYOUTS, STAGE_NULL_TOKENS


def _extract(
    w: Warehouse, entity: str, faults: dict[str, Column], rows: Column | None = None, path: str | None = None
) -> str:
    """Writes a raw table, or some rows of it, as CSV in file column order, with some columns replaced by faulty text."""
    path = path or new_folder(w.spark, f"extract-{entity}")
    names = parse_layout(RAW_LAYOUTS[entity]).names
    raw = w.raw(f"raw_{entity}")
    raw = raw if rows is None else raw.where(rows)
    columns = [faults.get(n, F.col(n)).cast("string").alias(n) for n in names]
    writer = raw.select(*columns).write.option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _every(column: str, divisor: int, remainder: int = 0) -> Column:
    return F.col(column).cast("bigint") % divisor == remainder


def ingest_csv_nulls(w: Warehouse) -> DataFrame:
    """Guests whose e-mail, phone and city use every spelling of a missing value."""
    faults = {
        "email": F.when(_every("guest_id", 5, 1), "NULL").when(_every("guest_id", 5, 2), "").otherwise(F.col("email")),
        "phone": F.when(_every("guest_id", 7, 1), "N/A").when(_every("guest_id", 7, 2), "null").otherwise(F.col("phone")),
        "city": F.when(_every("guest_id", 11, 1), " none ")
        .when(_every("guest_id", 11, 2), "None")
        .when(_every("guest_id", 11, 3), "NA")
        .otherwise(F.concat(F.lit("  "), F.col("city"))),
    }
    path = _extract(w, "guests", faults)
    layout = RAW_LAYOUTS["guests"]
    raw = read_csv_raw(w.spark, path, layout, w.clock.loaded, STAGE_NULL_TOKENS, trim=True)
    return cast_lenient(raw, layout).drop("_file_name")


def ingest_try_cast(w: Warehouse) -> DataFrame:
    """Reservations with dates in several layouts and some that are no dates at all."""
    check_in, booked = F.col("check_in_date"), F.col("booking_time")
    faults = {
        "check_in_date": F.when(_every("reservation_id", 17), "soon")
        .when(_every("reservation_id", 3, 1), F.date_format(check_in, "dd-MMM-yyyy"))
        .when(_every("reservation_id", 3, 2), F.date_format(check_in, "MM/dd/yyyy"))
        .otherwise(check_in.cast("string")),
        "booking_time": F.when(_every("reservation_id", 19), "2024-13-45 99:00")
        .when(_every("reservation_id", 2), F.date_format(booked, "MM/dd/yyyy HH:mm:ss"))
        .otherwise(booked.cast("string")),
    }
    path = _extract(w, "reservations", faults)
    layout = RAW_LAYOUTS["reservations"]
    return cast_lenient(read_csv_raw(w.spark, path, layout, w.clock.loaded), layout).drop("_file_name")


def _strict_tasks(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    faults = {
        "start_time": F.when(_every("task_id", 31), "later").otherwise(F.col("start_time").cast("string")),
        "issue_detected_flag": F.when(_every("task_id", 37), "maybe").otherwise(F.col("issue_detected_flag")),
    }
    path = _extract(w, "housekeeping", faults)
    layout = RAW_LAYOUTS["housekeeping"]
    raw = read_csv_raw(w.spark, path, layout, w.clock.loaded)
    return store_strict(raw, layout, new_folder(w.spark, "tasks-by-outcome"))


def ingest_reject_rows(w: Warehouse) -> DataFrame:
    """Tasks that survive the strict cast."""
    return _strict_tasks(w)[0].drop("_file_name")


def ingest_reject_log(w: Warehouse) -> DataFrame:
    """Tasks set aside by the strict cast, with the columns at fault."""
    return _strict_tasks(w)[1].select("task_id", "start_time", "issue_detected_flag", "rejected_columns")


def bronze_append_reload(w: Warehouse) -> DataFrame:
    """Reservations loaded twice, then validated: the copies leave no trace."""
    path = new_folder(w.spark, "raw-reservations")
    for _ in range(2):
        append_raw(w.raw("raw_reservations"), path)
    return silver.silver_reservations(w.spark.read.parquet(path), w.clock.loaded)


def increment_guests(w: Warehouse) -> DataFrame:
    """Guest rows that came with increment files, out of all raw guest rows."""
    everything = w.raw("raw_guests").unionByName(w.raw("raw_guests_inc"))
    return increment_rows(everything)


def stream_merge_rooms(w: Warehouse) -> DataFrame:
    """The room merge again, with the increment arriving as files of a stream."""
    folder = new_folder(w.spark, "room-stream")
    increment = w.raw("raw_rooms_inc")
    increment.write.parquet(f"{folder}/incoming")
    w.table("silver_rooms")
    return merge_increments(
        w.spark,
        incoming=f"{folder}/incoming",
        schema=increment.schema,
        initial=w.path("silver_rooms"),
        snapshots=f"{folder}/snapshots",
        checkpoint=f"{folder}/checkpoint",
        merge=lambda old, new: scd.merge_rooms(old, new, w.clock.merged),
    )


#: Partitions of the versions that the sample's partition-wise merges work on.
BUCKETS = 8


def merge_rooms_in_place(w: Warehouse) -> DataFrame:
    """The room merge again, into a table of which only the partitions of arriving keys are rewritten."""
    folder = new_folder(w.spark, "room-buckets")
    scd.write_versions(w.table("silver_rooms"), f"{folder}/versions", "room_id", BUCKETS)
    increment = w.raw("raw_rooms_inc")
    increment.write.parquet(f"{folder}/incoming")
    merged = merge_increments_in_place(
        w.spark,
        incoming=f"{folder}/incoming",
        schema=increment.schema,
        table=f"{folder}/versions",
        key="room_id",
        buckets=BUCKETS,
        checkpoint=f"{folder}/checkpoint",
        merge=lambda old, new: scd.merge_rooms(old, new, w.clock.merged),
    )
    return merged.drop(scd.BUCKET)


def merge_guests_in_place(w: Warehouse) -> DataFrame:
    """What the guest merge did to each row, from the partitions that it rewrote."""
    folder = new_folder(w.spark, "guest-buckets")
    scd.write_versions(w.table("silver_guests"), f"{folder}/versions", "guest_id", BUCKETS)
    return scd.merge_buckets(
        f"{folder}/versions",
        w.raw("raw_guests_inc"),
        "guest_id",
        BUCKETS,
        lambda old, new: scd.merge_guests(old, new, w.clock.merged),
        f"{folder}/staging",
    )


def _arrived_reservations(w: Warehouse) -> str:
    """Raw reservations that came in as CSV files in three runs: some, the others, and all once more by force."""
    folder = new_folder(w.spark, "reservation-arrivals")
    for step in range(2):
        part = _every("reservation_id", 2, step)
        _extract(w, "reservations", {}, part, f"{folder}/incoming/part{step}")
        for _ in range(2):  # the second run finds nothing new
            _load_reservations(w, folder)
    for _ in range(2):
        _load_reservations(w, folder, "again")
    return f"{folder}/bronze"


def _load_reservations(w: Warehouse, folder: str, force: str | None = None) -> None:
    load_arrivals(
        w.spark, "reservations", f"{folder}/incoming/*", f"{folder}/bronze", f"{folder}/history", w.clock.loaded, force
    )


def bronze_stream_reload(w: Warehouse) -> DataFrame:
    """Reservations that arrived as files and were loaded again by force, then validated: the copies leave no trace."""
    raw = bronze_rows(w.spark, _arrived_reservations(w), "reservations").drop("load")
    return silver.silver_reservations(raw, w.clock.loaded).drop("_source_file")


def bronze_stream_loads(w: Warehouse) -> DataFrame:
    """Rows of every load of the arrivals."""
    return loads(w.spark, _arrived_reservations(w), "reservations").select("load", "loaded_rows")
