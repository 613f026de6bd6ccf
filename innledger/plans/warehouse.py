"""Raw, validated and star-schema tables of one hotel chain.

Layer tables are written once to the shared folder and read from there by all reports, so that no plan
spans all layers and a lost executor costs no more than its own tasks. A table is built when first
asked for, after the tables it needs.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from innledger.operators import anomaly, dq, gold, scd, silver
from innledger.operators.keys import PART, POSITION, assign_keys, carry_keys, unknown_keys, with_positions
from innledger.plans.audits import AUDIT, CODEC, MEASURED, write_measured
from innledger.session import content_stamp, new_folder
from innledger.sources.sample_views import SOURCE_TABLES, raw_view
from innledger.values import CANCEL_THRESHOLD, CANCEL_WINDOW_HOURS, MISMATCH_TOLERANCE


@dataclass(frozen=True)
class Clock:
    """When the first load and the merge of increments happen, and the parameters of the detections."""

    loaded: dt.datetime
    merged: dt.datetime
    cancels_as_of: dt.datetime
    cancels_hours: int = CANCEL_WINDOW_HOURS
    cancels_threshold: int = CANCEL_THRESHOLD
    tolerance: float = MISMATCH_TOLERANCE


class Warehouse:
    """`raw` gives the raw tables by name: `raw_<entity>`, for guests and rooms also `raw_<entity>_inc`.

    `source` is the folder their files lie in, `root` the folder for the layer tables. `previous` is the
    root of an earlier run whose guest and room versions and surrogate keys are carried on instead of starting anew.
    `arrived` gives the raw rows that are merged into these versions, by the same names; all of `raw` by default.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        raw: Callable[[str], DataFrame],
        clock: Clock,
        root: str | None = None,
        previous: str | None = None,
        arrived: Callable[[str], DataFrame] | None = None,
    ):
        self.spark = spark
        self.source = source
        self.raw = raw
        self.clock = clock
        self.previous = previous
        self.arrived = arrived or raw
        self._root = root
        self._schemas: dict[str, StructType] = {}
        self._asked: set[str] = set()
        self._lock = threading.RLock()

    @cached_property
    def root(self) -> str:
        return self._root or new_folder(self.spark, "warehouse")

    def raws(self) -> dict[str, DataFrame]:
        return {name: self.raw(name) for name in dq.ROW_RULES}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stored(self, name: str) -> DataFrame:
        """The table as written, with row positions where it has them."""
        with self._lock:
            if name not in self._schemas:
                frame = BUILDERS[name](self)
                if name in MEASURED:
                    write_measured(frame, name, self.path(name), self.path(f"audit/{name}"), PARTITIONS.get(name, ()))
                else:
                    frame.write.mode("overwrite").option("compression", CODEC).parquet(self.path(name))
                self._schemas[name] = frame.schema
        return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))

    def audit(self, name: str) -> DataFrame:
        """What was measured when the table was written."""
        self.stored(name)
        return self.spark.read.schema(AUDIT).parquet(self.path(f"audit/{name}"))

    def table(self, name: str) -> DataFrame:
        return self.stored(name).drop(PART, POSITION)

    def keyed(self, name: str, key: str) -> DataFrame:
        """The table with its surrogate keys. A carried run keeps those of the run before and goes on from the highest."""
        stored = self.stored(name)
        if self.previous is None:
            return assign_keys(stored, key)
        before, natural = KEY_TABLES[name]
        known = self.spark.read.parquet(f"{self.previous}/{before}").select(key, *natural)
        with self._lock:
            fresh = self.path(f"fresh_keys/{name}")
            if fresh not in self._schemas:
                rows = with_positions(unknown_keys(stored.drop(PART, POSITION), known, natural), natural)
                rows.write.mode("overwrite").option("compression", CODEC).parquet(fresh)
                self._schemas[fresh] = rows.schema
        numbered = self.spark.read.schema(self._schemas[fresh]).parquet(fresh)
        return carry_keys(stored.drop(PART, POSITION), known, numbered, natural, key)

    # Transformations that both a layer table and a registered query are made of.

    def silver_guests(self) -> DataFrame:
        return silver.silver_guests(self.raw("raw_guests"), self.clock.loaded)

    def silver_rooms(self) -> DataFrame:
        return silver.silver_rooms(self.raw("raw_rooms"), self.clock.loaded)

    def silver_reservations(self) -> DataFrame:
        return silver.silver_reservations(self.raw("raw_reservations"), self.clock.loaded)

    def silver_housekeeping(self) -> DataFrame:
        return silver.silver_housekeeping(self.raw("raw_housekeeping"), self.clock.loaded)

    def silver_billing(self) -> DataFrame:
        return silver.silver_billing(self.raw("raw_billing"), self.clock.loaded)

    def _versions_before(self, versions: str, first: str) -> DataFrame:
        if self.previous is None:
            return self.table(first)
        return self.spark.read.parquet(f"{self.previous}/{versions}").drop(PART, POSITION, "action")

    def _arrived(self, name: str) -> DataFrame:
        """What is merged: the increment, and in a carried run the base rows too, which no first load takes."""
        increment = self.arrived(f"{name}_inc")
        return increment if self.previous is None else self.arrived(name).unionByName(increment)

    def merged_guests(self) -> DataFrame:
        before = self._versions_before("guest_versions", "silver_guests")
        return scd.merge_guests(before, self._arrived("raw_guests"), self.clock.merged)

    def merged_rooms(self) -> DataFrame:
        before = self._versions_before("room_versions", "silver_rooms")
        return scd.merge_rooms(before, self._arrived("raw_rooms"), self.clock.merged)

    def first_log(self) -> DataFrame:
        return dq.first_log(
            self.raws(),
            self.table("guest_versions"),
            self.table("room_versions"),
            self.table("silver_reservations"),
        )

    def dim_guest(self) -> DataFrame:
        return gold.dim_guest(self.keyed("guest_versions", "guest_sk"))

    def dim_room(self) -> DataFrame:
        return gold.dim_room(self.keyed("room_versions", "room_sk"), gold.dim_hotel(self.spark))

    def reservation_load(self) -> DataFrame:
        return gold.load_reservations(
            self.keyed("silver_reservations", "reservation_sk"), self.table("dim_guest"), self.table("dim_room")
        )

    # The facts with the flags of the detections; `anomaly.run_anomalies` gives all three to callers without a warehouse.

    def fact_reservation(self) -> DataFrame:
        clock = self.clock
        return anomaly.flag_reservations(
            self.table("reservation_load"), clock.cancels_as_of, clock.cancels_hours, clock.cancels_threshold
        )

    def fact_housekeeping(self) -> DataFrame:
        return anomaly.refresh_sla_flags(self.housekeeping_load())

    def fact_billing(self) -> DataFrame:
        return anomaly.flag_billing_mismatches(self.billing_load(), self.clock.tolerance)

    def housekeeping_load(self) -> DataFrame:
        return gold.load_housekeeping(self.keyed("silver_housekeeping", "housekeeping_sk"), self.table("dim_room"))

    def billing_load(self) -> DataFrame:
        return gold.load_billing(
            self.keyed("silver_billing", "billing_sk"), self.table("reservation_load"), self.table("dim_guest")
        )


# Where a run's surrogate keys stand, by keyed table, and the natural keys they belong to.
KEY_TABLES: dict[str, tuple[str, list[str]]] = {
    "guest_versions": ("dim_guest", ["guest_id", "scd_version"]),
    "room_versions": ("dim_room", ["room_id", "scd_version"]),
    "silver_reservations": ("reservation_load", ["reservation_id"]),
    "silver_housekeeping": ("fact_housekeeping", ["task_id"]),
    "silver_billing": ("fact_billing", ["bill_id"]),
}

# Layer tables that are written by partitions.
PARTITIONS: dict[str, tuple[str, ...]] = {"dq_log": ("error_type",)}

# Every layer table in dependency order. Dimensions are numbered in key order, facts as they come.
BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "silver_guests": Warehouse.silver_guests,
    "silver_rooms": Warehouse.silver_rooms,
    "silver_reservations": lambda w: with_positions(w.silver_reservations()),
    "silver_housekeeping": lambda w: with_positions(w.silver_housekeeping()),
    "silver_billing": lambda w: with_positions(w.silver_billing()),
    "guest_versions": lambda w: with_positions(w.merged_guests(), ["guest_id", "scd_version"]),
    "room_versions": lambda w: with_positions(w.merged_rooms(), ["room_id", "scd_version"]),
    "dq_log": Warehouse.first_log,
    "dim_guest": Warehouse.dim_guest,
    "dim_room": Warehouse.dim_room,
    "reservation_load": Warehouse.reservation_load,
    "fact_reservation": Warehouse.fact_reservation,
    "fact_housekeeping": Warehouse.fact_housekeeping,
    "fact_billing": Warehouse.fact_billing,
}

# Clock of the sample tables, which end in 2001.
SAMPLE_CLOCK = Clock(
    loaded=dt.datetime(2024, 1, 1, 6),
    merged=dt.datetime(2024, 2, 1, 6),
    cancels_as_of=dt.datetime(2001, 8, 1),
    cancels_hours=8760,
    cancels_threshold=1,
)

def _bronze(w: Warehouse, name: str, view: Callable[[], DataFrame]) -> DataFrame:
    """A raw table, over the sample tables when first asked for and as stored from then on.

    A run that reads it once, as a layer build does, spares the copy; what queries read again and again is made once.
    Under the lock of the layer tables, so that of two queries at once only one writes it.
    """
    path = w.path(f"bronze/{name}")
    with w._lock:
        if path not in w._schemas:
            frame = view()
            if path not in w._asked:
                w._asked.add(path)
                return frame
            frame.write.mode("overwrite").option("compression", CODEC).parquet(path)
            w._schemas[path] = frame.schema
    return w.spark.read.schema(w._schemas[path]).parquet(path)


_open: dict[tuple, Warehouse] = {}
_open_lock = threading.Lock()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over a folder of sample tables in this session.

    A new one if the session or the files changed. Sample files are listed and their schemas read once.
    """
    sources = sorted({t for tables in SOURCE_TABLES.values() for t in tables})
    stamps = tuple(content_stamp(spark, f"{sf_dir}/{t}.parquet") for t in sources)
    identity = (spark.sparkContext.applicationId, sf_dir, stamps)
    with _open_lock:
        if identity not in _open:
            read = cache(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
            raw = lambda name: _bronze(w, name, lambda: raw_view(spark, name, read))
            w = Warehouse(spark, sf_dir, raw, SAMPLE_CLOCK)
            _open[identity] = w
        return _open[identity]
