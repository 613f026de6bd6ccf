"""Audits taken while a layer table is written, so that none of them scans the table again.

Each write observes a fixed list of aggregates over the rows that pass it and keeps them as a small table beside the
layer. The measures are sums over tasks of the write's last stage; a task that runs again counts once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT = "table string, measure string, value decimal(38,2)"
ROWS = "total_rows"
#: Layer tables are written once and read by many: smaller files at some CPU time of the one write.
CODEC = "zstd"
ACTIONS = ("expired", "new_version", "inserted", "overwritten", "unchanged")
#: Layer tables that are measured.
MEASURED = (
    "guest_versions", "room_versions", "silver_reservations", "silver_housekeeping", "silver_billing",
    "dim_guest", "dim_room", "reservation_load", "fact_housekeeping", "fact_billing", "dq_log",
)


def measures(name: str) -> list[Column]:
    """What is measured of a layer table: its rows and the columns its audits are made of."""
    found = {ROWS: F.count(F.lit(1))}
    if name in ("guest_versions", "room_versions", "dim_guest", "dim_room"):
        found |= {"current_rows": F.count_if("is_current"), "historical_rows": F.count_if(~F.col("is_current"))}
    if name in ("guest_versions", "room_versions"):
        found |= {f"{a}_rows": F.count_if(F.col("action") == a) for a in ACTIONS}
    elif name == "reservation_load":
        found |= {s: F.count_if(F.col("status") == s) for s in ("confirmed", "cancelled", "completed")}
    elif name == "fact_housekeeping":
        found |= {"sla_breaches": F.count_if("sla_breached"), "issues_found": F.count_if("issue_detected_flag")}
    elif name == "fact_billing":
        found |= {
            "flagged_bills": F.count_if("is_flagged"),
            "mismatch_bills": F.count_if("billing_mismatch"),
            "total_revenue": F.sum("total_amount"),
        }
    return [value.cast("decimal(38,2)").alias(measure) for measure, value in found.items()]


def write_measured(frame: DataFrame, name: str, path: str, audit: str, partitions: tuple[str, ...] = ()) -> None:
    """Writes a layer table to `path` and what was measured on the way to `audit`."""
    spark: SparkSession = frame.sparkSession
    seen = Observation()
    writer = frame.observe(seen, *measures(name)).write.mode("overwrite").option("compression", CODEC)
    writer.partitionBy(*partitions).parquet(path)
    # A plan that turns out to have no rows may end without measures.
    found = seen.get or spark.read.schema(frame.schema).parquet(path).agg(*measures(name)).first().asDict()
    rows = [
        F.struct(F.lit(name).alias("table"), F.lit(measure).alias("measure"), F.lit(value).cast("decimal(38,2)").alias("value"))
        for measure, value in found.items()
    ]
    spark.range(1).select(F.inline(F.array(*rows))).write.mode("overwrite").parquet(audit)


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _renamed(audit: DataFrame, names: dict[str, str], label: str, count: str) -> DataFrame:
    pairs = [F.when(F.col("measure") == measure, F.lit(name)) for measure, name in names.items()]
    return audit.where(F.col("measure").isin(list(names))).select(
        F.coalesce(*pairs).alias(label), F.col("value").cast("long").alias(count)
    )


def row_counts(audits: dict[str, DataFrame]) -> DataFrame:
    """Rows of the validated tables, versioned ones also by whether they are current, and of the exception log."""

    def versioned(name: str) -> dict[str, str]:
        return {
            ROWS: f"{name} (all versions)",
            "current_rows": f"{name} (current)",
            "historical_rows": f"{name} (SCD2 history)",
        }

    names = {
        "guest_versions": versioned("VAL_GUESTS"),
        "room_versions": versioned("VAL_ROOMS"),
        "silver_reservations": {ROWS: "VAL_RESERVATIONS"},
        "silver_housekeeping": {ROWS: "VAL_HOUSEKEEPING"},
        "silver_billing": {ROWS: "VAL_BILLING"},
        "dq_log": {ROWS: "DQ_EXCEPTION_LOG"},
    }
    return _all([_renamed(audits[table], own, "table_name", "total_rows") for table, own in names.items()])


def merge_summary(audits: dict[str, DataFrame]) -> DataFrame:
    """What each merge did to its versions."""

    names = [f"{a}_rows" for a in ACTIONS]

    def of(table: str, name: str) -> DataFrame:
        counts = [F.max(F.when(F.col("measure") == m, F.col("value"))).cast("long").alias(m) for m in names]
        return audits[table].agg(*counts).select(F.lit(name).alias("scd2_table"), "*")

    return of("guest_versions", "VAL_GUESTS").unionByName(of("room_versions", "VAL_ROOMS"))


def load_audit(audits: dict[str, DataFrame]) -> DataFrame:
    """Row counts and load measures of the star schema in long form."""
    names = {
        "dim_guest": "DIM_GUEST",
        "dim_room": "DIM_ROOM",
        "reservation_load": "FACT_RESERVATION",
        "fact_housekeeping": "FACT_HOUSEKEEPING",
        "fact_billing": "FACT_BILLING",
    }
    return _all([audits[table].select(F.lit(name).alias("table_name"), "measure", "value") for table, name in names.items()])
