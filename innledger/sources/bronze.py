"""Typed raw tables, a folder per load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.sources.csv_ingest import OUTCOME, cast_lenient, read_csv_raw, store_strict
from innledger.values import RAW_LAYOUTS

# Columns whose bad values reject the row instead of becoming NULL.
STRICT_COLUMNS = {
    "housekeeping": ("scheduled_time", "start_time", "end_time", "issue_detected_flag"),
    "billing": ("is_flagged",),
}


def store_load(raw: DataFrame, entity: str, bronze: str, load: str) -> None:
    """Adds raw text rows to the raw table of an entity as one load, and rejected rows to `<entity>_rejects`.

    A load is a folder of its own, so one that is repeated replaces what it wrote before. Its files are scanned once.
    """
    layout = RAW_LAYOUTS[entity]
    path = f"{bronze}/{entity}/load={load}"
    if entity in STRICT_COLUMNS:
        _, rejected = store_strict(raw, layout, path, STRICT_COLUMNS[entity])
        rejected.write.mode("overwrite").parquet(f"{bronze}/{entity}_rejects/load={load}")
    else:
        cast_lenient(raw, layout).write.mode("overwrite").parquet(path)


def load_bronze(spark: SparkSession, stage: str, bronze: str, loaded_at: dt.datetime) -> None:
    """Adds every extract of the stage to its raw table."""
    for entity, layout in RAW_LAYOUTS.items():
        raw = read_csv_raw(spark, f"{stage}/{entity}", layout, loaded_at)
        store_load(raw, entity, bronze, f"{loaded_at:%Y%m%dT%H%M%S}")


def bronze_rows(spark: SparkSession, bronze: str, entity: str) -> DataFrame:
    """The raw table of an entity over all its loads, with the name of each row's `load`."""
    layout = f"{RAW_LAYOUTS[entity]}, _loaded_at timestamp_ntz, _file_name string, load string"
    if entity not in STRICT_COLUMNS:
        return spark.read.schema(layout).parquet(f"{bronze}/{entity}")
    stored = spark.read.schema(f"{layout}, {OUTCOME} string").parquet(f"{bronze}/{entity}")
    return stored.where(F.col(OUTCOME) == "good").drop(OUTCOME)
