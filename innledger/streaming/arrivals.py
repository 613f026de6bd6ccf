"""CSV extracts that arrive over time: a file stream into the raw tables, each file loaded once.

The checkpoint of the stream is the load history. A run takes the files it does not list yet and ends; a run that was cut
short takes its batch again, into the same load folder. To load files again regardless, a run names a history of its own
(`force`), which starts empty; a repeated run of that name changes nothing either. Rows are appended then, as by any
load; the validated layer leaves one per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.sources.bronze import bronze_rows, store_load
from innledger.sources.csv_ingest import stream_csv_raw
from innledger.values import RAW_LAYOUTS

REGULAR = "regular"


def load_arrivals(
    spark: SparkSession,
    entity: str,
    incoming: str,
    bronze: str,
    history: str,
    loaded_at: dt.datetime,
    force: str | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Loads the files of `incoming` that the history does not know yet, a load folder per batch."""
    name = force or REGULAR
    arriving = stream_csv_raw(spark, incoming, RAW_LAYOUTS[entity], loaded_at, files_per_batch)

    def absorb(batch: DataFrame, batch_id: int) -> None:
        store_load(batch, entity, bronze, f"{name}-{batch_id:010d}")

    stream = (
        arriving.writeStream.foreachBatch(absorb)
        .option("checkpointLocation", f"{history}/{entity}/{name}")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()


def load_all_arrivals(
    spark: SparkSession, stage: str, bronze: str, history: str, loaded_at: dt.datetime, force: str | None = None
) -> None:
    """The same for every entity of a stage folder."""
    for entity in RAW_LAYOUTS:
        load_arrivals(spark, entity, f"{stage}/{entity}", bronze, history, loaded_at, force)


def loads(spark: SparkSession, bronze: str, entity: str) -> DataFrame:
    """Rows and files of every load of a raw table."""
    return (
        bronze_rows(spark, bronze, entity)
        .groupBy("load", "_loaded_at")
        .agg(F.count("*").alias("loaded_rows"), F.count_distinct("_file_name").alias("files"))
    )
