"""Increment files into a versioned table, as a file stream.

`merge_increments` writes a new snapshot for each batch, `merge_increments_in_place` rewrites only the partitions of a table
whose keys arrive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from innledger.operators.scd import merge_buckets
from innledger.session import child_names
from innledger.sources.csv_ingest import increment_rows


def snapshot_path(root: str, batch_id: int) -> str:
    return f"{root}/batch={batch_id:010d}"


def merge_increments(
    spark: SparkSession,
    incoming: str,
    schema: StructType,
    initial: str,
    snapshots: str,
    checkpoint: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    files_per_batch: int | None = None,
) -> DataFrame:
    """Merges all files that arrived since the last call and returns the newest snapshot.

    Batch n reads snapshot n-1 and writes snapshot n whole. A batch repeated after a failure therefore
    starts from the same input and replaces its own half-written output.
    """
    arrivals = _arrivals(spark, incoming, schema, files_per_batch)

    def absorb(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = initial if batch_id == 0 else snapshot_path(snapshots, batch_id - 1)
        merged = merge(session.read.parquet(before), batch).drop("action")
        merged.write.mode("overwrite").parquet(snapshot_path(snapshots, batch_id))

    _drain(arrivals, absorb, checkpoint)
    done = [n for n in child_names(spark, snapshots) if n.startswith("batch=")]
    return spark.read.parquet(f"{snapshots}/{max(done)}" if done else initial)


def merge_increments_in_place(
    spark: SparkSession,
    incoming: str,
    schema: StructType,
    table: str,
    key: str,
    buckets: int,
    checkpoint: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    files_per_batch: int | None = None,
) -> DataFrame:
    """Merges all files that arrived since the last call into a table of `write_versions` and returns the table.

    A batch repeated after a failure merges the same rows again, which changes nothing.
    """

    def absorb(batch: DataFrame, batch_id: int) -> None:
        merge_buckets(table, batch, key, buckets, merge, f"{checkpoint}-staging")

    _drain(_arrivals(spark, incoming, schema, files_per_batch), absorb, checkpoint)
    return spark.read.parquet(table)


def _arrivals(spark: SparkSession, incoming: str, schema: StructType, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return increment_rows(reader.load(incoming))


def _drain(arrivals: DataFrame, absorb: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Takes in everything that has arrived, then ends."""
    stream = (
        arrivals.writeStream.foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
