"""Slowly changing dimensions: one merge for every tracked table.

Plain files know no UPDATE or MERGE, so a merge maps the old snapshot and the increment to a new
snapshot. Applying the same increment again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innledger.functions.columns import any_of, holds
from innledger.operators.dedup import latest_if
from innledger.operators.silver import clock, valid_guest
from innledger.values import (
    GUEST_OVERWRITE,
    GUEST_TRACKED,
    OPEN_END_DATE,
    ROOM_OVERWRITE,
    ROOM_TRACKED,
    SCD_COLUMNS,
)


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    overwrite: Sequence[str],
    batch_ts: dt.datetime,
    valid: Column,
    overwrite_where: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """All versions after the merge, with an `action` per row.

    A change in a tracked column of the latest valid source row ends the current version and opens the
    next one. The overwrite columns of the current version follow the latest source row that passes
    `overwrite_where`. Unknown keys open version 1 when valid. Versions start on the day of `batch_ts`. Comparison ignores NULL unless
    `null_safe`. Actions: history, unchanged, overwritten, expired, new_version, inserted.
    """
    as_of = batch_ts.date()
    audit = ("_loaded_at", "_source_file")
    columns = target.columns
    business = [c for c in columns if c not in (*SCD_COLUMNS, *audit)]
    schema = target.schema

    eligible = F.lit(True) if overwrite_where is None else overwrite_where
    picks = (
        source.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(
            latest_if(valid, source, key, [*business, "_file_name"]).alias("_new"),
            latest_if(eligible, source, key, overwrite).alias("_over"),
        )
    )
    current = target.where("is_current").select(F.struct(*columns).alias("_cur"))
    both = current.join(picks, F.col("_cur")[key] == F.col("_key"), "full_outer")

    cur, new, over = F.col("_cur"), F.col("_new"), F.col("_over")

    def differs(side: Column, column: str) -> Column:
        if null_safe:
            return ~side[column].eqNullSafe(cur[column])
        return holds(side[column] != cur[column])

    def row(action: Column | str, values: dict[str, Column]) -> Column:
        fields = [values[c].cast(schema[c].dataType).alias(c) for c in columns]
        label = action if isinstance(action, Column) else F.lit(action)
        return F.struct(*fields, label.alias("action"))

    def overlaid(base: Column) -> dict[str, Column]:
        return {
            c: F.when(over.isNotNull(), over[c]).otherwise(base[c]) if c in overwrite else base[c]
            for c in business
        }

    old = {c: cur[c] for c in columns}
    rewritten = over.isNotNull() & any_of(~over[c].eqNullSafe(cur[c]) for c in overwrite)
    opened = {
        **overlaid(new),
        "scd_start_date": F.lit(as_of),
        "scd_end_date": F.lit(OPEN_END_DATE),
        "is_current": F.lit(True),
        "_loaded_at": clock(batch_ts),
        "_source_file": new["_file_name"],
    }
    kept = row(F.when(rewritten, "overwritten").otherwise("unchanged"), {**old, **overlaid(cur)})
    expired = row("expired", {**old, "scd_end_date": F.lit(as_of) - F.lit(1), "is_current": F.lit(False)})
    next_version = row("new_version", {**opened, "scd_version": cur["scd_version"] + 1})
    first_version = row("inserted", {**opened, "scd_version": F.lit(1)})

    changed = new.isNotNull() & any_of(differs(new, c) for c in tracked)
    outcome = (
        F.when(cur.isNotNull() & changed, F.array(expired, next_version))
        .when(cur.isNotNull(), F.array(kept))
        .when(new.isNotNull(), F.array(first_version))
    )
    history = target.where("not is_current").withColumn("action", F.lit("history"))
    return both.select(F.inline(outcome)).unionByName(history)


def merge_guests(target: DataFrame, source: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    """Tier changes make versions; contact data is overwritten even if the tier is not valid."""
    return scd2_merge(
        target, source, "guest_id", GUEST_TRACKED, GUEST_OVERWRITE, batch_ts, valid=valid_guest()
    )


def merge_rooms(target: DataFrame, source: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    """Price or amenity changes make versions; a room never takes over a capacity of zero or less."""
    has_capacity = F.col("capacity") > 0
    return scd2_merge(
        target,
        source,
        "room_id",
        ROOM_TRACKED,
        ROOM_OVERWRITE,
        batch_ts,
        valid=has_capacity & (F.col("base_price") >= 0),
        overwrite_where=has_capacity,
    )


def changed_history(versions: DataFrame, key: str) -> DataFrame:
    """Every version of the keys that have more than one, in one shuffle: a key has few versions."""
    per_key = F.count("*").over(Window.partitionBy(key))
    return versions.withColumn("_versions", per_key).where("_versions > 1").drop("_versions")


def merge_summary(merged: DataFrame, table: str) -> DataFrame:
    """What a merge did: number of versions ended, opened, inserted and overwritten."""

    def rows(action: str) -> Column:
        return F.count_if(F.col("action") == action).alias(f"{action}_rows")

    return merged.agg(*[rows(a) for a in ("expired", "new_version", "inserted", "overwritten", "unchanged")]).select(
        F.lit(table).alias("scd2_table"), "*"
    )


BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_versions(versions: DataFrame, table: str, key: str, buckets: int) -> None:
    """Versions as a table that `merge_buckets` can change in part: partitioned by a hash of the key."""
    bucketed = versions.withColumn(BUCKET, bucket_of(key, buckets)).repartition(F.col(BUCKET))
    bucketed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(table)


def merge_buckets(
    table: str,
    source: DataFrame,
    key: str,
    buckets: int,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    staging: str,
) -> DataFrame:
    """Merges the source into a table of `write_versions` and rewrites only the partitions of arriving keys.

    What `merge` gives for these is written to `staging` first, then put in place by a dynamic partition overwrite; the
    files of all other partitions stay as they are. A merge that is cut short may be repeated: merging the same rows
    again changes nothing. Returns the rows of the rewritten partitions with their `action`.

    A bucket holds the keys of one hash, so choose as many that one fits a task; their numbers, at most `buckets`, reach
    the driver to prune the scan.
    """
    spark = source.sparkSession
    arriving = source.where(F.col(key).isNotNull()).withColumn(BUCKET, bucket_of(key, buckets))
    touched = [row[0] for row in arriving.select(BUCKET).distinct().collect()]
    versions = spark.read.parquet(table)
    before = versions.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = merge(before, source).withColumn(BUCKET, bucket_of(key, buckets))
    merged.repartition(F.col(BUCKET)).write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(merged.schema).parquet(staging)
    writer = staged.select(*versions.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(table)
    return staged.drop(BUCKET)
