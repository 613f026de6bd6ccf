"""Dense surrogate keys 1..n without funnelling rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART, POSITION = "_part", "_position"
_POSITION_BITS = 33


def with_positions(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Adds the partition number and the place within the partition.

    Without an order, rows are numbered where they are: no shuffle, insertion order. With an order the
    frame is range-partitioned and sorted first; the order must be total to be repeatable. The result
    has to be written before keys are derived from it, so that each row keeps the place it was given.
    """
    placed = df.orderBy(*order) if order else df
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.select("*", F.spark_partition_id().alias(PART), within.alias(POSITION))


def assign_keys(stored: DataFrame, name: str) -> DataFrame:
    """Turns stored positions into keys 1..n, in place of the position columns.

    Only the partition sizes meet in one task, one row per written partition; the running total of
    these is small enough to be broadcast by construction.
    """
    sizes = stored.groupBy(PART).agg(F.count("*").alias("_size"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(PART, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    keyed = stored.join(F.broadcast(starts), PART)
    rest = [c for c in stored.columns if c not in (PART, POSITION)]
    return keyed.select((F.col("_start") + F.col(POSITION) + 1).alias(name), *rest)


def unknown_keys(rows: DataFrame, known: DataFrame, natural: Sequence[str]) -> DataFrame:
    """The natural keys of the rows that have no surrogate key yet."""
    return rows.select(*natural).join(known, list(natural), "left_anti")


def carry_keys(
    rows: DataFrame, known: DataFrame, numbered: DataFrame, natural: Sequence[str], name: str
) -> DataFrame:
    """Rows with the surrogate keys of their natural keys: those known, and new ones from the highest known on.

    `known` holds `name` and the natural keys, `numbered` the stored positions of the natural keys that are not in it
    (see `unknown_keys` and `with_positions`). No known key changes, whatever rows arrive; the keys of rows that are
    gone are not given away again. Natural keys are unique and not null.
    """
    highest = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    fresh = assign_keys(numbered, name).select((F.col(name) + highest).alias(name), *natural)
    keys = known.select(name, *natural).unionByName(fresh)
    return rows.join(keys, list(natural)).select(name, *rows.columns)
