"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def recency(df: DataFrame, keys: Sequence[str], first_ties: Sequence[str] = ()) -> list[str]:
    """Columns that rank the rows of a key, greatest first.

    The load time leads, then the file's name, so that of the files of one load the later one counts. Every other column
    follows, and the choice does not depend on the order in which rows arrive.
    """
    first = [*[c for c in ("_loaded_at", "_file_name") if c in df.columns], *first_ties]
    return [*first, *[c for c in df.columns if c not in (*keys, *first)]]


#: Hash buckets that rows are counted by; a crowded one has this many times the rows of the mean bucket, and this many rows.
BUCKETS, CROWDED_TIMES, CROWDED_ROWS = 1 << 16, 16, 100_000


def crowded_buckets(df: DataFrame, keys: Sequence[str], least: int = CROWDED_ROWS) -> DataFrame:
    """Hash buckets of keys with very many rows: at most BUCKETS / CROWDED_TIMES, however many rows there are.

    Counting moves at most BUCKETS pairs of numbers per map task, and meets in one task as BUCKETS rows.
    """
    sizes = df.groupBy(_bucket(keys).alias("_crowded")).agg(F.count("*").alias("_rows"))
    mean = F.sum("_rows").over(Window.partitionBy()) / BUCKETS
    crowded = sizes.withColumn("_mean", mean).where((F.col("_rows") >= least) & (F.col("_rows") > CROWDED_TIMES * F.col("_mean")))
    return crowded.select("_crowded")


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    first_ties: Sequence[str] = (),
    valid: Column | None = None,
    least: int = CROWDED_ROWS,
) -> DataFrame:
    """The greatest row per key, of the valid rows if a condition is given.

    Filter on the rank lets Spark keep one row per key and map task before the shuffle, so that a key with very many
    copies never meets in one task. To do so it sorts whole map tasks, which spills once they are large; so only the rows
    of crowded buckets go that way, and all others are shuffled as they are read and ranked after it. Buckets are counted
    over all rows, valid or not, from the keys alone.
    """
    order = [F.col(c).desc_nulls_last() for c in recency(df, keys, first_ties)]
    latest_first = Window.partitionBy(*keys).orderBy(*order)
    crowded = F.broadcast(crowded_buckets(df, keys, least))
    same = _bucket(keys) == F.col("_crowded")
    rows = df if valid is None else df.where(valid)
    many = rows.join(crowded, same, "left_semi").withColumn("_rank", F.row_number().over(latest_first))
    # The first row of a key has none before it; no rank here, or these rows would be sorted before the shuffle too.
    few = rows.join(crowded, same, "left_anti").withColumn("_later", F.lag(F.lit(1)).over(latest_first))
    return many.where("_rank = 1").drop("_rank").unionByName(few.where("_later is null").drop("_later"))


def latest_if(condition: Column, df: DataFrame, key: str, columns: Sequence[str]) -> Column:
    """Aggregate: the given columns of the greatest row of a key that meets the condition.

    The same choice as `dedup_latest`, but several of these share one shuffle.
    """
    rank = F.struct(*recency(df, [key]))
    return F.max_by(F.struct(*columns), F.when(condition, rank))
