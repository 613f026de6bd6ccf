"""Joins against a per-key result when one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(
    rows: DataFrame, groups: DataFrame, row_key: str, group_key: str, row_id: list[str], how: str
) -> DataFrame:
    """Joins rows to groups, spreading the rows of every key over several tasks.

    A result that was just grouped by the key would otherwise be joined where it lies, with all rows of
    a key in one task. Each group is repeated once per salt, so this is for groups that are few against
    the rows. Both sides are shuffled anew, which also lets Spark split a salt that is still too large.
    """
    salt = F.pmod(F.xxhash64(*row_id), F.lit(SALTS)).cast("int")
    left = rows.withColumn("_row_salt", salt)
    right = groups.withColumn("_group_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = (F.col(row_key) == F.col(group_key)) & (F.col("_row_salt") == F.col("_group_salt"))
    return left.join(right, same, how).drop("_row_salt", "_group_salt")
