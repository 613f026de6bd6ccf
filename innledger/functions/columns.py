"""Column expressions shared by the pipelines. All of them stay inside Spark's code generation."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from innledger.values import SLA_MINUTES, TRUE_TEXTS

_CLOCK_ORIGIN = "timestamp_ntz'0001-01-01 00:00:00'"


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def holds(condition: Column) -> Column:
    """The condition as a plain boolean: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def truthy(text: Column) -> Column:
    """True-like text in any case and with blanks around it; everything else is false."""
    return holds(F.upper(F.trim(text.cast("string"))).isin(*TRUE_TEXTS))


def null_if_token(text: Column, tokens: Iterable[str]) -> Column:
    """The text, or NULL where it is one of the tokens that stand for a missing value."""
    return F.when(~text.isin(*tokens), text)


def minutes_between(start: str, end: str) -> Column:
    """Number of minute boundaries crossed from start to end, free of any session time zone."""
    minute = "cast(cast({} - " + _CLOCK_ORIGIN + " as interval minute) as bigint)"
    return F.expr(f"{minute.format(end)} - {minute.format(start)}")


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; NULL when there is nothing to divide by."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def pct(part: Column, whole: Column, digits: int) -> Column:
    return F.round(100.0 * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def mean(value: str, digits: int) -> Column:
    """Rounded mean from an exact sum, so that it does not depend on the order of rows."""
    return F.round(safe_ratio(F.sum(value), F.count(value)), digits)


def sla_limit(task_type: Column) -> Column:
    limit = F.lit(None).cast("int")
    for name, minutes in SLA_MINUTES.items():
        limit = F.when(task_type == name, F.lit(minutes)).otherwise(limit)
    return limit


def sla_breached(task_type: Column, minutes: Column) -> Column:
    """Unknown task types and open tasks are never in breach."""
    return holds(minutes > sla_limit(task_type))


def histogram_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Zero-based bin of equal width; the highest value belongs to the last bin."""
    width = F.nullif(high - low, F.lit(0.0))
    return F.least(F.floor(F.coalesce((value - low) / width, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
