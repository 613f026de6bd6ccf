"""The whole pipeline over a stage folder of CSV extracts, one subfolder per entity.

    python -m innledger.plans.pipeline STAGE ROOT AS_OF [PREVIOUS]
    python -m innledger.plans.pipeline STAGE ROOT AS_OF --arrivals [--force=NAME]

loads the extracts into typed raw tables, builds every layer table and writes all reports, everything
below ROOT, which all executors must be able to reach. AS_OF is the time of the run in ISO format.
PREVIOUS is the ROOT of the run before, whose guest and room versions and keys are carried on.

With --arrivals, ROOT and STAGE stay the same from run to run: only files that no run has loaded are read, and the
run goes on from the last one below ROOT. --force=NAME loads all files once more, once for each NAME.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.operators import dq
from innledger.operators.silver import clock as clock_literal
from innledger.plans.registry import QUERIES, REPORTS
from innledger.plans.warehouse import BUILDERS, Clock, Warehouse
from innledger.session import child_names
from innledger.sources.bronze import bronze_rows, load_bronze
from innledger.sources.csv_ingest import base_rows, increment_rows
from innledger.streaming.arrivals import load_all_arrivals


def file_warehouse(
    spark: SparkSession,
    stage: str,
    root: str,
    clock: Clock,
    previous: str | None = None,
    bronze: str | None = None,
    since: dt.datetime | None = None,
) -> Warehouse:
    """Warehouse over raw tables loaded from CSV; increments are told by their file names.

    `bronze` is where the raw tables are, if not below `root`. Of these, only rows loaded after `since` are merged
    into the versions.
    """

    def rows(name: str, after: dt.datetime | None) -> DataFrame:
        entity = name.removeprefix("raw_").removesuffix("_inc")
        table = bronze_rows(spark, bronze or f"{root}/bronze", entity).drop("load")
        if after is not None:
            table = table.where(F.col("_loaded_at") > clock_literal(after))
        if name.endswith("_inc"):
            return increment_rows(table)
        return base_rows(table) if entity in ("guests", "rooms") else table

    before = previous and f"{previous}/layers"
    raw = cache(lambda name: rows(name, None))
    return Warehouse(spark, stage, raw, clock, f"{root}/layers", before, cache(lambda name: rows(name, since)))


def build(w: Warehouse, root: str, reports: Sequence[str]) -> None:
    """All layer tables, the final log and the reports, below `root`."""
    for table in BUILDERS:
        # The first load of guests and rooms; a carried run merges all that came into the versions before it.
        if w.previous is None or table not in ("silver_guests", "silver_rooms"):
            w.stored(table)
    # The final state of the log, with the value checks of the second round.
    dq.write_log(QUERIES["dq_log_rebuild"](w), f"{root}/layers/dq_log_final")
    for name in reports:
        dated = QUERIES[name](w).select(F.lit(w.clock.merged.isoformat()).alias("as_of"), "*")
        dated.write.mode("overwrite").parquet(f"{root}/reports/{name}")


def run(
    spark: SparkSession,
    stage: str,
    root: str,
    clock: Clock,
    previous: str | None = None,
    reports: Sequence[str] = tuple(REPORTS),
) -> Warehouse:
    load_bronze(spark, stage, f"{root}/bronze", clock.loaded)
    w = file_warehouse(spark, stage, root, clock, previous)
    build(w, root, reports)
    return w


def finished_runs(spark: SparkSession, root: str) -> list[str]:
    """Names of the runs below `root` that came to their end, in order of time."""
    runs = sorted(child_names(spark, f"{root}/runs"))
    return [r for r in runs if "_SUCCESS" in child_names(spark, f"{root}/runs/{r}/finished")]


def run_arrivals(
    spark: SparkSession,
    stage: str,
    root: str,
    clock: Clock,
    force: str | None = None,
    reports: Sequence[str] = tuple(REPORTS),
) -> Warehouse:
    """A run over the files that arrived in the stage since the last one; all others stay unread.

    Raw tables grow below `root`, layers and reports are those of the run. Versions and surrogate keys go on from the last
    finished run, and the rows loaded since are merged. `clock.loaded` must be later than in earlier runs; a run that is
    repeated with the same clock replaces its own results.
    """
    stamp = f"{clock.loaded:%Y%m%dT%H%M%S%f}"
    earlier = [r for r in finished_runs(spark, root) if r < stamp]
    load_all_arrivals(spark, stage, f"{root}/bronze", f"{root}/history", clock.loaded, force)
    previous = f"{root}/runs/{earlier[-1]}" if earlier else None
    since = dt.datetime.strptime(earlier[-1], "%Y%m%dT%H%M%S%f") if earlier else None
    own = f"{root}/runs/{stamp}"
    w = file_warehouse(spark, stage, own, clock, previous, f"{root}/bronze", since)
    build(w, own, reports)
    spark.range(1).write.mode("overwrite").parquet(f"{own}/finished")
    return w


if __name__ == "__main__":
    words = [a for a in sys.argv[1:] if not a.startswith("--")]
    options = dict(a.removeprefix("--").partition("=")[::2] for a in sys.argv[1:] if a.startswith("--"))
    stage_folder, root_folder, as_of, *earlier = words
    now = dt.datetime.fromisoformat(as_of)
    session = SparkSession.builder.appName("innledger").getOrCreate()
    if "arrivals" in options:
        run_arrivals(session, stage_folder, root_folder, Clock(now, now, now), options.get("force"))
    else:
        run(session, stage_folder, root_folder, Clock(now, now, now), earlier[0] if earlier else None)
    session.stop()
