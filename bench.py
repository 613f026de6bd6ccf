"""Times every query at one scale and prints one JSON line.

Layer tables are built first, each timed on its own as `build_<table>`; the queries then read them, as
reports do. Each query is executed in full into a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from innledger.plans.registry import QUERIES
from innledger.plans.warehouse import BUILDERS, warehouse
from innledger.session import local_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:]
    spark = local_session(cpus, "12g")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # session start is not part of any query
    w = warehouse(spark, sf_dir)
    times: dict[str, float] = {}

    for table in BUILDERS:
        started = time.perf_counter()
        w.stored(table)
        times[f"build_{table}"] = time.perf_counter() - started

    for name, run in QUERIES.items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        run(w).write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - started

    rounded = {name: round(seconds, 3) for name, seconds in times.items()}
    print(
        json.dumps(
            {
                "metric": "total wall time of layer builds and all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
