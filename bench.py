"""Time the registered queries and print one JSON line.

BENCH_SF_DIR names the test data, BENCH_CPUS the local cores.  Every query runs
whole into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import time

from civicmart.session import open_session
from civicmart.workload.queries import CLEAN_BUILDERS, MART_BUILDERS, QUERIES, stored
from civicmart.contracts import CLEAN, MART


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "").split() or list(QUERIES)
    spark = open_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start the session outside the timings

    seconds = {}
    # The layers as the pipeline stores them; later queries read these tables.
    for layer, names in ((CLEAN, CLEAN_BUILDERS), (MART, MART_BUILDERS)):
        for name in names:
            seconds[f"store_{layer}_{name}"] = timed(lambda: stored(spark, sf_dir, layer, name))
    for name in chosen:
        seconds[name] = timed(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
