"""Times the headline queries on one table folder and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from acceptance import catalog
from acceptance import testbed
from wardlens.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Streams and whole batch runs write their results on every run, so they run once.
ONCE = ("stream_", "raw_csv", "daily_", "batch_")


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": CPUS,
        # Small test tables: partitions small enough to keep all cores busy.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")

    def run(query) -> None:
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

    spark.range(1000).selectExpr("sum(id)").collect()
    timings = {
        "build_silver": seconds(lambda: testbed.silver(spark, SF_DIR)),
        "build_gold": seconds(lambda: testbed.stats(spark, SF_DIR)),
    }
    for name, query in catalog.queries().items():
        if name.startswith(ONCE):
            timings[name] = seconds(lambda: run(query))
        else:
            run(query)
            timings[name] = statistics.median(seconds(lambda: run(query)) for _ in range(RUNS))
    print(json.dumps({
        "metric": "total seconds over all queries (warm median; streams and CSV round trips once)",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in timings.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
