"""Times the eight questions on $BENCH_SF_DIR with $BENCH_CPUS cores.

Every question runs once per round over the parquet tables, its whole result
computed and dropped; the best of $BENCH_ROUNDS rounds counts. Prints one line
of JSON.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from catalog.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))
QUESTIONS = [name for name in QUERIES if name.startswith("q")]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("amity-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in QUESTIONS:
        times = []
        for _ in range(ROUNDS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the eight questions",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
