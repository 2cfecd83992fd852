"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local threads.
Every query runs to the end into a sink that drops the rows; building its plan is
part of the time. Each runs twice and the faster run counts, so that compiling the
generated code is left out.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES
from daybook.session import configure

HEADLINE = (
    "turnover_daily",
    "opening_balance",
    "balance_daily",
    "balance_month_end",
    "form101",
    "typed_load",
    "keyed_upsert",
    "keyed_upsert_partial",
    "append_new_rows",
    "dedupe_rows",
    "contract_violations",
    "duplicate_key_rows",
    "loan_holiday_mart",
    "nonnull_profile",
    "balance_repair_in",
    "account_balance_turnover",
    "late_postings",
    "duplicate_profile",
    "detail_load",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        # Shuffles are a few megabytes here; keep them spread over all threads.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    seconds = {name: min(run(name), run(name)) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
