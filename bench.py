"""Seconds per headline query; prints one JSON line.

Each query runs to completion over the whole tables of ``$BENCH_SF_DIR`` into a sink that
discards its rows, once to warm the JVM up and then timed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from fixtures.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = (
    "daily_answers",
    "weekly_spine",
    "weekly_spine_iso",
    "weekly_forecast",
    "monthly_full",
    "history_dashboard",
    "tp_bonus",
    "tp_digitalchannel",
    "tp_pix_received",
    "tp_bondcard",
    "credit_acquired",
    "credit_settled",
    "flags_with_credit",
    "flags_merge",
    "one_per_person",
    "sup_fraud",
    "sup_quarantine",
    "suppress_all",
    "contact_credit",
    "contact_points",
    "eligibility_end_to_end",
)


def run(name: str, spark: SparkSession) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("loyalpulse-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        run(name, spark)
        seconds[name] = round(run(name, spark), 3)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
