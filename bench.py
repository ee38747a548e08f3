"""Times the headline queries; prints one JSON line. Reads BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from quillstone.plans import catalog

HEADLINE = (
    "ac01_accounts_features", "jn04_row_assignment", "agg01_pivot_latest", "agg02_provenance", "agg03_restatement", "agg04_restatement_by_year", "agg06_reconciliation", "jn01_population_join", "jn03_snapshot_assignment",
    "jn12_full_outer_audit", "agg05_member_histogram", "agg08_unit_distribution", "agg09_concept_inventory", "agg15_companies_per_person", "lt01_lead_time", "smp03_stratified", "rul_flags", "agg25_rank_effect", "hk04_leak_scan",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run = lambda: catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        run()  # compiles
        began = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - began, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(scale[1]) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
