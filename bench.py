"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores, BENCH_RUNS the runs per
query (the median counts). A time covers building, planning and running the query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from entigrid.plans.catalog import QUERIES  # noqa: E402
from entigrid.session import build_session  # noqa: E402

HEADLINES = [
    "normalize_names",
    "lei_status",
    "dedup_key",
    "first_seen_duplicates",
    "cleansed_parties",
    "ingestion_stats",
    "trust_score",
    "fingerprint_sha256",
    "fingerprint_blake3",
    "classified_table",
    "classification_counts",
    "rule_tiers",
    "wire_reparse",
    "field_profile",
    "dist_country",
    "anomalies",
    "severity_counts",
    "quality_score",
    "merged_view",
    "party_listing",
    "name_search",
    "stream_alerts",
    "party_classification",
]


def timed(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "entigrid-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, QUERIES["country_valid"], sf_dir)
    times = {
        name: round(statistics.median(timed(spark, QUERIES[name], sf_dir) for _ in range(runs)), 3)
        for name in HEADLINES
    }
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
