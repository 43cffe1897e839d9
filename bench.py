"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1), BENCH_CPUS: local cores (default 8),
BENCH_RUNS: warm runs per query, of which the median counts (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "gold_market_overview",
    "gold_compensation_by_role",
    "gold_compensation_by_seniority",
    "gold_compensation_by_region",
    "gold_compensation_by_work_model",
    "gold_gender_representation",
    "gold_technology_adoption_by_year",
    "gold_ai_adoption_overview",
    "gold_skill_priority_score",
    "fact_respondent",
    "fact_ai_adoption",
    "option_bridge",
    "unmapped_values",
    "stats_quantity",
    "stats_open_domain",
    "stats_extendedprice",
    "surrogate_key",
    "duplicate_rows",
    "unknown_matrix",
    "family_bi_tool",
    "map_as_of",
    "unmapped_advice",
    "counted_gold_market_overview",
    "from_raw_gold_market_overview",
)


def main() -> None:
    from panelloom.plans import landing
    from panelloom.plans.driver_queries import QUERIES
    from panelloom.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(
        "panelloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            landing.forget()  # queries over the raw path are timed from raw files on
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "panelloom headline queries, median of warm runs, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
