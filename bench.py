"""Times the headline queries on $BENCH_SF_DIR with $BENCH_CPUS cores and prints one JSON line.

Each query runs once cold and once warm, its whole result going to a sink that drops it; the value
is the sum of the warm times.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lakewarden.plans import QUERIES
from lakewarden.session import build_session

HEADLINE = [
    "revenue_summary", "customer_health", "metric_cube", "policy_visibility", "effective_access",
    "access_gaps", "impact_closure", "pii_flow_closure", "version_diff", "pii_findings", "profile_orders",
    "dedup_latest", "tags_current", "net_grants", "quarantine", "stream_profile", "tag_propagation",
    "certification_status", "pii_redact", "lineage_with_external",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold = {n: seconds(n) for n in names}
    warm = {n: seconds(n) for n in names}
    print(json.dumps({
        "metric": "headline_queries_warm_total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
