"""Headline queries timed at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written to the noop sink, so all columns of all rows are computed.
The first run of a query is the one reported; one unreported build of the base table on
the smallest neighbour folder (or the same one) warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ebbtide.plans import catalog
from ebbtide.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = [
    "build_abt", "usage_rollup", "latest_per_key", "missing_report", "impute_numeric", "iqr_winsorize", "univariate_profile",
    "histogram", "correlation_matrix", "rate_by_category", "quantile_segment", "stratified_split", "core_metrics", "roc_auc_large",
    "leakage_auc", "pr_auc", "fairness_metrics", "reweighing", "ks_two_sample", "psi", "drift_report", "nearest_neighbors",
    "fit_logistic", "windowed_stats",
]


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = local_session(CPUS, "ebbtide-bench")
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    catalog.QUERIES["build_abt"](spark, small if os.path.isdir(small) else SF_DIR).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
