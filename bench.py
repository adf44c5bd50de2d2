"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.session import local_session
from tidemark.workload import QUERIES

# one or two of each family, from raw scan to monitoring
HEADLINE = (
    "agg_monthly_rollup", "agg_label_rates_by_month", "jon_horizon_labels", "jon_lookback_counts",
    "jon_prior_history", "jon_snapshot_month", "jon_assemble_features", "jon_training_set",
    "jon_snapshot_rate_fanout", "win_usage_trends", "win_dedup", "win_quantile_bin",
    "srt_topk", "srt_action_ranks", "set_overlap", "agg_null_report", "agg_summary",
    "agg_score_trend", "dq_report", "dq_validate_records", "ml_ranking_metrics", "ml_lift",
    "ml_retrospective", "mon_psi", "mon_alerts", "obs_rate", "obs_latency_quantiles",
    "obs_sustained",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    QUERIES[names[0]](spark, folder).write.format("noop").mode("overwrite").save()     # warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder)}))
    spark.stop()


if __name__ == "__main__":
    main()
