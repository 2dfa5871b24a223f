"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``; each query is built and fully materialised
through the ``noop`` sink, once to warm up and then ``$BENCH_REPEATS`` times
(median kept).  Prints ONE JSON line.

Timed are the query plans themselves (``catalog.PLANS``): the registered
``queries()`` wrappers add only a projection that rounds floating columns for
the cross-engine comparison, which is not part of the work a user runs.
Planning time on the driver (building the DataFrame) is included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "customer_history_features",
    "agg_multi_spec",
    "filtered_subset_agg",
    "two_level_agg",
    "last_k_agg",
    "lagged_diff_mean",
    "group_recipes",
    "onehot_share_agg",
    "target_encode",
    "quantile_bin",
    "rank_min_blend",
    "auc_per_fold",
    "knn_score",
    "features_bureau_two_level",
    "features_previous_history",
    "features_installments",
    "features_credit_card",
    "assemble_training_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE

    from featherstack.catalog import PLANS
    from featherstack.session import local_session

    spark = local_session(cpus, shuffle_partitions=cpus * 2, app="featherstack-bench")
    qs = PLANS
    timings = {}
    for name in names:
        runs = []
        for i in range(repeats + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # the first run warms the session and the file cache
                runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus,
                      "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
