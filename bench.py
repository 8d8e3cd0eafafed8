"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs standalone (shared memo and cache cleared first) and is
forced through the ``noop`` sink, so the time covers every job the query
needs, eager statistics included. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandflow.plans import registry  # noqa: E402
from demandflow.session import build_session  # noqa: E402

HEADLINE = [
    "obs_view",                     # events -> observations (one aggregate)
    "v2_feature_table",             # flagship: clean, decode, lag, 11 OOF encodings, both sides
    "v1_feature_table",             # clipped variant, 7 encodings
    "nb_feature_table",
    "k2_time_split",                # distributed row numbering
    "k13_weighted_blend",           # predictions -> seed average -> CV weights -> blend
    "a6_describe",                  # exact quantiles of 5 columns in one pass
    "a12_stats_by_key",             # 7 group-bys as one shuffle
    "a13_by_hour_mean_median",      # grouped exact median
    "o3_top_values",
    "j1_lag_history",
    "d4_rolling_mean_3",            # skew-safe rolling frame
    "d1_roadtype_by_geohash_mode",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="demandflow-bench")
    reg = registry.load_all()
    times = {}
    for name in HEADLINE:
        registry._CONTEXTS.clear()
        spark.catalog.clearCache()
        t0 = time.time()
        reg[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
