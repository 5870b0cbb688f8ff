"""Benchmark: headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query runs once cold (session and file warm-up), then five times warm
into the ``noop`` sink; the reported time is the warm median.  ``value`` is
the sum of the medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from strata.plans.registry import REGISTRY  # noqa: E402
from strata.session import build_session  # noqa: E402

HEADLINE = [
    "gold_top_products",         # adapter E: validate/conform -> dedup -> join -> aggregate
    "gold_sales_by_country",
    "dedup_events",              # adapter L: 600k lines -> first arrival per id
    "l_gold_sales_by_country",   # adapter L: dedup + gold
    "l_gold_top_products",
    "valid_events",              # JSON message validation (parse once)
    "ingest_quality",            # validate + dedup counts over D + L messages
    "summary_all",               # enriched summaries in one GROUPING SETS pass
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), app_name="strata-bench")
    times: dict[str, float | None] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            df_factory = REGISTRY[name]
            df_factory(spark, sf_dir).write.format("noop").mode("overwrite").save()  # cold
            runs = []
            for _ in range(5):
                t0 = time.perf_counter()
                df_factory(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 3)
        except Exception as ex:  # noqa: BLE001 - report and keep measuring the rest
            times[name] = None
            failed[name] = f"{type(ex).__name__}: {str(ex)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_warm_median_total",
           "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
