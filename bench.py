"""Benchmark: run the headline queries on one scale factor, print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set). Each query is forced to
full execution with the ``noop`` sink (no collect), after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odflow.plans.catalog import QUERIES, table  # noqa: E402
from odflow.session import build_session, ensure_checkpoint_dir  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.01"  # small, but with several chain slices

HEADLINE = [
    "top_pairs", "top_neighbour_pairs", "expansion_stats", "null_profile", "distribution",
    "quantile_profile", "quantile_approx", "duration_profile", "period_counts_month", "negative_check",
    "removal_report", "predecessor_pairs", "chain_lengths", "chain_stats", "longest_chain",
    "chain_lengths_3600", "longest_chain_3600",
]
# The ``*_sliced`` queries run the same plan with shorter time units; add them with BENCH_QUERIES if wanted.


def _scan_rate(spark, sf_dir: str) -> float:
    """Rate of the per-slice chain recurrence on one core (the sequential part): the prepared events trips of this scale factor as one slice, scanned
    inside one Spark task, which returns only (trips, seconds)."""
    import pandas as pd

    from odflow.operators import chain
    from odflow.plans.catalog import _chain_trips

    def timed(batches):
        parts = list(batches)
        if not parts:
            return
        pdf = pd.concat(parts)
        empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ["id", "dest", "p", "d", "value", "slice"]})
        t0 = time.perf_counter()
        chain._scan(pdf, empty, 300, True)
        yield pd.DataFrame({"n": [len(pdf)], "sec": [time.perf_counter() - t0]})

    row = (_chain_trips(spark, sf_dir).repartition(1)
           .mapInPandas(timed, "n long, sec double").first())
    return round(row["n"] / row["sec"], 1) if row is not None and row["sec"] else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra_conf={"spark.driver.memory": "16g"})
    ensure_checkpoint_dir(spark)
    # Warm-up, not timed: JIT/codegen and Python workers, on a smaller scale factor if present.
    warm_dir = WARMUP_DIR if os.path.isdir(WARMUP_DIR) else sf_dir
    for name in ("top_pairs", "chain_lengths"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    trips = table(spark, sf_dir, "events").count()
    scan_rate = _scan_rate(spark, sf_dir)
    out = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "warmup": f"top_pairs, chain_lengths on {os.path.basename(warm_dir.rstrip('/'))} (not timed)",
        "chain_trips": trips,
        "chain_trips_per_sec": round(trips / times["chain_lengths"], 1) if times.get("chain_lengths") else None,
        "chain_scan_trips_per_sec_per_core": scan_rate,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
