"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (warm runs per query, default 3), BENCH_QUERIES (comma list).

Each run executes the whole plan into Spark's ``noop`` sink (no collect to
the driver, nothing written).  Per query: the cold first run and the median
of the warm runs; ``value`` is the sum of the warm medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "sql_sum", "groupby_count", "profile_numeric", "describe", "unique_values", "sql_join_using",
    "sql_window_rank", "sql_window_analytic", "sql_window_frames", "sql_topk", "sql_asof", "sql_theta_join", "sql_not_in", "state_transitions",
    "flow_edges", "set_overlap", "detect_fused_text", "promote_bold_headings", "markdown_summary", "page_metadata", "issue_report",
    "section_map",
]


def main() -> None:
    from sightline.plans.catalog import all_queries
    from sightline.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16)
    qs = all_queries()
    out: dict[str, float] = {}
    cold: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        times = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i == 0:
                    cold[name] = round(dt, 3)
                else:
                    times.append(dt)
            out[name] = round(statistics.median(times), 3)
        except Exception as exc:  # one failing query must not lose the whole report
            errors[name] = f"{type(exc).__name__}: {exc}"[:300]
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_warm_median_sum",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
