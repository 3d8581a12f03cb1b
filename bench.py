"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS the timed runs after one
warm-up. Results go to Spark's no-op sink, so whole results are computed and nothing is
collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tabulary.queries.catalog import QUERIES
from tabulary.session import build_session

HEADLINE = (
    "strict_merge", "enrich_merge", "tolerant_merge", "partial_combine", "overlap_replace", "percent_decode",
    "document_lines", "page_tokens", "page_links", "ruling_tables", "prose_amounts", "forward_fill", "suffix_sum",
    "first_seen", "latest", "year_manifest", "metric_unpivot", "term_factors", "row_digest", "json_contract",
    "incremental_merge",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken[1:]), 3)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline queries, total of medians", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
