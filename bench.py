"""Time the registered queries and print one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     timed runs per query after one warm-up, the median counts (default 3)
    BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries below)

A query is timed from its call, writes included, until its last row went to a sink that drops it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import pyspark

from quayside.queries import QUERIES
from quayside.session import local_session


HEADLINE = [
    "typed_snapshot",
    "typed_sqlserver",
    "cast_to_schema",
    "infer_types",
    "scan_delimited",
    "scan_gz_pipe",
    "scan_mixed_folder",
    "scan_workbooks",
    "scan_envelope",
    "page_gaps",
    "flatten_programs",
    "flatten_offers",
    "normalize_scalars",
    "incremental_window",
    "latest_snapshot",
    "dedup_keep_first",
    "latest_by_key",
    "facts_for_keys",
    "lookup_config",
    "positional_concat",
    "strip_accents",
    "normalize_entity",
    "replace_partition",
    "merge_range",
    "bounded_files",
    "stream_ingest",
    "config_run",
    "model_build",
]


def timed(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(cpus, "quayside-bench")
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "total of the median seconds per query",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cpus,
        "spark": pyspark.__version__,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
