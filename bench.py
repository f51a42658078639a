"""Wall time of the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line. Each query runs once to warm up
and then as often as BENCH_RUNS says (3); the median counts. Rows are written to Spark's noop sink, so all columns are made."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

QUERIES = [
    "obs_depth_histogram", "matrix_totals", "count_table_wide", "filter_replicate_presence", "sample_funnel", "own_vs_shared", "cpm_normalise", "best_hits", "tax_consensus", "affiliation_metric_filter",
    "taxonomy_rollup", "alignment_distribution", "read_filter_cascade", "dereplicate", "demultiplex_hamming", "subsample_to_min", "rarefaction_curve", "alpha_diversity", "beta_bray", "expected_vs_observed",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from amplicore.plans import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in os.environ.get("BENCH_QUERIES", " ".join(QUERIES)).split():
        times = []
        for _ in range(1 + int(os.environ.get("BENCH_RUNS", "3"))):
            t = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        took[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({"metric": "headline queries, sum of median seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
