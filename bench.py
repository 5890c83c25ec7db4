"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402

HEADLINE = [
    "search_top_hits",
    "search_shuffled",
    "mass_range_join",
    "top_hits",
    "merge_hits",
    "sort_by_spectrum",
    "digest_peptides",
    "distinct_peptides",
    "xcorr_preprocess",
    "index_by_order",
    "group_to_list",
    "fasta_scan",
    "mgf_scan",
    "mzxml_scan",
    "pepxml_roundtrip",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    names = sys.argv[1:] or HEADLINE
    threads = int(cpus) if cpus.isdigit() else os.cpu_count()
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(2 * threads))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["top_counts"](spark, sf).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
