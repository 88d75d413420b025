"""Headline queries, timed end to end; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. The corpus tables are built first and timed as
``build_corpus``; then each query runs once to warm up and once for the record, into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from codequarry.plans.corpus import corpus  # noqa: E402
from codequarry.plans.queries import QUERIES, candidates, page_nodes  # noqa: E402

HEADLINE = [
    "definitions_by_kind", "definitions_dedupe", "file_results", "scan_summary", "file_reports", "calls", "top_callees",
    "corpus_top_callees", "imports", "references", "node_at", "ancestors", "tree_view", "tree_sexp", "diagnostic_summary",
    "outline", "body", "structural_query", "page_tokens", "page_pairs", "element_nodes", "source_lines",
    "lexical_definitions", "lexical_calls", "lexical_references",
]


def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    data = corpus(spark, sf_dir)
    page_nodes(spark, sf_dir)
    candidates(spark, sf_dir)
    built = round(time.perf_counter() - start, 3)
    sizes = {"nodes": data.nodes.count(), "files": data.files.count()}
    times = {}
    for name in names:
        run(QUERIES[name](spark, sf_dir))
        times[name] = run(QUERIES[name](spark, sf_dir))
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "build_corpus": built, "sizes": sizes, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
