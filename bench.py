"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "corpus_slice chunk_paragraphs chunk_stats assemble_documents html_text write_manifest read_manifest apply_manifest "
    "fingerprint global_rank split_by_digest "
    "train_test_split split_disjoint sample_n epoch_batches vocab encode truncation_report batch_size_frontier "
    "score_batches evaluate_perplexity "
    "ngram_lm lm_perplexity sweep perplexity read_logs parse_log hardware_usage search_bounds trial_frontier tail_per_run "
    "compare_runs run_status stream_usage stream_status "
    "parallel_pack pack_sequences collate_batches live_status"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    memory = os.environ.get("BENCH_DRIVER_MEMORY", "8g")
    os.environ.setdefault(
        "PYSPARK_SUBMIT_ARGS",
        f"--driver-memory {memory} --conf spark.ui.enabled=false --conf spark.ui.showConsoleProgress=false pyspark-shell",
    )
    from textloom.plans import registry
    from textloom.session import build_session

    spark = build_session("bench", f"local[{cpus}]")
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    spark.conf.set("spark.textloom.inputPartitions", cpus)  # the tables are one row group each
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        # the first run warms up the JVM and the Python workers
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total warm seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
