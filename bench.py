"""Times the headline queries and prints one JSON line.

Each query runs once over its whole tables and is written to Spark's noop sink, so every column of every
row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from foldgauge.queries import QUERIES  # noqa: E402
from foldgauge.session import local_session  # noqa: E402

HEADLINE = (
    "label_frequency_orders",
    "stratified_folds_orders",
    "nested_fold_roles_orders",
    "stratified_subsample_orders",
    "clean_documents",
    "clean_pages",
    "clean_audit",
    "token_truncate",
    "zero_shot_messages",
    "few_shot_exemplars",
    "few_shot_messages",
    "parse_responses_orders",
    "per_label_metrics_orders",
    "comparison_table_orders",
    "inference_progress_orders",
    "json_props_extract",
    "score_replies",
    "corpus_csv",
    "fold_metrics_documents",
    "train_score_folds",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).count()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}
        )
    )


if __name__ == "__main__":
    main()
