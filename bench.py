"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tarn.plans.cases import ALL
from tarn.session import local_session

HEADLINE = (
    "text_objects",
    "explode_records",
    "persistent_keys",
    "reconcile_zones",
    "conversion_plan",
    "html_to_text",
    "text_profile",
    "language_vote",
    "basic_clean",
    "split_sentences",
    "chunk_documents",
    "clean_text",
    "media_profile",
    "describe_all",
    "histogram",
    "frame_sample",
    "encode_batch",
    "hash_encode",
    "embed_paragraphs",
    "embed_videos",
    "project_linear",
    "collection_add",
    "knn",
    "knn_approx",
    "cross_modal_search",
    "text_search",
    "hydrate_hits",
)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds from building the plan to the last row."""
    start = time.perf_counter()
    ALL[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)  # warm-up
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(rounds)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
