"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lectern.checks import QUERIES
from lectern.session import build_session

# Seconds below which a query is run again.
SHORT = 3.0
HEADLINE = [
    "extract_sections",
    "page_text",
    "page_blocks",
    "fetch_text",
    "chunk_sections",
    "chunk_fixed",
    "chunk_size_sweep",
    "preprocess_text",
    "unique_words",
    "embed_chunks",
    "write_index",
    "assign_chunk_id",
    "bm25_stats",
    "bm25_idf",
    "bm25_score",
    "lexical_topk",
    "semantic_topk",
    "hybrid_merge",
    "retrieve",
    "num_chunks_sweep",
    "ir_metrics",
    "tfidf_weights",
    "split_prefix",
    "split_stratified",
    "retrieval_score",
    "quality_score",
    "cost_analysis",
    "weighted_prf",
    "judge_answers",
    "answer_batch",
    "train_tag_classifier",
    "stream_index_pages",
    "feedback_rollup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{folder}/documents.parquet").count()
    seconds = {}
    for name in HEADLINE:
        runs = []
        # Short queries run three times; the median counts.
        while not runs or (sum(runs) < SHORT and len(runs) < 3):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(sorted(runs)[len(runs) // 2], 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
