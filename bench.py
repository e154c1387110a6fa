"""Time registered queries over one scale factor; prints one JSON line.

Each query is run to its end without keeping rows (``noop`` sink). Query time includes the
jobs a query runs while it is put together, such as writing the tables it reads back.

    BENCH_SF_DIR    table folder (default /root/testdata/sf0.1)
    BENCH_CPUS      local cores (default 8)
    BENCH_QUERIES   comma-separated keys, or "all" (default: the headline list)
    BENCH_REPEAT    runs per query, the median counts (default 1, after a few warm-up queries)
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
    "documents_build", "metadata_left_join", "distinct_texts", "blob_store_new", "blob_fetch", "scan_jsonl",
    "write_partitioned", "ingest_job", "stream_ingest", "tokenize", "token_windows", "chunk_rows", "chunks_build",
    "merge_sequences", "chunk_context", "docs_by_year_range", "ndjson_export", "embed_hash", "embeddings_build",
    "exact_knn", "exact_search_filtered", "search_with_text", "ivf_assign", "ivf_encode", "ivfpq_search",
    "ivfpq_search_trained", "fts_analyze", "fts_postings", "fts_all_terms", "fts_phrase", "fts_bm25", "fts_page",
]

WARM_UP = ["exact_search_filtered", "fts_all_terms", "ingest_totals"]


def main() -> None:
    from folioloom.registry import QUERIES
    from folioloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    keys = list(QUERIES) if wanted == "all" else [k for k in wanted.split(",") if k] or HEADLINE

    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(key: str) -> float:
        began = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    for key in WARM_UP:
        seconds(key)
    times = {key: round(statistics.median(seconds(key) for _ in range(repeat)), 3) for key in keys}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
