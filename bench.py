"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma-separated choice of report names.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from lakesearch.plans import all_reports

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "F1_tag_eq_many_values", "F7_text_eq", "F9_text_fuzzy", "F10_geo_within", "F13_time_between_days", "F19_count", "O3_top_k",
    "V1_knn", "V3_filtered_knn", "V6_range", "V7_batch_knn", "V7_batch_range", "V8_similarity_join_exact", "V8_similarity_join_lsh",
    "V9_ivf_batch_some_lists", "V10_lsh_bands",
    "X1_document_tokens", "X4_ranked_match", "X4_batch_match", "X4_indexed_batch_match", "X6_tfidf", "X9_field_weights",
    "H6_rank_fusion", "H7_linear_fusion", "H9_batch_hybrid",
    "A2_group_by", "A5_count_distinct", "A12_quantile_exact", "A13_to_list", "A14_first_value", "A15_random_sample", "A18_sort_top",
    "S1_bulk_load", "S3_upsert_merge", "S6_expiry", "S7_fetch_many", "S10_profile", "S11_vector_bytes",
    "U2_hashed_vectors", "ST1_stream_load", "ST3_standing_vector",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lakesearch-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='lakesearch-bench-')}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    reports = all_reports()
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    for name in ("V1_knn", "A2_group_by", "X4_ranked_match"):
        reports[name].run(spark, FOLDER).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        reports[name].run(spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
