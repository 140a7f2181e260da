"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topicloom.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "p1_p6_clean_text",
    "g16_language_id",
    "g17_embed_text",
    "a1_dedupe",
    "a8_ctfidf",
    "g11_topic_fit",
    "w2_sample_titles",
    "g18_label_topics",
    "j8_knn_exact",
    "j9_knn_ivf",
    "g13_reduce_outliers",
    "j12_outliers_centroid",
    "g1_fuzzy_graph",
    "g5_mst_edges",
    "g7_hdbscan",
    "g15_hierarchy",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["j8_knn_exact"](spark, folder).limit(1).count()  # start the JVM and Python workers
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
