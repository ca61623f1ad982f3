"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

HEADLINE = ["fusion_candidates", "overlap_join", "nearest_gene", "bin_pairs", "merge_islands", "exonic_coverage", "gene_concordant", "alignment_count", "splice_variants", "entropy", "span_pvalue", "gene_location", "set_cover", "local_align", "best_split", "mapping_stats"]


def main() -> None:
    from pyspark.sql import SparkSession

    from weftline.plans.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["flag_mapped"](spark, sf_dir).count()  # starts the engine, not measured
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(os.path.basename(sf_dir.rstrip("/"))[2:])}))
    spark.stop()


if __name__ == "__main__":
    main()
