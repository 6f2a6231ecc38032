"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "interval_overlap_join", "coverage_depth", "union_length", "extract_features", "clinvar_from_text_to_summary", "annotate_gwas",
    "place_proteins_uniquely", "vcf_normalize_alleles", "methylation_region_means", "methylation_rank_statistics",
    "predict_interactions_unique", "best_homologs", "gene_age", "liftover_intervals",
]


def main() -> None:
    from locusframe.plans.registry import all_queries
    from locusframe.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    registry = all_queries()
    registry[HEADLINE[1]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up, not timed
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
