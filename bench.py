"""Benchmark: run the headline queries on Spark and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8).  Each query is executed in full with the ``noop`` sink (no
collection to the driver); the value is the total wall time in seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import registry  # noqa: E402
from quarry.session import local_session  # noqa: E402

HEADLINE = [
    "f10_pooled_band",          # flagship: conditional aggregate, two windows, exact quantiles
    "e14_dose_error_rates",
    "e26_diagnosis_combinations",
    "d2_enrichment_chain",
    "i3_repeated_blocks",
    "b7_dense_row_key",
    "f5_session_gaps",
    "f3_prior_counts",
    "e37_transitions",
    "e32_feedback_success",
    "n1_item_similarity",
    "m1_hop_distance",
    "j14_word_count_unicode",
    "l2_bigram_phrases",
    "l9_lexicon_polarity",
    "t8_mann_whitney",
    "o18_roc_pr_auc",
    "o15_stratified_folds",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) * 2, app="quarry-bench")
    registry.load_all()
    # warm-up: JVM class loading and code generation paths
    registry.QUERIES["e17_missingness"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
