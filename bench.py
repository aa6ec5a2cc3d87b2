"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brevia.plans.catalog import QUERIES  # noqa: E402
from brevia.session import local_session  # noqa: E402

HEADLINE = (
    "tagged_records",
    "clean_sentences",
    "top_words",
    "term_share",
    "tfidf",
    "doc_vectors_aligned",
    "sentence_scores",
    "top_sentences",
    "topic_term_counts",
    "topic_sentences",
    "jaccard_pairs",
    "kmeans_l1_assign",
    "kmeans_l1_update",
    "lda_corpus_topics",
    "near_dup_sentences",
    "summary_top_rank",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "brevia-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    sf = re.search(r"sf([\d.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
