"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` the timed runs per query after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sahaf.plans import all_queries  # noqa: E402
from sahaf.session import get_session  # noqa: E402

HEADLINE = [
    "search_ip_topk",
    "search_l2_topk",
    "ivf_search",
    "lsh_search",
    "html_to_markdown",
    "tokens",
    "stems",
    "keyword_ngrams",
    "tfidf",
    "tfidf_search",
    "embed_documents",
    "semantic_search",
    "extractive_summary",
    "pair_cosine",
    "keywords_per_doc",
    "citations",
    "contract_quarantine",
    "rows_json_roundtrip",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    every = all_queries()
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            every[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, seconds[name], [round(t, 2) for t in times], file=sys.stderr, flush=True)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
