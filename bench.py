"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every query runs in full:
its rows go to Spark's no-op sink, so that nothing is pruned and nothing collected. Each
time is the median of ``BENCH_RUNS`` runs (3), none of which finds anything kept by another.
"""

import json
import os
import statistics
import time

from corpuslens.plans.registry import queries
from corpuslens.plans.session import local_session

HEADLINE = (
    "word_count",
    "meta_extract",
    "metadata_coverage",
    "tokenize",
    "tfidf",
    "top_tfidf",
    "doc_norms",
    "top_similar",
    "top_pairs",
    "similarity_pair_count",
    "author_extract",
    "degree_combined",
    "network_stats",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, partitions=int(cores))
    registered = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        spark.catalog.clearCache()
        return seconds

    run("token_count")  # starts the JVM's compilers and reads the files' footers
    seconds = {
        name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in HEADLINE
    }
    report = {
        "metric": f"headline queries, median of {runs} runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory).removeprefix("sf"),
    }
    print(json.dumps(report), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
