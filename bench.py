"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Every query is run once to warm up
and then ``BENCH_RUNS`` times; the median is reported.
Results go to a no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from newsflow.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "process_article article_text_pages clean_text_documents clean_text_pages article_keywords "
    "top_terms_per_article term_frequency lexicon_sentiment context_sentiment "
    "lexicon_sentiment_joined category_sentiment_documents top_keywords_documents "
    "feed_registry_join feed_extract_rss decode_article_json dedupe_first_wins "
    "sentiment_distribution category_sentiment top_keywords source_analysis hourly_activity "
    "sentiment_by_category_pivot latest_articles kpis filtered_kpis articles_over_time "
    "dashboard_keywords dashboard_source_stats filtered_latest"
).split()


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("newsflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def once(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(query(spark, sf_dir))
    return time.perf_counter() - start


def timed(query, spark, sf_dir: str, runs: int) -> float:
    once(query, spark, sf_dir)  # to warm up
    taken = [once(query, spark, sf_dir) for _ in range(runs)]
    return round(statistics.median(taken), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(cpus)
    seconds = {}
    for name in chosen:
        seconds[name] = timed(QUERIES[name], spark, sf_dir, runs)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    report = {
        "metric": "headline queries, median of warm runs, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
