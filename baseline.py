"""Time the obvious alternative to this package's text operators: one Python call per row.

No published numbers exist to compare with, so this script rebuilds the usual shape of such a job
(row-at-a-time Python UDFs, and pandas on the driver for the reports) and times it on the same
data. The sentiment part is a plain lexicon sum over the same stand-in lexicon.
"""

from __future__ import annotations

import html
import json
import os
import re
import statistics
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

import bench  # noqa: E402
from newsflow.functions.keywords import STOP_WORDS  # noqa: E402
from newsflow.plans import adapters as A  # noqa: E402

STOP = frozenset(STOP_WORDS)


def tidy(text):
    bare = re.sub("<[^>]+>", "", html.unescape(text or ""))
    bare = " ".join(re.sub(r"(?:http|www)\S+", "", bare).split())
    return re.sub(r"[^\w\s.,!?-]", "", bare)


def best_words(text):
    counted = Counter(w for w in re.findall(r"\b[a-z]{3,}\b", text.lower()) if w not in STOP)
    return ",".join(w for w, _ in counted.most_common(10))


def enrich(title, summary, content):
    whole = " ".join(map(tidy, (title, summary, content)))
    return whole, best_words(whole), len(whole)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = bench.session(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    rows = A.marks_from_documents(spark, sf_dir, False).select("token", "valence").collect()
    lexicon = spark.sparkContext.broadcast({r["token"]: r["valence"] for r in rows})

    def valence_sum(text):
        known = lexicon.value
        return float(sum(known.get(w.strip(".,!?-_").lower(), 0.0) for w in tidy(text).split()))

    enrich_udf = F.udf(enrich, "struct<whole:string,words:string,size:int>")
    articles = A.articles_from_documents(spark, sf_dir)
    documents = A.texts(spark, sf_dir, "documents", "doc_id", "text")
    events = A.processed_from_events(spark, sf_dir)

    def kpis():
        local = events.toPandas()
        local = local[(local.category == "click") & (local.sentiment == "positive")]
        return len(local), local.sentiment_compound.mean(), local.text_length.mean()

    jobs = {
        "clean_text_documents": lambda: bench.run(documents.select(F.udf(tidy)("text"))),
        "article_keywords": lambda: bench.run(
            articles.select(enrich_udf("title", "summary", "content"))
        ),
        "lexicon_sentiment": lambda: bench.run(
            documents.select(F.udf(valence_sum, "double")("text"))
        ),
        "filtered_kpis": kpis,
    }
    seconds = {}
    for name, job in jobs.items():
        job()
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            job()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(json.dumps({"metric": "row-at-a-time shape", "unit": "sec", "queries": seconds}))


if __name__ == "__main__":
    main()
