"""Times the headline queries and prints one JSON line.

Each query runs over its whole tables and all its rows are computed. ``rates`` are documents or reports per second for
"""

from __future__ import annotations

import json
import os
import signal
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.queries import catalog  # noqa: E402
from ledgerlens.session import local_session  # noqa: E402

HEADLINE = [
    "lexicon_sentiment_by_segment",
    "lexicon_sentiment_rows",
    "lexicon_sentiment_documents",
    "sentiment_from_counts",
    "replace_numbers",
    "clean_text",
    "clean_sentences",
    "filter_sentences",
    "process_text",
    "financial_metrics",
    "stat_features",
    "text_stats",
    "describe_target",
    "score_hist",
    "stratified_split",
    "content_hash",
    "vocab_topk",
    "dtm_long",
    "tfidf_long",
    "topic_top_words",
    "umass_coherence",
    "doc_top_topics",
    "class_word_freq",
    "classification_report",
    "regression_metrics",
    "roc_auc",
    "keyword_topics",
    "text_scoring",
    "plugin_sentiment",
    "lda_topics",
    "svd_features",
    "nmf_topics",
    "lasso_fit",
    "lasso_search",
    "word2vec_docs",
    "feature_bundle",
    "full_job",
    "cross_validate",
    "tune_topics",
    "classifiers",
    "training_job",
]
# Seconds after which no further query is begun; what is left out is named.
TIME_BUDGET = 1200
# Query -> table whose rows are the documents of the rate.
RATES = {
    "clean_sentences": "documents",
    "lexicon_sentiment_rows": "orders",
    "tfidf_long": "documents",
    "lda_topics": "documents",
    "financial_metrics": "orders",
    "full_job": "orders",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores), memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["clean_text"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times, rates, began = {}, {}, time.perf_counter()

    def report(left_out: list[str]) -> None:
        line = {
            "metric": "headline query seconds",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": times,
            "rates": rates,
            "left_out": left_out,
            "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        }
        print(json.dumps(line), flush=True)

    def stop(*_) -> None:
        report([n for n in wanted if n not in times])
        os._exit(0)

    # The one line comes out even when a query runs into the limit of whoever runs this.
    signal.signal(signal.SIGTERM, stop)
    watch = threading.Timer(TIME_BUDGET + 300, stop)
    watch.daemon = True
    watch.start()
    for name in wanted:
        start = time.perf_counter()
        if start - began > TIME_BUDGET:
            break
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        if name in RATES:
            rows = spark.read.parquet(f"{folder}/{RATES[name]}.parquet").count()
            rates[name] = round(rows / times[name], 1)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    watch.cancel()
    report([n for n in wanted if n not in times])


if __name__ == "__main__":
    main()
