"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` (optional,
comma separated) the queries. Each query is built and run to the end through the no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from lisan.plans.queries import QUERIES

HEADLINE = [
    "corpus_counts",
    "en_sentences",
    "en_word_tokens",
    "wordpunct_tokens",
    "token_offsets",
    "normalize_arabic",
    "top_tokens",
    "positional_split",
    "everygrams",
    "lm_scores",
    "en_perplexity",
    "ar_perplexity",
    "generate_greedy",
    "generate_sample",
    "en_pos_table",
    "train_lexicon",
    "context_rules",
    "np_chunks",
    "gazetteer_entities",
    "pattern_entities",
    "bio_spans",
    "top_entities",
    "token_labels",
    "token_labels_by_char",
    "prf1_ner",
    "confusion_pos",
    "summary_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/documents.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
