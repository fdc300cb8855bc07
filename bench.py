"""Seconds per headline query; prints one JSON line.

Every query runs over its whole tables and its full result goes to Spark's noop sink, so nothing
is pruned away and nothing is brought to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusloom.catalog import all_queries
from corpusloom.session import build_session

HEADLINE = """
token_counts vocab_top_k wiki_clean basic_tokens_lower in_vocab wordpiece merge_pair_counts word_scores
train_spacing char_ngrams cooccurrence_harmonic pmi top_collocates tfidf sentence_mean tag_vectors
most_similar analogy_accuracy nearest_label features_right_pad mask_tokens masked_pair_examples
sentence_stream batchify lm_windows running_perplexity
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)), "spark.ui.enabled": "false",
            "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in wanted:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
