"""Headline timings on ``$BENCH_SF_DIR`` with ``$BENCH_CPUS`` cores; prints one JSON line.

Every query runs once to warm up and then three times; the median counts. Results are
written to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.catalog.corpora import dialogues, documents, segments
from tamis.operators.ngram_model import train_lm
from tamis.operators.ranking import attach_ranks, rank_ids
from tamis.operators.scoring import score_lm
from tamis.operators.vocabulary import token_counts, vocab
from tamis.plans import select as P
from tamis.sources.staging import materialize

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))  # one machine
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    docs, pairs = documents(spark, SF_DIR), dialogues(spark, SF_DIR)
    wanted = segments(docs.specific)

    def words() -> DataFrame:
        return vocab(token_counts(wanted))

    models = P.train_models(*docs, ("src",)).drop("side")
    specific, general = (
        models.filter(F.col("model") == m).drop("model") for m in ("specific", "general")
    )
    scored = score_lm(segments(docs.general), specific, general)
    scores = materialize(
        scored.select("seg_id", F.round(scored.logp_s - scored.logp_g, 6).alias("score")), "scores"
    )
    timed = {
        "vocab": lambda: consume(words()),
        "train_lm": lambda: consume(train_lm(wanted, words())),
        "score_lm": lambda: consume(score_lm(segments(docs.general), specific, general)),
        "rank": lambda: consume(attach_ranks(docs.general, rank_ids(docs.general, scores))),
        "select_documents": lambda: consume(P.select(*docs, rank_tgt=False)),
        "select_dialogues": lambda: consume(P.select(*pairs)),
    }
    seconds = {}
    for name, run in timed.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    result = {
        "metric": "total of query medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "spark": spark.version,
        "segments_per_sec": round(docs.general.count() / seconds["score_lm"], 1),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
