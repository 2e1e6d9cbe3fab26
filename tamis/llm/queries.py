"""The registered queries of this package, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tamis.llm.centroids import op13_centroids
from tamis.llm.decontamination import op2_decontamination
from tamis.llm.fingerprints import op3_fingerprints
from tamis.llm.hard_negatives import op11_hard_negatives
from tamis.llm.jaccard_join import op5_jaccard_join
from tamis.llm.licenses import op4_licenses
from tamis.llm.lm_scoring import op8_lm
from tamis.llm.mixing import op10_mixing
from tamis.llm.quality import op6_quality
from tamis.llm.secrets import op9_secrets
from tamis.llm.sharding import op1_sharding
from tamis.llm.urls import op7_urls
from tamis.llm.warc import op12_warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES: dict[str, Query] = {
    "op1_sharding": lambda s, d: op1_sharding(table(s, d, "documents")),
    "op2_decontamination": lambda s, d: op2_decontamination(
        table(s, d, "documents"), table(s, d, "benchmark")
    ),
    "op3_fingerprints": lambda s, d: op3_fingerprints(table(s, d, "documents")),
    "op4_licenses": lambda s, d: op4_licenses(table(s, d, "documents")),
    "op5_jaccard_join": lambda s, d: op5_jaccard_join(table(s, d, "documents")),
    "op6_quality": lambda s, d: op6_quality(table(s, d, "documents"), table(s, d, "labels")),
    "op7_urls": lambda s, d: op7_urls(table(s, d, "pages")),
    "op8_lm": lambda s, d: op8_lm(table(s, d, "documents")),
    "op9_secrets": lambda s, d: op9_secrets(table(s, d, "documents")),
    "op10_mixing": lambda s, d: op10_mixing(table(s, d, "documents")),
    "op11_hard_negatives": lambda s, d: op11_hard_negatives(table(s, d, "embeddings")),
    "op12_warc": lambda s, d: op12_warc(table(s, d, "pages")),
    "op13_centroids": lambda s, d: op13_centroids(table(s, d, "embeddings")),
    "pipeline": corpus_pipeline.run,
}
