"""A training corpus from raw documents: five stages, each on what the one before kept.

    quality     documents that the quality classifier rejects go
    duplicates  of every group of near duplicates one document stays
    leaks       documents that hold a benchmark passage go
    mixture     the documents are put in the order that mixes sources by their target weights
    shards      that order is cut into shards of near equal size

Every stage but the last returns the columns of ``documents``. A stage's result is written as
Parquet and read again for the next one, so the lineage ends there; the order of the mixture is
the order in which the rows are stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import FILE, ROW, plain, quoted, stored, with_places
from tamis.llm.decontamination import drop_contaminated
from tamis.llm.jaccard_join import one_of_each
from tamis.llm.mixing import mixed_documents
from tamis.llm.quality import keep_good
from tamis.llm.sharding import ROW_OVERHEAD, shard_by_bytes
from tamis.sources.staging import materialize

SHARDS = 40

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, the document's ``shard`` and its ``slot`` there, in the stored order.

    Only sizes are ordered and summed; the rows themselves are joined to their shards once. A
    column of that name in the documents, in whatever case, is replaced; other columns stay as
    they were, whatever their names.
    """
    kept = docs.select(*[docs[quoted(c)] for c in docs.columns if c.lower() not in ("shard", "slot")])
    inner = plain(kept, "text")
    rows = stored(inner)
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(ROW_OVERHEAD)).cast("long")
    narrow = materialize(rows.select(FILE, ROW, size.alias("__size")), "sizes")
    placed = materialize(shard_by_bytes(narrow, "__size", [FILE, ROW], SHARDS), "shards")
    found = with_places(rows, placed)
    names = [F.col(name).alias(c) for name, c in zip(inner.columns, kept.columns)]
    return found.select(*names, "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("duplicates", duplicates),
    ("leaks", leaks),
    ("mixture", mixture),
    ("shards", shards),
]

# The classifier is learned in floating point from random features: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
