"""The corpora that the registered queries work on, taken from whole tables.

One-sided: the specific corpus is the French documents labelled as good, the general corpus
all other documents. Two-sided: a user turn with the assistant turn that follows it; the
specific corpus is the pairs of conversations that open with a system turn, the general
corpus all other pairs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import fits_broadcast, materialize


class Corpora(NamedTuple):
    general: DataFrame
    specific: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> Corpora:
    """A document with two good labels is in the general corpus twice, if its language is another one;
    one without a language is in neither corpus if it is good."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seg_id"), F.col("text").alias("src"), F.lit("").alias("tgt"), "lang"
    )
    good = table(spark, sf_dir, "labels").filter("quality = 1").groupBy(F.col("doc_id").alias("seg_id"))
    # Ids and languages alone tell which documents do not go to the general corpus as they are, so that no
    # text is shuffled for it. How often one does go there: not if it is French.
    number = F.when(F.col("lang") != "fr", F.col("labels")).otherwise(0).alias("number")
    ids = docs.select("seg_id", "lang").distinct().join(good.agg(F.count(F.lit(1)).alias("labels")), "seg_id")
    marked = materialize(ids.select("seg_id", "lang", number).filter("number <> 1"), "marked")
    few, several = fits_broadcast(marked), marked.filter("number > 1")

    def found(rows: DataFrame, among: DataFrame, how: str) -> DataFrame:
        other = (F.broadcast(among) if few else among).withColumnsRenamed({"seg_id": "id", "lang": "of"})
        return rows.join(other, (F.col("seg_id") == F.col("id")) & F.col("lang").eqNullSafe(F.col("of")), how)

    columns = ["seg_id", "src", "tgt"]
    wanted = found(docs.filter("lang = 'fr'"), marked.filter("lang = 'fr'"), "left_semi").select(*columns)
    rest = found(docs, marked, "left_anti").select(*columns)
    if not several.isEmpty():
        again = found(docs, several, "inner").withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "number")))
        rest = rest.unionByName(again.select(*columns))
    return Corpora(rest, wanted)


def dialogues(spark: SparkSession, sf_dir: str) -> Corpora:
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("src"))
    answered = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt")
    )
    pairs = asked.join(answered, ["conv_id", "turn"]).withColumn(
        "seg_id", F.col("conv_id") * 1000000 + F.col("turn")
    )
    guided = turns.filter("role = 'system'").select("conv_id").distinct()
    columns = ["seg_id", "src", "tgt"]
    return Corpora(
        pairs.join(guided, "conv_id", "left_anti").select(*columns),
        pairs.join(guided, "conv_id", "left_semi").select(*columns),
    )


def segments(pairs: DataFrame, side: str = "src") -> DataFrame:
    return pairs.select("seg_id", F.col(side).alias("text"))
