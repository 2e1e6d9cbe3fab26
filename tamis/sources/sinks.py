"""Writing ranked corpora, masked training text, and models."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import sample_first_n
from ..operators.vocabulary import mask_oov
from .staging import checksums, materialize

PART_BYTES = 128 * 1024 * 1024  # of text in a part file


def _one_line(text: str) -> Column:
    # a row is one line in the output
    return F.regexp_replace(F.col(text), "\r\n|\r|\n", " ")


def write_lines(df: DataFrame, key: str, text: str, path: str, mode: str = "error") -> None:
    """Write one text column, one row per line, so that part files in name order are in the
    order of ``key``. The frame is read twice, for the ranges and for the rows: it should be a
    written one."""
    ordered = df.select(key, _one_line(text).alias("value"))
    ordered = ordered.repartitionByRange(key).sortWithinPartitions(key)
    ordered.select("value").write.mode(mode).option("lineSep", "\n").text(path)


def _located(spark: SparkSession, path: str):
    """A path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    found, files = _located(spark, path)
    return files.exists(found)


def _delete(spark: SparkSession, path: str) -> None:
    found, files = _located(spark, path)
    files.delete(found, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    old, files = _located(spark, source)
    if not files.rename(old, _located(spark, target)[0]):
        raise OSError(f"cannot move {source} to {target}")


def _replaced(spark: SparkSession, moves: list[tuple[str, str]], aside: str) -> None:
    """Rename each written folder to its final name, all of them or none: what stood under the
    final names is put aside before, and put back if one rename fails."""
    done: list[tuple[str, str]] = []
    try:
        for number, (_, target) in enumerate(moves):
            if _exists(spark, target):
                _rename(spark, target, f"{aside}-{number}")
                done.append((target, f"{aside}-{number}"))
        for source, target in moves:
            _rename(spark, source, target)
            done.append((source, target))
    except Exception:
        for back, from_ in reversed(done):
            _rename(spark, from_, back)
        raise
    for number in range(len(moves)):
        _delete(spark, f"{aside}-{number}")


def write_ranked(
    ranked: DataFrame,
    dest: str,
    src_lang: str,
    tgt_lang: str,
    mode: str = "error",
    parts: int | None = None,
    parquet: bool = False,
) -> None:
    """Write ``general_corpus_sorted.<lang>`` for both sides, and the ranked rows as Parquet if
    asked.

    Part files in name order are in rank order, and the two sides are aligned line by line,
    part by part. The rows are written as they come, which also tells their number and size;
    then both sides are dealt into parts by rank, in one shuffle and one job. Without ``parts``
    there are as many as make files of ``PART_BYTES``. Both sides take the place of earlier ones
    together: if one can't, both earlier ones stay.
    """
    if src_lang == tgt_lang:
        raise ValueError("the two sides need different names")
    if mode not in ("error", "overwrite"):
        raise ValueError(f"unknown mode: {mode!r}")
    spark = ranked.sparkSession
    name = f"{dest.rstrip('/')}/general_corpus_sorted"
    for lang in (src_lang, tgt_lang):
        if mode == "error" and _exists(spark, f"{name}.{lang}"):
            raise FileExistsError(f"{name}.{lang} exists")
    lines = [F.struct(F.lit(c).alias("side"), _one_line(c).alias("value")) for c in ("src", "tgt")]
    if parquet:
        ranked.write.mode(mode).parquet(f"{name}.parquet")
        kept = spark.read.schema(ranked.schema).parquet(f"{name}.parquet")
    else:
        kept = materialize(ranked.select("rank", "src", "tgt"), "ranked")
    size = F.octet_length(F.coalesce("src", F.lit(""))) + F.octet_length(F.coalesce("tgt", F.lit("")))
    found = kept.agg(F.max("rank").alias("rows"), F.sum(size.cast("long")).alias("bytes")).first()
    rows = found["rows"] or 0
    parts = parts or max(1, -(-(found["bytes"] or 0) // (2 * PART_BYTES)))
    # Ranks run from 1 without gaps, so equal parts follow from the rank itself.
    part = F.expr(f"(rank - 1) div {max(1, -(-rows // parts))}").cast("int")
    dealt = kept.repartitionById(parts, part).select("rank", F.inline(F.array(*lines)))
    # Sorted as the writer wants it, side by side, so that it does not sort again.
    written = f"{name}.writing-{uuid.uuid4().hex}"
    dealt.sortWithinPartitions("side", "rank").select("side", "value").write.partitionBy("side").option(
        "lineSep", "\n"
    ).text(written)
    for side in ("src", "tgt"):
        if not rows:
            kept.select(F.lit("").alias("value")).write.text(f"{written}/side={side}")
    moves = [(f"{written}/side={side}", f"{name}.{lang}") for side, lang in (("src", src_lang), ("tgt", tgt_lang))]
    try:
        _replaced(spark, moves, f"{name}.aside-{uuid.uuid4().hex}")
    finally:
        _delete(spark, written)


def write_filtered_text(
    segs: DataFrame, vocabulary: DataFrame, dest: str, n: int | None = None, mode: str = "error"
) -> int:
    """Write the segments with tokens outside the vocabulary as ``<unk>``, one per line in
    corpus order, the first ``n`` only if given. Returns the number of lines."""
    if n is not None:
        segs = sample_first_n(segs, n)
    # Worked out once; ordering and counting read what was written.
    masked = materialize(mask_oov(segs, vocabulary), "masked")
    write_lines(masked, "seg_id", "text", dest, mode)
    return masked.count()


def save_model(model: DataFrame, path: str, mode: str = "error") -> None:
    """Keep a model frame; models of several corpora or sides go to folders of their own."""
    keys = [c for c in ("model", "side") if c in model.columns]
    writer = model.write.mode(mode)
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@dataclass(frozen=True)
class Models:
    """The models of both corpora and what they were trained with."""

    frame: DataFrame
    order: int
    min_count: int
    closed: bool

    @property
    def sides(self) -> tuple[str, ...]:
        rows = self.frame.select("side").distinct().collect()  # two at most
        return tuple(s for s in ("src", "tgt") if (s,) in map(tuple, rows))


def _contents(models: DataFrame) -> list[list]:
    """For each model, side and order the number of grams and an order-free checksum of their rows;
    that of the specific model's first order tells its vocabulary. At most two rows per order
    and side."""
    parts = checksums("gram", "logp", "bow", "weight")
    found = models.groupBy("model", "side", "n").agg(F.count(F.lit(1)).alias("rows"), *parts)
    return sorted([list(row) for row in found.collect()], key=str)


MANIFEST = "_manifest"  # readers of the models pass over names like this


def save_models(models: Models, path: str, mode: str = "error") -> None:
    """Keep the models of both corpora, with a manifest that ``load_models`` checks them by."""
    if mode == "overwrite":
        _delete(models.frame.sparkSession, f"{path}/{MANIFEST}")
    save_model(models.frame, path, mode)
    spark = models.frame.sparkSession
    # What is read back counts, so that a fault of the store shows up here.
    facts = {
        "order": models.order,
        "min_count": models.min_count,
        "closed": models.closed,
        "contents": _contents(load_model(spark, path)),
    }
    lines = spark.createDataFrame([(json.dumps(facts),)], "value string")
    lines.coalesce(1).write.text(f"{path}/{MANIFEST}")


def load_models(spark: SparkSession, path: str) -> Models:
    """Models kept by ``save_models``. Without a manifest, or if the rows are not those that it
    tells of, an error: writing was not finished, or something was changed."""
    if not _exists(spark, f"{path}/{MANIFEST}"):
        raise FileNotFoundError(f"no manifest of models in {path}")
    facts = json.loads(spark.read.text(f"{path}/{MANIFEST}").first()[0])
    frame = load_model(spark, path)
    if _contents(frame) != facts.pop("contents"):
        raise ValueError(f"{path}: the models are not those that the manifest tells of")
    return Models(frame, **facts)
