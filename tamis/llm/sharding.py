"""Contiguous shards of near equal size, cut from global prefix sums of bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import PART, SEQ, in_order, text_of, totals_before, utf8_crc32
from tamis.sources.staging import materialize

ROW_OVERHEAD = 16  # bytes a row counts besides its text


def shard_by_bytes(
    rows: DataFrame, size: str, order: Sequence[str], shards: int = 40
) -> DataFrame:
    """Rows with ``shard`` (0 to ``shards - 1``) and ``slot`` (from 0 without gaps in a shard).

    ``rows`` are narrow: what identifies and orders a row, and its ``size`` in bytes, a
    positive long. They are put in order by ranges. Each range is summed, the totals of the
    ranges before it are added, and so every row knows the bytes before it. The row goes to
    the shard whose equal share of all bytes holds the row's middle. A boundary thus misses
    its target by at most half a row, and a shard differs from the equal share by at most
    the size of the largest row.

    Ties in ``order`` are broken by the place in the input; repeated rows are separate rows.
    No rows, no shards. A row larger than a share leaves neighbouring shards empty.
    """
    placed = in_order(rows, list(order), "shard-order")
    before = totals_before(placed, __bytes=size, __rows="*")
    running = W.partitionBy(PART).orderBy(SEQ).rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(size).over(running), F.lit(0))
    middle = f"(2 * (__bytes + __inside) + `{size}`) * {shards} div (2 * all___bytes)"
    numbered = (
        placed.withColumn("__inside", inside)
        .join(before, PART)
        .withColumn("shard", F.expr(f"least({middle}, {shards - 1})").cast("int"))
        .withColumn("__index", F.col("__rows") + F.col(SEQ))
        .select(*rows.columns, "shard", "__index")
    )
    numbered = materialize(numbered, "shards")
    first = numbered.groupBy("shard").agg(F.min("__index").alias("__first"))
    # At most one row per shard.
    return numbered.join(F.broadcast(first), "shard").select(
        *rows.columns, "shard", (F.col("__index") - F.col("__first")).alias("slot")
    )


def document_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``size`` and ``text_crc32`` of every document; a null text has no bytes."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(text_of(text)) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        utf8_crc32(text_of(text)).alias("text_crc32"),
    )


def op1_sharding(docs: DataFrame, shards: int = 40) -> DataFrame:
    """All documents in 40 shards by the law ``bytes``, in ascending order of ``doc_id``.

    Rows with a null id come first. Rows of one id are ordered by the checksum of the text.
    """
    sizes = materialize(document_sizes(docs), "sizes")  # the text is read once
    return shard_by_bytes(sizes, "size", ["doc_id", "text_crc32"], shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
