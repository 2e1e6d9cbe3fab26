"""Samples of a corpus. Cut-offs are found by counting, so no step sorts or gathers rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Buckets per counting pass; each pass brings this many counts to the driver.
BUCKETS = 1 << 16


def nth_smallest(df: DataFrame, column: str, n: int) -> tuple[int, int] | None:
    """The value holding place ``n`` (from 1) of a whole-number column in ascending order.

    Returns the value and how many of the rows that hold it are among the first ``n``;
    None if there are fewer than ``n`` rows. Each pass counts rows in equal buckets and
    keeps the bucket that place ``n`` falls into.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or n < 1:
        return None
    first = True
    while first or low < high:
        first = False
        width = (high - low) // BUCKETS + 1
        bucket = F.expr(f"({column} - {low}) div {width}").alias("bucket")
        counts = df.filter(F.col(column).between(low, high)).groupBy(bucket).count()
        for number, count in sorted((r["bucket"], r["count"]) for r in counts.collect()):
            if n <= count:
                low, high = low + number * width, min(high, low + (number + 1) * width - 1)
                break
            n -= count
        else:
            return None
    return low, n


def sample_first_n(segs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` segments in corpus order, that is by ``seg_id``, empty ones included;
    all of them if the corpus is shorter."""
    if n < 1:
        return segs.filter(F.lit(False))
    cut = nth_smallest(segs.select("seg_id"), "seg_id", n)
    return segs if cut is None else segs.filter(F.col("seg_id") <= cut[0])


def sample_random_n(segs: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` segments, chosen by the order of a seeded hash of ``seg_id``."""
    if n < 1:
        return segs.filter(F.lit(False))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("seg_id").cast("string")))
    # the first 15 hexadecimal digits as a number order like the digest itself
    head = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    heads = segs.select("seg_id", digest.alias("digest"), head.alias("head"))
    cut = nth_smallest(heads, "head", n)
    if cut is None:
        return segs
    value, places = cut
    # rows that share the number at the cut differ in the rest of the digest
    last = (
        heads.filter(F.col("head") == value).orderBy("digest").limit(places)
        .agg(F.max("digest")).first()[0]
    )
    return segs.filter((head < value) | ((head == value) & (digest <= last)))


def top_n(ranked: DataFrame, n: int) -> DataFrame:
    """The ``n`` most in-domain segments of a ranked frame."""
    return ranked.filter(F.col("rank") <= n)
