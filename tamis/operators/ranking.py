"""Attaching scores to text, removing repeats, and ranking.

Order and rank are worked out on narrow rows: an id, a score, and the first bytes of the
text. Whole texts are read only for rows that these do not tell apart, and once at the end,
to attach them to their ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import (
    BROADCAST_BYTES,
    ROW_BYTES,
    bounded,
    checksums,
    fits_broadcast,
    lookup,
    materialize,
    rows_before,
)
from .sampling import nth_smallest

# Bytes of text in one step of the sort path.
CHUNK = 48
# Rows that agree on score and path, and bytes of their texts, up to which one task orders
# them by their whole text.
TIE_ROWS = 100_000
TIE_BYTES = 64 * 1024 * 1024
# Columns that identify and order a pair without its text, from ``fingerprints``.
PRINTS = ("print", "path", "size")
CHECKS = ("check_low", "check_high")


def build_scored_pairs(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """``seg_id, score, src, tgt``: scores joined to the texts they belong to."""
    return pairs.join(scores, "seg_id").select("seg_id", "score", "src", "tgt")


align_text = build_scored_pairs


def dedup_ranked(scored: DataFrame) -> DataFrame:
    """One row per distinct score and texts, with the smallest ``seg_id``.

    Texts are told apart by their digests, and copies are combined before the shuffle, so a
    text repeated in a large part of the corpus sends one narrow row per input task.
    """
    prints = scored.select("seg_id", "score", _digest().alias("print"))
    kept = prints.groupBy("score", "print").agg(F.min("seg_id").alias("seg_id")).select("seg_id")
    return scored.join(kept, "seg_id", "left_semi").select("seg_id", "score", "src", "tgt")


def _directed(columns: Sequence[str], ascending: bool) -> list[Column]:
    return [F.col(c).asc() if ascending else F.col(c).desc() for c in columns]


def _bytes(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def sort_ranked(scored: DataFrame, ascending: bool = False) -> DataFrame:
    """Best first: by score, ties by source, then target text; descending unless told.

    For frames that are to be written as they are; ``rank`` orders narrow rows instead.
    """
    return scored.orderBy(*_directed(("score", "src", "tgt"), ascending))


def _digest() -> Column:
    src, tgt = (F.coalesce(F.col(c), F.lit("")) for c in ("src", "tgt"))
    return F.unhex(F.sha2(F.concat(F.octet_length(src).cast("string"), F.lit(":"), src, tgt), 256))


def fingerprints(pairs: DataFrame) -> DataFrame:
    """The pairs with ``print``, a digest that identifies the two texts, ``path``, the first
    bytes of the source as the start of a sort path, and ``size``, the bytes of both texts."""
    size = F.octet_length(_bytes("src")) + F.octet_length(_bytes("tgt"))
    return pairs.select(
        "*",
        _digest().alias("print"),
        F.substring(_bytes("src"), 1, CHUNK).alias("path"),
        size.cast("long").alias("size"),
    )


def _split_point(low: str, high: str) -> Column:
    """The first byte (from 1) at which two different binary values differ."""
    digits = [F.split(F.hex(F.col(c)), "") for c in (low, high)]
    same = F.zip_with(*digits, lambda x, y: x.eqNullSafe(y))
    return ((F.array_position(same, False) + 1) / 2).cast("int")


def _tie_groups(keys: DataFrame) -> DataFrame:
    return keys.groupBy("score", "path").agg(
        F.count(F.lit(1)).alias("ties"), F.sum("size").alias("bytes")
    )


def _large(tie_rows: int) -> Column:
    return (F.col("ties") > 1) & ((F.col("ties") > tie_rows) | (F.col("bytes") > TIE_BYTES))


def _split_hot_ties(
    keys: DataFrame, pairs: DataFrame, tie_rows: int, broadcast_bytes: int
) -> DataFrame:
    """Lengthen the path of rows in groups that agree on score and path and are too large.

    Within such a group the texts agree up to the point where its smallest and largest
    differ; the bytes from there on are the next step of the path. Every round splits each
    group, and texts are distinct, so this ends.
    """
    on = ["score", "path"]
    hot = materialize(_tie_groups(keys).filter(_large(tie_rows)).select(*on), "hot")
    few = fits_broadcast(hot, broadcast_bytes)
    chosen = materialize(lookup(keys, hot, on, "left_semi", broadcast=few), "hot-keys")
    texts = pairs.select("seg_id", _bytes("src").alias("src"), _bytes("tgt").alias("tgt"))
    # Read twice, so written.
    members = materialize(
        lookup(texts, chosen, ["seg_id"], broadcast=fits_broadcast(chosen, broadcast_bytes)), "hot-texts"
    )
    ends = [f(c).alias(f"{c}_{name}") for c in ("src", "tgt") for name, f in (("low", F.min), ("high", F.max))]
    by_tgt = F.col("src_low") == F.col("src_high")
    at = F.when(by_tgt, _split_point("tgt_low", "tgt_high"))
    at = at.otherwise(_split_point("src_low", "src_high"))
    splits = members.groupBy(*on).agg(*ends).select(*on, by_tgt.alias("by_tgt"), at.alias("at"))
    splits = materialize(splits, "splits")
    text = F.when(F.col("by_tgt"), F.col("tgt")).otherwise(F.col("src"))
    chunk = F.substring(text, F.col("at"), F.lit(CHUNK))
    longer = F.concat("path", F.array(chunk)).alias("path")
    split = lookup(members, splits, on, broadcast=few).select("seg_id", "score", longer, "size")
    rest = lookup(keys, hot, on, "left_anti", broadcast=few)
    return materialize(rest.unionByName(split), "keys")


def _place_ties(
    keys: DataFrame, pairs: DataFrame, ascending: bool, tie_rows: int, broadcast_bytes: int
) -> DataFrame:
    """Add ``place``, the order by whole text among rows that agree on score and path."""
    on = ["score", "path"]
    while True:
        found = _tie_groups(keys).agg(
            F.max("ties").alias("most"), F.count_if(_large(tie_rows)).alias("large")
        ).first()
        if (found["most"] or 0) <= 1:
            return keys.withColumn("place", F.lit(1))
        if not found["large"]:
            break
        keys = _split_hot_ties(keys, pairs, tie_rows, broadcast_bytes)
    groups = _tie_groups(keys).filter(F.col("ties") > 1).select(*on)
    tied = materialize(keys.join(groups, on, "left_semi"), "tied")
    order = W.partitionBy(*on).orderBy(*_directed(("src", "tgt"), ascending))
    texts = pairs.select("seg_id", "src", "tgt")
    texts = lookup(texts, tied, ["seg_id"], broadcast=fits_broadcast(tied, broadcast_bytes))
    places = texts.select("seg_id", F.row_number().over(order).alias("place"))
    return keys.join(places, "seg_id", "left").withColumn("place", F.coalesce("place", F.lit(1)))


def dense_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows 1, 2, ... in a total order, without gathering them in one task."""
    return numbered(df.repartitionByRange(*order).sortWithinPartitions(*order), name)


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """Number the rows of a range-partitioned and sorted frame 1, 2, ... as ``index``.

    Each partition's rows are numbered where they are, and partitions are told how many rows
    lie before them. The offsets are one row per partition.
    """
    marked = materialize(ordered.withColumn("mark", F.monotonically_increasing_id()), name)
    part = F.shiftright("mark", 33)
    sizes = marked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    offsets = sizes.select("part", rows_before("size", "part").alias("skip"))
    row = F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    found = lookup(
        marked.withColumn("part", part), offsets, ["part"], broadcast=bounded(marked.sparkSession)
    )
    return found.select(*ordered.columns, (F.col("skip") + row + 1).alias("index"))


def rank_keys(
    keyed: DataFrame,
    pairs: DataFrame,
    ascending: bool = False,
    top: int | None = None,
    tie_rows: int = TIE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``seg_id, score, rank`` of what remains of ``keyed`` (``seg_id, score`` and ``PRINTS``,
    one row per pair) when repeats are dropped; the first ``top`` only if given. Scores of other
    ids than those of the pairs are an error.

    With ``top``, the score that holds that place is found by counting; rows beyond it are
    dropped before anything is ordered.
    """
    tally = {"copies": F.count(F.lit(1)), **dict(zip(CHECKS, checksums("seg_id")))}
    kept = keyed.groupBy("score", *PRINTS).agg(
        F.min("seg_id").alias("seg_id"), *[of.alias(name) for name, of in tally.items()]
    )
    keys = materialize(
        kept.select("seg_id", "score", F.array("path").alias("path"), "size", *tally), "keys"
    )
    rows = keys.agg(*[F.sum(name).alias(name) for name in tally]).first()
    expected = pairs.agg(*[of.alias(name) for name, of in tally.items()]).first()
    if [n or 0 for n in rows] != [n or 0 for n in expected]:
        same = rows["copies"] == expected["copies"]
        raise ValueError(
            f"{expected['copies']} pairs, {rows['copies'] or 0} scores" + ", but not of the same ids" * same
        )
    keys = keys.drop(*tally)
    if top is not None:
        # A millionth of a score as a whole number: equal or neighbouring scores share one.
        worse = F.floor(F.col("score") * (1_000_000 if ascending else -1_000_000)).cast("long")
        cut = nth_smallest(keys.select(worse.alias("worse")), "worse", top) if top > 0 else None
        if top < 1:
            keys = keys.filter(F.lit(False))
        elif cut is not None:
            keys = materialize(keys.filter(worse <= cut[0]), "best-keys")
    placed = _place_ties(keys, pairs, ascending, tie_rows, broadcast_bytes).drop("size")
    order = [*_directed(("score", "path"), ascending), F.col("place").asc()]
    index = dense_index(placed, order, "ranks").select("seg_id", "score", F.col("index").alias("rank"))
    return index if top is None else index.filter(F.col("rank") <= top)


def rank_ids(
    pairs: DataFrame,
    scores: DataFrame,
    ascending: bool = False,
    tie_rows: int = TIE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    top: int | None = None,
) -> DataFrame:
    """``seg_id, score, rank`` of the pairs that remain when repeats are dropped.

    A pair without a score is an error.
    """
    no_score = F.raise_error(F.concat(F.lit("no score for segment "), F.col("seg_id")))
    score = F.when(F.col("score").isNotNull(), F.col("score")).otherwise(no_score.cast("double"))
    prints = fingerprints(pairs.select("seg_id", "src", "tgt")).select("seg_id", *PRINTS)
    keyed = prints.join(scores.select("seg_id", "score"), "seg_id", "left").select(
        "seg_id", score.alias("score"), *PRINTS
    )
    return rank_keys(keyed, pairs, ascending, top, tie_rows, broadcast_bytes)


def rank(
    scored: DataFrame,
    ascending: bool = False,
    tie_rows: int = TIE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``rank, score, seg_id, src, tgt``: repeats removed, best first from rank 1."""
    pairs = scored.select("seg_id", "src", "tgt")
    scores = scored.select("seg_id", "score")
    return attach_ranks(pairs, rank_ids(pairs, scores, ascending, tie_rows, broadcast_bytes))


def attach_ranks(
    pairs: DataFrame,
    ranks: DataFrame,
    top: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ranked pairs, or the first ``top`` of them.

    A rank occurs once, so ``top`` bounds the rows: few enough are sent to the texts, and
    the texts are not shuffled at all.
    """
    if top is not None:
        ranks = ranks.filter(F.col("rank") <= top)
        if top * ROW_BYTES <= broadcast_bytes:
            ranks = F.broadcast(ranks)
    return pairs.join(ranks, "seg_id").select("rank", "score", "seg_id", "src", "tgt")
