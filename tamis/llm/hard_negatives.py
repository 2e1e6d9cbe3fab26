"""Hard negatives by coordinate pruning, after LEMP (Teflioudi, Gemulla, Mykytiuk 2015).

Of every anchor the best rows of its own label are its positives; of every positive the best rows
of another label with a score in a band below the positive's are its hard negatives. Both are
searches for the largest inner products of the anchors against all rows.

Rows are sorted by length in their partitions and cut into buckets. A bucket keeps its rows'
directions sorted by each coordinate. An anchor that needs at least a score ``t`` skips a bucket
whose longest row is too short for it. Otherwise a row must lie within an angle of the anchor,
which bounds its coordinates: on the anchor's focus coordinates (the largest of its direction) the
sorted lists give the rows within these bounds, the sets are intersected, and what is left is
verified in whole numbers. The score an anchor needs rises with what a task has found for it.

Anchors are broadcast in rounds of a fixed size, each of which reads all rows; a task returns for
each anchor (and positive) at most as many rows as are asked for. Rows are never paired by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import named_columns
from tamis.llm.vectors import all_finite, matrix, whole_numbers
from tamis.sources.staging import materialize

FACTOR = 256
LIMIT = 1 << 24  # of a component's size, so that five times a score fits 64 bits
LABELS = 10
TOP = 5  # positives of an anchor, and negatives of a positive
LEAST_SHARE = (80, 100)  # of a positive's score that a negative has at least
BUCKET = 1024  # rows
FOCUS = 4  # coordinates
TILE = 512  # anchors compared with a bucket at a time
DENSE = 0.05  # share of a tile's pairs from which on all are verified by one product
ROUND_BYTES = 32 * 1024 * 1024  # of anchors that are broadcast at a time
MARGIN = 1e-9  # for rounding, in bounds only
NONE = np.iinfo(np.int64).min
NEVER = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Found:
    """Rows found for anchors: ``slot`` tells anchor and positive apart."""

    slot: np.ndarray
    score: np.ndarray
    no_id: np.ndarray
    id: np.ndarray
    uid: np.ndarray

    def columns(self) -> list[np.ndarray]:
        return [self.slot, self.score, self.no_id, self.id, self.uid]

    def best(self, other: Found, top: int) -> Found:
        """The ``top`` rows of every slot: by score, then by id, nulls last."""
        slot, score, no_id, ids, uid = (np.concatenate(c) for c in zip(self.columns(), other.columns()))
        order = np.lexsort((uid, ids, no_id, -score, slot))
        at = slot[order]
        first = np.searchsorted(at, at)
        order = order[np.arange(len(at)) - first < top]
        return Found(slot[order], score[order], no_id[order], ids[order], uid[order])

    def least(self, slots: int, top: int) -> np.ndarray:
        """The score a row of each slot needs: that of its last row, if it has enough."""
        need = np.full(slots, NONE)
        n = np.bincount(self.slot, minlength=slots)
        full = np.flatnonzero(n >= top)
        ends = np.cumsum(n) - 1
        need[full] = self.score[ends[full]]
        return need


def nothing() -> Found:
    none = np.zeros(0, np.int64)
    return Found(none, none, none.astype(bool), none, none)


class Anchors:
    """Vectors in whole numbers, their lengths and focus coordinates."""

    def __init__(self, uid: np.ndarray, label: np.ndarray, v: np.ndarray) -> None:
        self.uid, self.label, self.v = uid, label, v
        self.length = np.sqrt((v.astype(np.float64) ** 2).sum(1))
        self.unit = v / np.maximum(self.length, 1e-300)[:, None]
        self.focus = np.argsort(-abs(self.unit), axis=1, kind="stable")[:, :FOCUS]
        self.largest = int(abs(v).max(initial=0))


class Bucket:
    """Rows of similar length, with their directions sorted by each coordinate."""

    def __init__(self, uid: np.ndarray, ids: np.ndarray, no_id: np.ndarray, label: np.ndarray, v: np.ndarray) -> None:
        self.uid, self.id, self.no_id, self.label, self.v = uid, ids, no_id, label, v
        length = np.sqrt((v.astype(np.float64) ** 2).sum(1))
        self.longest = length.max(initial=0.0)
        self.unit = v / np.maximum(length, 1e-300)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.unit, self.order, 0)
        self.largest = int(abs(v).max(initial=0))

    def products(self, anchors: Anchors, which: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Exact scores: of all rows with each of the anchors, or of pairs."""
        small = self.v.shape[1] * self.largest * anchors.largest < 1 << 53
        kind = np.float64 if small else np.int64  # doubles hold such sums exactly
        a, v = anchors.v[which].astype(kind), self.v.astype(kind)
        if rows is None:
            return (a @ v.T).astype(np.int64)
        return np.einsum("ij,ij->i", a, v[rows]).astype(np.int64)

    def pairs(self, anchors: Anchors, which: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``anchor``, ``row``, ``score`` of all pairs of the anchors ``which`` with a score of at
        least what each needs."""
        # The cosine that a row needs; a row that is shorter than the longest needs more.
        cosine = need / np.maximum(anchors.length[which] * self.longest, 1e-300)
        alive = (need <= 0) | (cosine <= 1 + MARGIN)
        alive &= need != NEVER
        which, need, cosine = which[alive], need[alive], cosine[alive]
        if not len(which):
            return which, which, which
        angle = np.where(need > 0, np.arccos(np.clip(cosine, -1, 1)), np.pi)
        n, focus = len(self.uid), anchors.focus[which]
        to_axis = np.arccos(np.clip(np.take_along_axis(anchors.unit[which], focus, 1), -1, 1))
        low = np.cos(np.minimum(to_axis + angle[:, None], np.pi)) - MARGIN
        high = np.cos(np.maximum(to_axis - angle[:, None], 0)) + MARGIN
        start, stop = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            start[at] = np.searchsorted(self.sorted[:, f], low[at], "left")
            stop[at] = np.searchsorted(self.sorted[:, f], high[at], "right")
        narrow = (stop - start).argmin(1)
        own = np.arange(len(which))
        size = np.maximum(stop - start, 0)[own, narrow]
        if size.sum() > DENSE * n * len(which):
            scores = self.products(anchors, which)
            a, row = np.nonzero(scores >= need[:, None])
            return which[a], row, scores[a, row]
        # The shortest list of each anchor, then only rows that are in its other lists too.
        a = np.repeat(own, size)
        place = np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size) + start[a, narrow[a]]
        row = self.order[place, focus[a, narrow[a]]]
        inside = np.ones(len(a), bool)
        for j in range(focus.shape[1]):
            x = self.unit[row, focus[a, j]]
            inside &= (low[a, j] <= x) & (x <= high[a, j])
        a, row = a[inside], row[inside]
        scores = self.products(anchors, which[a], row)
        enough = scores >= need[a]
        return which[a[enough]], row[enough], scores[enough]

    def found(self, slot: np.ndarray, row: np.ndarray, score: np.ndarray) -> Found:
        return Found(slot, score, self.no_id[row], self.id[row], self.uid[row])


def buckets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Bucket]:
    for batch in batches:
        for at in range(0, batch.num_rows, BUCKET):
            part = batch.slice(at, BUCKET)
            ids = part.column("vec_id")
            yield Bucket(
                part.column("uid").to_numpy(),
                ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                np.asarray(ids.is_null()),
                part.column("label").to_numpy(),
                matrix(part.column("v"), width),
            )


def best_positives(anchors: Anchors, given: Iterator[Bucket], top: int) -> Found:
    """Of every anchor the best other rows of its label."""
    best, n = nothing(), len(anchors.uid)
    for bucket in given:
        need = best.least(n, top)
        for at in range(0, n, TILE):
            which = np.arange(at, min(at + TILE, n))
            a, row, score = bucket.pairs(anchors, which, need[which])
            own = (bucket.label[row] == anchors.label[a]) & (bucket.uid[row] != anchors.uid[a])
            best = best.best(bucket.found(a[own], row[own], score[own]), top)
    return best


def best_negatives(
    anchors: Anchors, positives: np.ndarray, given: Iterator[Bucket], top: int, share: tuple[int, int]
) -> Found:
    """Of every anchor and score in its row of ``positives`` (``NEVER`` where it has fewer) the best
    rows of other labels in the band below the score. Slots are ``anchor * columns + column``."""
    best, (n, columns) = nothing(), positives.shape
    part, whole = share
    real = (positives != NEVER) & (positives >= 0)  # the band of a negative score is empty
    least = np.where(real, -(-part * np.where(real, positives, 0) // whole), NEVER)
    for bucket in given:
        need = np.where(real, np.maximum(least, best.least(n * columns, top).reshape(n, columns)), NEVER)
        for at in range(0, n, TILE):
            which = np.arange(at, min(at + TILE, n))
            a, row, score = bucket.pairs(anchors, which, need[which].min(1, initial=NEVER))
            other = bucket.label[row] != anchors.label[a]
            a, row, score = a[other], row[other], score[other]
            for i in range(columns):
                own = (score >= need[a, i]) & (score <= positives[a, i]) & real[a, i]
                best = best.best(bucket.found(a[own] * columns + i, row[own], score[own]), top)
    return best


def prepared(embeddings: DataFrame, vec_id: str, vector: str, label: str, factor: int) -> DataFrame:
    """``uid``, ``vec_id``, ``label``, ``v`` of the rows that take part, written, the longest first in
    every partition. Shorter vectors are filled with zeros."""
    named = named_columns(embeddings, vec_id=vec_id, x=vector, label=label)
    kept = named.where(F.col("label").isNotNull() & all_finite("x"))
    v = whole_numbers("x", factor, LIMIT)
    width = kept.agg(F.max(F.size("x"))).first()[0] or 1
    filled = F.concat("v", F.array_repeat(F.lit(0), F.lit(width) - F.size("v")))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = kept.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), v.alias("v"))
    rows = rows.withColumn("square", square).sortWithinPartitions(F.desc("square"))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", filled.alias("v"))
    return materialize(rows, "vectors")


def hard_negatives(
    embeddings: DataFrame,
    anchors_are: str,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    factor: int = FACTOR,
    top: int = TOP,
    share: tuple[int, int] = LEAST_SHARE,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows for which the SQL condition ``anchors_are`` on ``vec_id`` holds. Rows with
    a null label, a null vector or a component that is null or no finite number take no part. A
    null id comes after all others of its score. Repeated rows are rows of their own: each is an
    anchor, and each may be the other's positive. Vectors of different sizes are compared as if
    filled with zeros. Components from ``LIMIT / factor`` on are an error. An empty table has no
    result. Other columns are not looked at.
    """
    rows = prepared(embeddings, vec_id, vector, label, factor)
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    chosen = rows.where(anchors_are)
    # An anchor's vector, direction, scores and what is found for it, in memory.
    rounds = -(-chosen.count() * (width * 24 + top * top * 40) // round_bytes)
    found = [_one_round(rows, chosen, k, rounds, width, top, share) for k in range(rounds)]
    if not found:
        return rows.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _one_round(rows, chosen, k: int, rounds: int, width: int, top: int, share) -> DataFrame:
    """The result for the anchors of one round, which is bounded by ``round_bytes``. Written."""
    spark = rows.sparkSession
    own = chosen.where(F.pmod(F.xxhash64("uid"), F.lit(rounds)) == k).toArrow().combine_chunks()
    v = own.column("v").combine_chunks()
    anchors = Anchors(own.column("uid").to_numpy(), own.column("label").to_numpy(), matrix(v, width))
    shared = spark.sparkContext.broadcast(anchors)
    schema = "slot long, score long, vec_id long, uid long"
    # Ties of score and id are repeated rows; the number of the row orders them.
    by = [F.desc("score"), F.asc_nulls_last("vec_id"), "uid"]
    place = F.row_number().over(W.partitionBy("slot").orderBy(*by))

    def rows_of(best: Found) -> Iterator[pa.RecordBatch]:
        ids = pa.array(best.id, pa.int64(), mask=best.no_id)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.slot), pa.array(best.score), ids, pa.array(best.uid)], ["slot", "score", "vec_id", "uid"]
        )

    def positive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows_of(best_positives(shared.value, buckets(batches, width), top))

    best = rows.mapInArrow(positive, schema).withColumn("place", place).where(F.col("place") <= top)
    best = materialize(best, "positives")
    scores = np.full((len(anchors.uid), top), NEVER)
    for r in best.select("slot", "place", "score").toArrow().to_batches():  # top rows for each anchor
        scores[r.column("slot").to_numpy(), r.column("place").to_numpy() - 1] = r.column("score").to_numpy()
    positives = spark.sparkContext.broadcast(scores)

    def negative(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows_of(best_negatives(shared.value, positives.value, buckets(batches, width), top, share))

    worst = rows.mapInArrow(negative, schema).withColumn("place", place).where(F.col("place") <= top)
    ids = own.select(["uid", "vec_id"]).append_column("slot", pa.array(np.arange(len(anchors.uid))))
    ids = spark.createDataFrame(ids.select(["slot", "vec_id"]).rename_columns(["anchor", "anchor_id"]))
    of = best.select(
        F.col("slot").alias("anchor"),
        (F.col("slot") * top + F.col("place") - 1).alias("slot"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    # Both are bounded by the anchors of a round.
    of = of.join(F.broadcast(ids), "anchor").drop("anchor")
    result = worst.select(
        "slot",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return materialize(result.join(F.broadcast(of), "slot").select(*columns), "negatives")


def op11_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100. Where the id is divisible by 7, the
    label is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(rows, "vec_id % 100 = 0")
