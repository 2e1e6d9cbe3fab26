"""Clustering around centroids with zone maps along a space-filling curve.

Vectors are put in the order of a Hilbert curve and cut into blocks, so that a block's vectors lie
near each other. A block keeps the smallest and the largest value of each component: its box. From
the box follows which centroids can be the nearest of any vector inside: distances to a box bound
those to its vectors. Vectors are compared with these candidates only, in arrays and exactly; a
block with one candidate is not compared at all, since the sum of its vectors is kept beside the
box. Every round reads the blocks and returns one row of sums per task and centroid.

The curve is drawn by the algorithm of J. Skilling, "Programming the Hilbert curve" (2004).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.llm.common import in_order, named_columns
from tamis.llm.vectors import all_finite, matrix, whole_numbers
from tamis.sources.staging import materialize

WIDTH = 64
FACTOR = 1024
LIMIT = 1 << 24  # of a component's size: squared distances and sums stay exact in 64 bits
CLUSTERS = 8
ROUNDS = 10
SEED = "3:"
BITS = 2  # of a component that the curve looks at
BLOCK = 128  # vectors of a block


def curve_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of rows of cell numbers below ``2 ** bits``: one byte string
    per row, in whose order the curve runs."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1  # bit, component, row
    return np.packbits(planes.reshape(bits * n, -1).T.astype(np.uint8), axis=1)


def candidate_centroids(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """By box and centroid, whether the centroid can be the nearest of a vector in the box, ties
    included; all in whole numbers.

    First the least distance to the box is held against the smallest of all largest distances.
    Then against the centroid with that smallest one: the difference of two squared distances is
    linear in the vector, so its largest value over the box is found component by component.
    """
    below = np.maximum(low[:, None] - centroids, 0)
    above = np.maximum(centroids - high[:, None], 0)
    least = (np.maximum(below, above) ** 2).sum(2)
    most = (np.maximum(abs(centroids - low[:, None]), abs(high[:, None] - centroids)) ** 2).sum(2)
    near = most.argmin(1)
    possible = least <= most.min(1)[:, None]
    # |x - near|^2 - |x - c|^2 = |near|^2 - |c|^2 + 2 x (c - near)
    step = centroids[None] - centroids[near][:, None]
    top = np.maximum(step * low[:, None], step * high[:, None]).sum(2)
    norms = (centroids**2).sum(1)
    return possible & (norms[near][:, None] - norms + 2 * top >= 0)


def nearest(vectors: np.ndarray, of_block: np.ndarray, possible: np.ndarray, centroids: np.ndarray):
    """Number of the nearest centroid of every vector and its squared distance; the smaller number
    of equal ones. ``of_block`` is each vector's row in ``possible``."""
    best = np.zeros(len(vectors), np.int64)
    distance = np.full(len(vectors), np.iinfo(np.int64).max)
    for c in np.flatnonzero(possible.any(0)):
        rows = np.flatnonzero(possible[of_block, c])
        d = ((vectors[rows] - centroids[c]) ** 2).sum(1)
        closer = d < distance[rows]
        best[rows[closer]], distance[rows[closer]] = c, d[closer]
    return best, distance


def blocks_of(vectors: DataFrame, width: int = WIDTH, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``ids``, ``v`` (their vectors, end to end), ``low``, ``high``, ``total`` per block of
    ``vec_id``, ``v``; written.

    Equal vectors may hold any share of the rows: they are spread over the ranges of the order.
    """
    spark = vectors.sparkSession
    ends = vectors.agg(
        F.array(*[F.min(F.col("v")[i]) for i in range(width)]).alias("low"),
        F.array(*[F.max(F.col("v")[i]) for i in range(width)]).alias("high"),
    ).first()
    if ends["low"][0] is None:
        low = high = np.zeros(width, np.int64)
    else:
        low, high = (np.array(ends[c], np.int64) for c in ("low", "high"))
    id_type = vectors.schema["vec_id"].dataType

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), width)
            cells = ((v - low) << bits) // (high - low + 1)
            places = [row.tobytes() for row in curve_places(cells, bits)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.binary())], ["vec_id", "v", "place"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("place", T.BinaryType())])
    ordered = in_order(materialize(vectors.mapInArrow(placed, schema), "places"), ["place"], "curve")
    longs = pa.list_(pa.int64())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, n = matrix(batch.column("v"), width), batch.num_rows
            starts = np.arange(0, n, block)
            edges = np.append(starts, n).astype(np.int32)
            ids = pa.ListArray.from_arrays(edges, batch.column("vec_id"))
            numbers = pa.ListArray.from_arrays(edges * width, pa.array(v.ravel().astype(np.int32)))
            facts = [pa.array(list(f.reduceat(v, starts)), longs) for f in (np.minimum, np.maximum, np.add)]
            yield pa.RecordBatch.from_arrays([ids, numbers, *facts], ["ids", "v", "low", "high", "total"])

    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(id_type)), T.StructField("v", T.ArrayType(T.IntegerType()))]
        + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("low", "high", "total")]
    )
    return materialize(ordered.select("vec_id", "v").mapInArrow(cut, schema), "blocks")


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, every: bool):
    """Of a batch of blocks: its candidates, and the vectors that are compared (``every``: all) with
    the block, the nearest centroid and the distance of each."""
    width = centroids.shape[1]
    possible = candidate_centroids(matrix(batch.column("low"), width), matrix(batch.column("high"), width), centroids)
    sizes = np.diff(batch.column("ids").offsets.to_numpy())
    compared = np.ones(len(sizes), bool) if every else possible.sum(1) > 1
    of_block = np.repeat(np.arange(len(sizes)), sizes)
    used = compared[of_block]
    vectors = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[used].astype(np.int64)
    best, distance = nearest(vectors, of_block[used], possible, centroids)
    return possible, sizes, compared, vectors, best, distance


def round_sums(blocks: DataFrame, centroids: np.ndarray) -> list[tuple[int, list[int]]]:
    """Number of vectors and sum of each component per centroid, as one row for each centroid."""
    k, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            possible, sizes, compared, vectors, best, _ = _assigned(batch, centroids, False)
            np.add.at(n, best, 1)
            np.add.at(total, best, vectors)
            only = possible.argmax(1)[~compared]
            np.add.at(n, only, sizes[~compared])
            np.add.at(total, only, matrix(batch.column("total"), width)[~compared])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k)), pa.array(n), pa.array(list(total), pa.list_(pa.int64()))], ["cluster", "n", "total"]
        )

    parts = blocks.mapInArrow(sums, "cluster long, n long, total array<long>")
    whole = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")
    )
    found = {r.cluster: (r.n, list(r.total)) for r in whole.collect()}  # k rows
    return [found.get(c, (0, [0] * width)) for c in range(k)]


def start_centroids(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors of the smallest hashes of their ids, in the order of the hashes; of equal ids,
    in the order of the vectors. A null id has no hash."""
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = vectors.select(digest.alias("h"), "v").where("h IS NOT NULL").orderBy("h", "v").limit(clusters)
    return np.array([r.v for r in first.collect()], np.int64)


def centroid_clusters(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    width: int = WIDTH,
    factor: int = FACTOR,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: str = SEED,
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``,
    ``centroid_sha256`` of every row whose vector has ``width`` finite components.

    Rows with a null, shorter or longer vector, or with a component that is null or no finite
    number, have no result. Repeated rows count as often as they stand there. A null id is put
    in a cluster, but never starts one. Fewer ids than ``clusters`` give fewer centroids; without
    any, or in an empty table, there is no result. Components from ``LIMIT / factor`` on are an
    error. Other columns are not looked at.
    """
    spark = embeddings.sparkSession
    named = named_columns(embeddings, vec_id=vec_id, x=vector)
    kept = named.where((F.size("x") == width) & all_finite("x"))
    vectors = materialize(kept.select("vec_id", whole_numbers("x", factor, LIMIT).alias("v")), "vectors")
    centroids = start_centroids(vectors, clusters, seed).reshape(-1, width)
    schema = T.StructType(
        [vectors.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )
    if not len(centroids):
        found = spark.createDataFrame([], schema)
        facts = spark.createDataFrame([], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
        return found.join(facts, "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])
    blocks = blocks_of(vectors, width)
    for _ in range(rounds):
        sums = round_sums(blocks, centroids)
        centroids = np.array(
            [[s // n for s in total] if n else list(old) for (n, total), old in zip(sums, centroids.tolist())], np.int64
        )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *_, best, distance = _assigned(batch, centroids, True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids").flatten(), pa.array(best.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    found = materialize(blocks.mapInArrow(assign, schema), "assigned")
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    every = sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, inertia.get(c, 0), every, digests[c]) for c in range(len(digests))],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])


def op13_centroids(embeddings: DataFrame) -> DataFrame:
    """Every vector's cluster after ten rounds from the eight hashed starts."""
    return centroid_clusters(embeddings)
