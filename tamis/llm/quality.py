"""A quality score for texts: kernel ridge regression on document statistics, calibrated.

Random Fourier features approximate a Gaussian kernel over standardised statistics of a text.
Their normal equations are summed per partition and over partitions, so the fit sees every
labelled row and costs the same memory at any size. Isotonic regression on labelled rows kept
back from the fit turns raw scores into probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import fold_of, plain, restored
from tamis.llm.words import texts
from tamis.sources.staging import materialize

FOLDS = 5
HELD_OUT = 0  # this fold's labels are never read
CALIBRATION = 4  # this fold's labels calibrate; the others' labels fit
THRESHOLD = 0.3
FEATURES = 256
BANDWIDTH = 2.5  # of the kernel, for inputs scaled to unit variance
RIDGE = 1e-4  # per labelled row
BINS = 2000  # raw scores from -0.5 to 1.5 are counted in so many bins for the calibration
SEED = 20

STATISTICS = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "longest_word",
    "upper",
    "digits",
    "spaces",
    "sentence_marks",
    "exclamations",
    "bars",
    "other_marks",
    "beyond_ascii",
    "distinct_words",
    "top_word",
    "same_as_before",
    "distinct_pairs",
    "marked_words",
    "log_lines",
    "distinct_lines",
    "log_line_words",
)


def statistics(text: str | None) -> list[float]:
    """The numbers of ``STATISTICS`` for one whole text. Shares of nothing are 0."""
    data = (text or "").encode()
    words = data.split()
    n, m = max(len(data), 1), max(len(words), 1)
    octets = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    counts = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    k = max(len(lines), 1)
    upper, digits, spaces = octets[65:91].sum(), octets[48:58].sum(), octets[32] + octets[9:14].sum()
    marks = octets[46] + octets[44]
    printable = octets[33:48].sum() + octets[58:65].sum() + octets[91:97].sum() + octets[123:127].sum()
    other = printable - marks - octets[33] - octets[124]
    letters = max(upper + octets[97:123].sum(), 1)
    ends = sum(not (w[-1:].isalnum() or w[-1] > 127 or w[-1] in b".,") for w in words)
    return [
        float(np.log1p(len(data))),
        float(np.log1p(len(words))),
        len(data) / m,
        float(np.log1p(max(map(len, words), default=0))),
        upper / letters,
        digits / n,
        spaces / n,
        marks / n,
        octets[33] / n,
        octets[124] / n,
        other / n,
        octets[128:].sum() / n,
        len(counts) / m,
        max(counts.values(), default=0) / m,
        sum(a == b for a, b in zip(words, words[1:])) / m,
        len(set(zip(words, words[1:]))) / m,
        ends / m,
        float(np.log1p(len(lines))),
        len(set(lines)) / k,
        float(np.log1p(m / k)),
    ]


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the array ``x`` of statistics of every text."""
    source = f"c{keep.index(text)}" if text in keep else "t"
    inner = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)],
        *([] if text in keep else [F.col(text).alias(source)]),
    )
    schema = ", ".join(
        [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
        + ["x array<double>"]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([statistics(t) for t in texts(batch, source)], pa.list_(pa.float64()))
            n = len(keep)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], x], [*batch.schema.names[:n], "x"])

    out = inner.mapInArrow(measure, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "x")


@dataclass(frozen=True)
class Fourier:
    """Standardisation and random Fourier features; the last feature is constant."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    offsets: np.ndarray

    @classmethod
    def drawn(cls, mean: np.ndarray, scale: np.ndarray) -> Fourier:
        rng = np.random.default_rng(SEED)
        directions = rng.normal(0, 1 / BANDWIDTH, (len(mean), FEATURES))
        return cls(mean, scale, directions, rng.uniform(0, 2 * np.pi, FEATURES))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.directions + self.offsets
        return np.hstack([np.cos(z) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, len(STATISTICS))


def vectors(rows: np.ndarray | list[np.ndarray]) -> pa.Array:
    return pa.array(list(rows), pa.list_(pa.float64()))


@dataclass(frozen=True)
class Classifier:
    features: Fourier
    weights: np.ndarray
    raw: np.ndarray  # the calibration is linear between these raw scores
    level: np.ndarray

    def raw_scores(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, 0 to 1. A thousandth of the raw score orders texts of equal level."""
        raw = self.raw_scores(x)
        return 0.999 * np.interp(raw, self.raw, self.level) + 0.001 * np.clip(raw, 0, 1)


def isotonic(raw: np.ndarray, count: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins sorted by raw score; each pool's mean score and level."""
    pools: list[list[float]] = []  # count, sum of labels, sum of raw scores
    for r, n, s in zip(raw, count, total):
        pools.append([n, s, r * n])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return (
        np.array([p[2] / p[0] for p in pools]),
        np.array([p[1] / p[0] for p in pools]),
    )


def fit(measured: DataFrame, labels: DataFrame) -> Classifier:
    """The classifier from documents (``doc_id``, ``x``) and labels (``doc_id``, ``quality``).

    Only folds other than ``HELD_OUT`` are read. Several labels of one document are averaged,
    null ones ignored. Without labels every text scores one half.
    """
    k = len(STATISTICS)
    moments = measured.select(
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k)],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(k)],
    ).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(k)])
    features = Fourier.drawn(mean, np.where(scale > 1e-9, scale, 1.0))

    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("y"))
    fold = fold_of(F.col("doc_id"), FOLDS)
    labelled = materialize(
        measured.join(known, "doc_id")
        .select("x", "y", fold.alias("fold"))
        .where((F.col("fold") != HELD_OUT) & (F.col("fold") >= 0)),
        "labelled",
    )

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 1
        sums = np.zeros((size, size + 1))
        for batch in batches:
            z = features(matrix(batch))
            y = np.asarray(batch.column("y"))
            sums += z.T @ np.column_stack([z, y])
        part = pa.array([TaskContext.get().partitionId()] * size, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), part, vectors(sums)], ["i", "part", "v"])

    def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            parts = np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, FEATURES + 2)
            for i, v in zip(batch.column("i").to_pylist(), parts):
                sums[i] = sums[i] + v if i in sums else v.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), vectors(list(sums.values()))], ["i", "v"])

    # One row per feature and partition, added up per feature as they stream by, in the order of
    # the partitions, so that a task that runs again gets the same sums. The driver gets one matrix.
    parts = labelled.where(F.col("fold") != CALIBRATION).mapInArrow(
        partial_sums, "i int, part int, v array<double>"
    )
    dealt = parts.repartition("i").sortWithinPartitions("i", "part").select("i", "v")
    rows = dealt.mapInArrow(added_up, "i int, v array<double>").collect()
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    for row in rows:
        system[row.i] = row.v
    left, right = system[:, :-1], system[:, -1]
    n = left[-1, -1]
    weights = np.linalg.solve(left + np.eye(len(left)) * max(RIDGE * n, 1e-9), right)

    unfit = Classifier(features, weights, np.array([0.0]), np.array([0.5]))

    def raw_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(unfit.raw_scores(matrix(batch)), -0.5, 1.5)
            bins = np.minimum(((raw + 0.5) * (BINS / 2)).astype(np.int32), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y")], ["bin", "y"])

    binned = (
        labelled.where(F.col("fold") == CALIBRATION)
        .mapInArrow(raw_scores, "bin int, y double")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("y").alias("s"))
        .collect()  # at most BINS rows
    )
    if not binned or not n:
        return unfit
    binned = np.array(sorted((r.bin, r.n, r.s) for r in binned))
    centres = (binned[:, 0] + 0.5) / (BINS / 2) - 0.5
    return Classifier(features, weights, *isotonic(centres, binned[:, 1], binned[:, 2]))


def score(measured: DataFrame, model: Classifier) -> DataFrame:
    """``x`` replaced by ``score``."""
    keep = [c for c in measured.columns if c != "x"]
    schema = ", ".join([f"{c} {measured.schema[c].dataType.simpleString()}" for c in keep] + ["score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(model.scores(matrix(batch)) if batch.num_rows else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], found], [*keep, "score"])

    return measured.select(*keep, "x").mapInArrow(run, schema)


def op6_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The score of every document, empty and null texts (equal to empty) included.

    Rows that share an id are scored each by its own text. A null id belongs to no fold.
    """
    measured = materialize(with_statistics(docs, "text", ["doc_id"]), "statistics")
    scored = score(measured, fit(measured, labels))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their columns as they were, whatever their
    names.

    The model is fitted from statistics written once; a second pass over the documents scores
    and filters them where they are, so no text is shuffled.
    """
    measured = materialize(with_statistics(docs, "text", ["doc_id"]), "statistics")
    model = fit(measured, labels)
    inner, text = plain(docs, "text"), "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in texts(batch, text)]).reshape(-1, len(STATISTICS))
            good = model.scores(x) >= THRESHOLD if len(x) else np.zeros(0, bool)
            yield batch.filter(pa.array(good, pa.bool_()))

    return restored(inner.mapInArrow(run, inner.schema), inner, docs)
