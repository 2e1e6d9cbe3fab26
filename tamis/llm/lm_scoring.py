"""Log-likelihoods of whole texts under word counts and under a gated recurrent model.

Word counts come from all training documents. The recurrent model knows every word whose share
of the counts is at least ``LEAST_SHARE``, so its vocabulary follows the corpus; any other word
is its unknown token, times the word's share of all such words by the counts.

It is trained on every training document once. The documents are dealt by hashes to replicas and
rounds. In a round each replica trains on its documents, in the order of their hashes, from the
same weights, and the replicas' changes are averaged, by tokens. How many replicas there are
follows from the number of tokens, not from tasks or files, so the model depends on the rows only,
and a replica has as many tokens in a large corpus as in a small one, or more.

A dictionary of the ``HEAD`` most frequent words, or of all that the model knows, is broadcast.
The counts of other words are found by a join on the words that each document has left over.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm import recurrent as R
from tamis.llm.common import fold_of
from tamis.llm.words import spaced_words, texts
from tamis.sources.staging import materialize

FOLDS = 5
HELD_OUT = 1
HEAD = 60_000  # words in the broadcast dictionary, if the model does not know more
# Share of all training tokens from which on the model knows a word. No corpus has more words of
# that share than its inverse, which bounds the model.
LEAST_SHARE = 1e-6
LEAST_COUNT = 5  # in small corpora: words seen less often are what the unknown token learns from
BLOCK = 8192  # weights in a row when the changes of replicas are averaged
REPLICA_TOKENS = 8_000_000  # so many training tokens make a replica of their own
REPLICAS = 1024  # at most; beyond, replicas get more tokens each. Bounds what a round shuffles
ROUNDS = 4
END_WORD = b""  # no word is empty; the end of a text is counted under it
HELD_WORDS = 400_000  # distinct words a counting task holds before it hands them on
GIVEN_LOG = np.log(10.0)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``word`` (binary), ``c``: all words of all rows and one end each, counted in the task
    before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "c"]
            )

        for batch in batches:
            for value in texts(batch, "t"):
                held.update(spaced_words(value))
                held[END_WORD] += 1
                if len(held) > HELD_WORDS:
                    yield handed_on()
                    held.clear()
        yield handed_on()

    partial = docs.select(F.col(text).alias("t")).mapInArrow(count, "word binary, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def least_count(tokens: int) -> float:
    """From which on the model knows a word."""
    return max(LEAST_COUNT, LEAST_SHARE * tokens)


def head_of(counts: DataFrame, size: int = HEAD) -> tuple[list[bytes], np.ndarray]:
    """At most ``size`` of the most frequent words, or all from ``least_count`` on if those are
    more, by falling count, and their counts.

    Words are cut at a step of a sixteenth power of two in the count, found by counting words
    per step; nothing is sorted, and only the head reaches the driver.
    """
    step = F.floor(F.log2("c") * 16).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(
        F.count("*").alias("n"), F.sum("c").alias("tokens"), F.max("c").alias("most")
    ).collect()
    least = least_count(sum(row["tokens"] for row in steps))
    cut, held = None, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        held += row["n"]
        if held > size and row["most"] < least:
            break
        cut = row["step"]
    if cut is None:
        return [], np.zeros(0)
    head = counts.where(step >= cut).toArrow()
    pairs = sorted(zip(head.column("c").to_pylist(), head.column("word").to_pylist()), key=lambda p: (-p[0], p[1]))
    return [w for _, w in pairs], np.array([c for c, _ in pairs], np.float64)


class Vocabulary:
    """The head of the counts: for each word its place by frequency, its count, its token."""

    def __init__(self, words: list[bytes], counts: np.ndarray, tokens: int, types: int) -> None:
        if END_WORD not in words:  # no training document
            words, counts = [*words, END_WORD], np.append(counts, 0.0)
        self.place = {w: i for i, w in enumerate(words)}
        self.logs, self.seen = np.log10(counts + 0.5), counts > 0
        self.base = np.log10(tokens + 0.5 * (types + 1))
        # Tokens of the model: END, UNKNOWN, then words by frequency; as many as the smallest
        # model has room for, or as are frequent enough.
        least = least_count(tokens)
        ranked = [i for i, w in enumerate(words) if w != END_WORD]
        model = [i for at, i in enumerate(ranked) if at < R.SIZE - 2 or counts[i] >= least]
        self.token = np.full(len(words) + 1, R.UNKNOWN, np.int32)  # the last is for place -1
        self.token[model] = np.arange(2, 2 + len(model))
        self.token[self.place[END_WORD]] = R.END
        known = counts[model].sum() + 0.5 * len(model)
        end = counts[self.place[END_WORD]] + 0.5
        # What the counts leave for all words without a token, the unseen one included.
        rest = max(tokens + 0.5 * (types + 1) - known - end, 0.5)
        self.rest = np.log10(rest)
        shares = np.zeros(2 + len(model))
        shares[2 : 2 + len(model)] = counts[model] + 0.5
        shares[R.END], shares[R.UNKNOWN] = end, rest
        self.shares = shares / shares.sum()
        self.edges = R.class_edges(self.shares)

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of every word, -1 beyond the head; with the end."""
        words.append(END_WORD)
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int32, len(words))


def replicas_for(tokens: int) -> int:
    """Replicas that a corpus of so many training tokens is dealt to."""
    return min(REPLICAS, max(1, -(-tokens // REPLICA_TOKENS)))


def trained(docs: DataFrame, vocabulary, start: R.Parameters, replicas: int) -> R.Parameters:
    """The model after all rounds on ``docs`` (``doc_id``, ``t``)."""
    spark = docs.sparkSession
    values, edges = R.flat(start), vocabulary.value.edges
    place = F.xxhash64("doc_id", "t")
    dealt = docs.select("t", place.alias("place"), F.pmod(place, F.lit(replicas)).cast("int").alias("replica"))

    def mean_of(changes: pa.Table) -> pa.Table:
        """Of one block of weights: one row for each replica, summed in their order."""
        changes = changes.sort_by("replica")
        n = changes.column("n").to_numpy()
        blocks = zip(changes.column("v"), n / n.sum())
        v = sum(np.frombuffer(x.as_py(), np.float16).astype(np.float64) * m for x, m in blocks)
        return pa.table({"i": changes.column("i")[:1], "v": pa.array([v.astype(np.float32).tobytes()], pa.binary())})

    for k in range(ROUNDS):
        weights = spark.sparkContext.broadcast(values)

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, common = vocabulary.value, R.shaped(weights.value, edges)
            trainer, current = None, None

            def change() -> pa.RecordBatch:
                trainer.learn()
                out = (R.flat(trainer.p) - weights.value).astype(np.float16)
                blocks = [out[at : at + BLOCK].tobytes() for at in range(0, len(out), BLOCK)]
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(len(blocks), dtype=np.int32)),
                        pa.array(np.full(len(blocks), current, np.int32)),
                        pa.array(blocks, pa.binary()),
                        pa.array(np.full(len(blocks), float(trainer.seen))),
                    ],
                    ["i", "replica", "v", "n"],
                )

            for batch in batches:
                for replica, value in zip(batch.column("replica").to_pylist(), texts(batch, "t")):
                    if replica != current:
                        if trainer:
                            yield change()
                        trainer, current = R.Trainer(common, edges), replica
                    trainer.add(known.token[known.places(spaced_words(value))])
            if trainer:
                yield change()

        of_round = dealt.where(F.pmod(F.shiftrightunsigned("place", 32), F.lit(ROUNDS)) == k)
        ordered = of_round.repartitionById(replicas, F.col("replica")).sortWithinPartitions("replica", "place")
        parts = ordered.select("replica", "t").mapInArrow(train, "i int, replica int, v binary, n double")
        # One row per block of weights of the model, however many replicas there were.
        mean = parts.groupBy("i").applyInArrow(mean_of, "i int, v binary").toArrow().sort_by("i")
        if mean.num_rows:
            values = values + np.frombuffer(b"".join(mean.column("v").to_pylist()), np.float32)
        weights.unpersist()
    return R.shaped(values, edges)


def score_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` of every row, whole texts; the models learn from all folds but ``held_out``.

    A null text is empty and has its end only. A null id is in no fold: it is scored, and not
    learned from. Repeated rows count and learn as often as they stand there; those of one id and
    text do so in one replica. Without any training document all counts are 0, and the model stays
    as it is initialised. A text is one sequence however long it is. Other columns are not read,
    whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), fold_of(F.col(doc_id), folds).alias("fold")
    )
    learned = (F.col("fold") != held_out) & (F.col("fold") >= 0)
    counts = materialize(word_counts(rows.where(learned), "t"), "word-counts")
    sums = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    vocabulary = Vocabulary(*head_of(counts), sums.n, sums.v)
    shared = spark.sparkContext.broadcast(vocabulary)
    model = trained(rows.where(learned), shared, R.initial(vocabulary.shares), replicas_for(sums.n))
    weights = spark.sparkContext.broadcast(R.flat(model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, p = shared.value, R.shaped(weights.value, shared.value.edges)
        for batch in batches:
            sequences, out = [], []
            for value in texts(batch, "t"):
                found = spaced_words(value)
                places = known.places(found)
                tokens = known.token[places]
                in_head = places >= 0
                logs = known.logs[places[in_head]]
                rare = Counter(found[i] for i in np.flatnonzero(~in_head))
                sequences.append(tokens)
                out.append(
                    {
                        "n_tokens": len(tokens),
                        "n_head": int(known.seen[places[in_head]].sum()),
                        "head_log": float(logs.sum()),
                        "n_unknown": int((tokens == R.UNKNOWN).sum()),
                        "unknown_log": float(logs[tokens[in_head] == R.UNKNOWN].sum()),
                        "rare": list(rare.keys()),
                        "times": list(rare.values()),
                    }
                )
            model_log = R.log_likelihoods(p, known.edges, sequences) / GIVEN_LOG
            kind = pa.struct(
                [("n_tokens", pa.int64()), ("n_head", pa.int64()), ("head_log", pa.float64())]
                + [("n_unknown", pa.int64()), ("unknown_log", pa.float64())]
                + [("rare", pa.list_(pa.binary())), ("times", pa.list_(pa.int64()))]
            )
            parts = pa.array(out, kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("fold"), *parts.flatten(), pa.array(model_log)],
                ["doc_id", "fold", *kind.names, "model_log"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(
        score,
        f"doc_id {id_type}, fold int, n_tokens long, n_head long, head_log double, n_unknown long,"
        " unknown_log double, rare array<binary>, times array<long>, model_log double",
    ).withColumn("uid", F.monotonically_increasing_id())
    scored = materialize(scored, "scored")
    # Words beyond the head: one row per document and word, to their counts and back.
    left_over = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("z")).select(
        "uid", F.col("z.rare").alias("word"), F.col("z.times").alias("times")
    )
    c = F.coalesce("c", F.lit(0))
    found = (
        left_over.join(counts, "word", "left")
        .groupBy("uid")
        .agg(
            F.sum(F.col("times") * F.log10(c + 0.5)).alias("rare_log"),
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("n_rare"),
        )
    )
    nothing = F.lit(0.0)
    rare_log = F.coalesce("rare_log", nothing)
    return scored.join(found, "uid", "left").select(
        "doc_id",
        (F.col("fold") == held_out).alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(sums.n).cast("long").alias("train_tokens"),
        (F.col("head_log") + rare_log - F.col("n_tokens") * F.lit(float(vocabulary.base))).alias("base_score"),
        (
            F.col("model_log")
            + F.col("unknown_log")
            + rare_log
            - F.col("n_unknown") * F.lit(float(vocabulary.rest))
        ).alias("score"),
    )


def op8_lm(docs: DataFrame) -> DataFrame:
    """Every document's log10 probability by the counts and by the recurrent model."""
    return score_texts(docs)
