"""Segment counts, token counts, vocabulary, and masking by vocabulary.

A segment frame has ``seg_id, text``. ``by`` names further key columns (a language side,
a model name); every step then works on all their combinations in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import UNK, tokenize
from ..sources.staging import BROADCAST_BYTES, fits_broadcast, lookup, materialize, spread


def count_segments(segs: DataFrame) -> DataFrame:
    """Number of rows, empty and null texts included, as a one-row frame ``n``."""
    return segs.agg(F.count(F.lit(1)).alias("n"))


def token_counts(segs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Frequency of each token type: ``tok, cnt``."""
    tokens = spread(segs).select(*by, F.explode(tokenize(F.col("text"))).alias("tok"))
    return tokens.groupBy(*by, "tok").agg(F.count(F.lit(1)).alias("cnt"))


def vocab(counts: DataFrame, min_count: int = 2) -> DataFrame:
    """The types seen at least ``min_count`` times."""
    return counts.filter(F.col("cnt") >= min_count)


def vocab_stats(segs: DataFrame, min_count: int = 2) -> DataFrame:
    """One row: ``rows`` of the corpus, token ``types``, and types ``kept`` as vocabulary."""
    zero = F.lit(0).cast("long")
    rows = segs.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", zero.alias("types"), zero.alias("kept")
    )
    types = token_counts(segs).agg(
        zero.alias("rows"),
        F.count(F.lit(1)).alias("types"),
        F.count_if(F.col("cnt") >= min_count).alias("kept"),
    )
    return rows.unionByName(types).agg(*[F.sum(c).alias(c) for c in ("rows", "types", "kept")])


def vocab_lookup(
    segs: DataFrame,
    vocabulary: DataFrame,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every token with its position and whether the vocabulary has it.

    A token frame ``seg_id, pos, tok, known``; a segment without tokens keeps one row, with
    a null token. ``vocabulary`` may carry a subset of ``by``.
    """
    on = [c for c in by if c in vocabulary.columns] + ["tok"]
    words = materialize(vocabulary.select(*on), "vocab")
    tokens = spread(segs).select(*by, "seg_id", F.posexplode_outer(tokenize(F.col("text"))))
    tokens = tokens.withColumnRenamed("col", "tok")
    found = lookup(
        tokens,
        words.withColumn("hit", F.lit(True)),
        on,
        "left",
        broadcast=fits_broadcast(words, broadcast_bytes),
    )
    return found.select(*by, "seg_id", "pos", "tok", F.coalesce("hit", F.lit(False)).alias("known"))


# An array of this many unknown words is looked through, a longer one searched by halves.
FEW = 32


# For an array of less than 2^k values: the steps by which it is searched.
HALVES = [[1 << j for j in range(k - 1, -1, -1)] for k in range(31)]


def _among(words: Column, word: Column) -> Column:
    """Whether a sorted array has the word."""

    def further(place: Column, step: Column) -> Column:
        after = place + step  # null is got beyond the end, and is no smaller word
        return F.when(F.get(words, after - 1) <= word, after).otherwise(place)

    halves = F.array(*[F.array(*map(F.lit, steps)).cast("array<int>") for steps in HALVES])
    steps = F.get(halves, F.length(F.bin(F.size(words))))  # as many as the size has bits
    place = F.aggregate(steps, F.lit(0), further)  # how many are not behind the word
    found = F.coalesce(F.get(words, place - 1) == word, F.lit(False))
    return F.when(F.size(words) <= FEW, F.array_contains(words, word)).otherwise(found)


def masked_words(
    segs: DataFrame,
    vocabulary: DataFrame,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``seg_id, words``: tokens in order, those outside the vocabulary as ``<unk>``.

    A segment looks up each of its distinct tokens once. What is shuffled is its token array, as
    it is, with the tokens that the vocabulary lacks; they are replaced in the array.
    """
    on = [c for c in by if c in vocabulary.columns] + ["tok"]
    known = materialize(vocabulary.select(*on), "vocab")
    words = spread(segs).select(*by, "seg_id", tokenize(F.col("text")).alias("words"))
    # The array goes under a key that is no token, and a different one in each segment.
    no_token = F.concat(F.lit(" "), F.col("seg_id").cast("string"))
    array = F.struct(no_token.alias("tok"), F.col("words").alias("words"))
    nothing = F.lit(None).cast("array<string>")
    tokens = F.transform(
        F.array_distinct("words"), lambda t: F.struct(t.alias("tok"), nothing.alias("words"))
    )
    rows = words.select(*by, "seg_id", F.inline(F.concat(F.array(array), tokens)))
    lacking = lookup(rows, known, on, "left_anti", broadcast=fits_broadcast(known, broadcast_bytes))
    unknown = F.collect_set(F.when(F.col("words").isNull(), F.col("tok")))
    found = lacking.groupBy(*by, "seg_id").agg(
        F.first("words", ignorenulls=True).alias("words"), F.array_sort(unknown).alias("unknown")
    )
    masked = F.transform(
        "words", lambda w: F.when(_among(F.col("unknown"), w), F.lit(UNK)).otherwise(w)
    )
    return found.select(*by, "seg_id", masked.alias("words"))


def mask_oov(
    segs: DataFrame,
    vocabulary: DataFrame,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The segments with every token outside the vocabulary replaced by ``<unk>``."""
    masked = masked_words(segs, vocabulary, by, broadcast_bytes)
    return masked.select(*by, "seg_id", F.array_join("words", " ").alias("text"))


# Numbers of words are packed two to a long.
HALF = 31


def numbered(words: DataFrame) -> DataFrame:
    """``gram, id``: a number from 1 for each distinct word of a table that ``fits_words``; written."""
    distinct = words.select("gram").distinct().coalesce(1)
    number = (F.monotonically_increasing_id() + 1).cast("int").alias("id")
    return materialize(distinct.select("gram", number), "ids")


# Words of one row of a table of words that is broadcast, and what a word costs there beside its
# string: its share of the row's headers and key, a mark, a number, two weights, whether two models have it.
PER_BUCKET = 32
WORD_BYTES = 40


def fits_words(words: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the words in ``gram`` of a written table may be broadcast in ``buckets``, by counting
    them. They may take twice the limit, as little else is broadcast with them."""
    padded = F.ceil(F.octet_length("gram") / 8) * 8
    total = words.agg(F.sum(padded + F.lit(WORD_BYTES))).first()[0]
    return (total or 0) <= 2 * limit


class Buckets(NamedTuple):
    """A table of which each row holds the arrays of some ``PER_BUCKET`` keys and of their values."""

    frame: DataFrame
    key: str
    values: tuple[str, ...]
    by: tuple[str, ...]
    number: int

    def of(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.number)).cast("int").alias("bucket")

    def place(self, key: str) -> Column:
        """Where the arrays have the key, from 0. Strings are searched by their marks, and by themselves
        if another one has the same mark."""
        keys, value = F.col(f"all_{self.key}"), F.col(key)
        place = F.array_position(keys, value).cast("int") - 1
        if "mark" not in self.values:
            return place
        marked = F.array_position("all_mark", mark(key)).cast("int") - 1
        return F.when((marked < 0) | (F.get(keys, marked) == value), marked).otherwise(place)


def mark(word: str) -> Column:
    """A part of the word's hash that its bucket does not follow from."""
    return F.shiftright(F.xxhash64(word), 32).cast("int")


def buckets(
    table: DataFrame, key: str, values: Sequence[str], by: Sequence[str] = (), limit: int = BROADCAST_BYTES
) -> Buckets:
    """A written table that has each key once, ready to be broadcast: a row per key would take
    several times the memory for its headers. Where that fits the limit, rows are kept, which are
    found faster, and the number of buckets is 0."""
    if fits_broadcast(table, limit):
        return Buckets(table, key, tuple(values), tuple(by), 0)
    if table.schema[key].dataType.typeName() == "string":
        table, values = table.withColumn("mark", mark(key)), [*values, "mark"]
    dealt = Buckets(table, key, tuple(values), tuple(by), max(1, table.count() // PER_BUCKET))
    entries = F.array_sort(F.collect_set(F.struct(key, *values))).alias("entries")
    rows = table.groupBy(*by, dealt.of(key)).agg(entries)
    arrays = [F.col(f"entries.{c}").alias(f"all_{c}") for c in (key, *values)]
    return dealt._replace(frame=rows.select(*by, "bucket", *arrays))


def found_in(rows: DataFrame, table: Buckets, name: str) -> DataFrame:
    """The rows with the values of the key in column ``name``, which is dropped; null where there is
    no such key."""
    others = [c for c in rows.columns if c != name]
    if not table.number:
        values = [F.col(c).alias(f"found_{c}") for c in table.values]
        found = F.broadcast(table.frame.select(*table.by, F.col(table.key).alias(name), *values))
        return rows.join(found, [*table.by, name], "left").drop(name)
    joined = rows.withColumn("bucket", table.of(name)).join(
        F.broadcast(table.frame), [*table.by, "bucket"], "left"
    )
    found = [F.get(f"all_{c}", table.place(name)).alias(f"found_{c}") for c in table.values if c != "mark"]
    return joined.select(*others, *found)


def coded(rows: DataFrame, ids: DataFrame, names: Sequence[str]) -> DataFrame:
    """The words in the columns ``names`` replaced by their numbers; null for any other word."""
    table = buckets(ids, "gram", ["id"])
    for name in names:
        rows = found_in(rows, table, name).withColumnRenamed("found_id", name)
    return rows


def decoded(rows: DataFrame, ids: DataFrame, names: Sequence[str]) -> DataFrame:
    """The numbers in the columns ``names`` replaced by their words; null for none."""
    table = buckets(ids, "id", ["gram"])
    for name in names:
        rows = found_in(rows, table, name).withColumnRenamed("found_gram", name)
    return rows


def packed(names: Sequence[str]) -> list[Column]:
    """Columns of numbers below 2^31 as columns ``pair_0``, ``pair_1``, ...; 0 stands for null. Pairs
    are in the order of what they hold."""
    values = [F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")) for name in names]
    values += [F.lit(0).cast("long")] * (len(values) % 2)
    both = zip(values[::2], values[1::2])
    return [F.shiftleft(high, HALF).bitwiseOR(low).alias(f"pair_{k}") for k, (high, low) in enumerate(both)]


def unpacked(names: Sequence[str]) -> list[Column]:
    """What ``packed`` made pairs of, with 0 for null."""
    every = []
    for k, name in enumerate(names):
        pair = F.col(f"pair_{k // 2}")
        half = pair.bitwiseAND((1 << HALF) - 1) if k % 2 else F.shiftright(pair, HALF)
        every.append(half.cast("int").alias(name))
    return every
