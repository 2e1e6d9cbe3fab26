"""Interpolated Kneser-Ney n-gram models, trained by grouped aggregation and equi-joins.

Every function takes ``by``, the columns that tell several models in one frame apart, so
the models of both corpora and both language sides are trained by the same jobs.

A model frame has ``n, gram, logp, bow, weight``. ``logp`` and ``bow`` are the usual log10
probability and back-off weight. ``weight`` restates them so that a segment's total log10
probability is a plain sum over the grams that occur in it, see ``scoring``.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import (
    BOS,
    EOS,
    ORDER,
    SYMBOLS,
    UNK,
    context_of,
    endings,
    gram_ending,
    grams_ending,
    pad_sentence,
    skip_symbols,
    suffix_of,
)
from ..sources.staging import BROADCAST_BYTES, ROW_BYTES, localize, lookup, materialize, row_bytes, short_rows, spread
from . import coded
from .vocabulary import coded as coded_words
from .vocabulary import HALF, decoded, fits_words, masked_words, numbered, packed

# Discounts for adjusted counts 1, 2 and 3 or more where an order's own
# counts do not yield valid ones.
FALLBACK = (0.5, 1.0, 1.5)
# Words of a sentence up to which sentences of numbers are short rows.
SHORT_SENTENCE = 1 << 16


def ngram_counts(
    sentences: DataFrame, order: int = ORDER, by: Sequence[str] = (), words: str = "words"
) -> DataFrame:
    """Raw counts ``n, gram, cnt`` of the padded token arrays in column ``words``."""
    ends = sentences.select(*by, F.inline(endings(pad_sentence(F.col(words)), order)))
    grams = ends.select(*by, F.inline(grams_ending(order=order)))
    return (
        grams.filter(F.col("gram").isNotNull())
        .groupBy(*by, "n", "gram")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def adjusted_counts(counts: DataFrame, order: int = ORDER, by: Sequence[str] = ()) -> DataFrame:
    """``n, gram, a``: the raw count for grams of the highest order and for those that begin
    a sentence; for all others the number of distinct tokens seen before them.

    Each gram hands one to its own suffix, so a single aggregation serves all orders.
    """
    own = F.when(
        ((F.col("n") == order) | F.col("gram").startswith(BOS + " ")) & (F.col("gram") != BOS),
        F.struct("n", "gram", F.col("cnt").alias("a")),
    )
    to_suffix = F.when(
        F.col("n") > 1,
        F.struct(
            (F.col("n") - 1).alias("n"),
            suffix_of().alias("gram"),
            F.lit(1).cast("long").alias("a"),
        ),
    )
    parts = F.array_compact(F.array(own, to_suffix))
    return counts.select(*by, F.inline(parts)).groupBy(*by, "n", "gram").agg(F.sum("a").alias("a"))


def word_ids(words: DataFrame) -> DataFrame:
    """Numbers ``gram, id`` of the column ``gram`` and of what a sentence is padded with; written."""
    padding = words.sparkSession.range(1).select(F.explode(F.array(F.lit(BOS), F.lit(EOS))).alias("gram"))
    return numbered(words.select("gram").unionByName(padding))


def sentence_counts(
    sentences: DataFrame,
    order: int = ORDER,
    by: Sequence[str] = (),
    ids: DataFrame | None = None,
    spelled: bool = True,
) -> DataFrame:
    """Written adjusted counts ``n, gram, a`` of ``words``, as ``adjusted_counts`` of ``ngram_counts``,
    for sentences without reserved symbols, which ``training_sentences`` drops.

    What is shuffled is the longest gram that ends at each token, with copies combined before,
    and then what is distinct of them by the last two words. All grams of two words or more that
    end in these are in one partition then. Sorted from the last word backwards, those that share
    an ending are neighbours, and each order is counted on the rows of the next longer one. With ``ids``
    of all words, which may be broadcast, words are shuffled as numbers, two in a long; ``words`` may
    be numbers then, and the result has grams as numbers if they are not to be ``spelled``.
    """
    if ids is not None:
        found = _numbered_counts(sentences, order, by, ids)
        return _spelled(found, order, by, ids) if spelled else found
    words = [f"t{k}" for k in range(order)]
    padded = sentences.select(*by, F.inline(endings(pad_sentence(F.col("words")), order)))
    # The start symbol alone is no gram of a model, and the last entries lie past the end.
    ends = padded.filter(F.col("t0").isNotNull() & F.col("t1").isNotNull())
    end, start = words[:2], F.lit(BOS)
    rows = ends.groupBy(*by, *words).agg(F.count(F.lit(1)).alias("cnt")).repartition(*by, *end)
    rows = rows.withColumn(f"first_{order}", F.lit(True)).withColumn(f"a_{order}", F.col("cnt"))
    for n in range(order - 1, 1, -1):
        same = W.partitionBy(*by, *end, *words[2:n])
        longer = F.sum(F.col(f"first_{n + 1}").cast("long")).over(same)
        # A gram that begins a sentence keeps its count, any other has one for each token before it.
        a = F.when(F.col(words[n - 1]) == start, F.col("cnt")).otherwise(longer)
        rows = rows.withColumn(f"a_{n}", a)
        rows = rows.withColumn(f"first_{n}", F.row_number().over(same.orderBy(*words[n:])) == 1)
    grams = [
        F.when(
            F.col(words[n - 1]).isNotNull() & F.col(f"first_{n}"),
            F.struct(F.lit(n).alias("n"), gram_ending(n).alias("gram"), F.col(f"a_{n}").alias("a")),
        )
        for n in range(2, order + 1)
    ]
    one = F.lit(1).cast("long").alias("a")
    last = F.when(F.col("first_2"), F.struct(F.lit(1).alias("n"), F.col("t0").alias("gram"), one))
    found = materialize(rows.select(*by, F.inline(F.array_compact(F.array(last, *grams)))), "adjusted", ["n"])
    single = found.filter(F.col("n") == 1).groupBy(*by, "n", "gram").agg(F.sum("a").alias("a"))
    return found.filter(F.col("n") > 1).unionByName(materialize(single, "adjusted-words"))


def _sorted_pairs(rows: DataFrame, by: Sequence[str], pairs: Sequence[str]) -> DataFrame:
    """Grams with the same first pair of words in one task, in the order of all their words."""
    return rows.repartition(pairs[0], *by).sortWithinPartitions(pairs[0], *by, *pairs[1:])


def _fields(rows: DataFrame, names: Sequence[str]) -> str:
    """A schema of columns that are kept as they are."""
    return "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in names)


def _key_of(by: Sequence[str], keys: Sequence[tuple]) -> Column:
    """The place of a row's key among the given ones. What tells models apart is one number, which
    costs less to sort by and to carry along."""
    key = F.lit(None).cast("int")
    for k, values in enumerate(keys):
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, values)]
        key = F.when(reduce(lambda x, y: x & y, same, F.lit(True)), F.lit(k)).otherwise(key)
    return key.alias("key")


def _values_of(frame: DataFrame, by: Sequence[str], keys: Sequence[tuple]) -> list[Column]:
    """The columns ``by``, as ``frame`` has them, from the place of the key."""
    every = [F.array(*[F.lit(values[at]) for values in keys]) for at in range(len(by))]
    return [F.get(e, F.col("key")).cast(frame.schema[c].dataType).alias(c) for e, c in zip(every, by)]


def _numbered_counts(sentences: DataFrame, order: int, by: Sequence[str], ids: DataFrame) -> DataFrame:
    """``n, pair_0, pair_1, ..., a``: adjusted counts, the words of a gram and ``n`` packed."""
    symbols = dict(ids.filter(F.col("gram").isin(BOS, EOS)).collect())
    start, end = symbols[BOS], symbols[EOS]
    pairs = coded.pairs_of(order)
    packed_fields = ", ".join(f"{p} long" for p in pairs)
    # One row per model, and what its longest sentence has.
    found = sentences.groupBy(*by).agg(F.max(F.size("words")).alias("longest")).collect()
    keys = [tuple(r[c] for c in by) for r in found] or [(None,) * len(by)]
    if sentences.schema["words"].dataType.simpleString() == "array<int>":
        kept = sentences.select(_key_of(by, keys), "words")
        ends = kept.mapInArrow(coded.sentence_endings(order, ["key"], start, end), f"key int, {packed_fields}")
    else:
        words = [f"t{k}" for k in range(order)]
        padded = sentences.select(_key_of(by, keys), F.inline(endings(pad_sentence(F.col("words")), order)))
        ends = padded.filter(F.col("t0").isNotNull() & F.col("t1").isNotNull())
        ends = coded_words(ends, ids, words).select("key", *packed(words))
    counted = ends.groupBy("key", *pairs).agg(F.count(F.lit(1)).alias("cnt"))
    schema = "key int, n int, " + ", ".join(f"{p} long" for p in coded.pairs_of(order + 1)) + ", a long"
    rows = _sorted_pairs(counted, ["key"], pairs).mapInArrow(coded.counted_endings(order, ["key"], start), schema)
    short = all((r["longest"] or 0) <= SHORT_SENTENCE for r in found)
    with short_rows(sentences.sparkSession) if short else nullcontext():
        found = materialize(rows, "adjusted")
        key = ["key", "n", *coded.pairs_of(order + 1)]
        single = found.filter(F.col("n") == 1).groupBy(*key).agg(F.sum("a").alias("a"))
        found = found.filter(F.col("n") > 1).unionByName(materialize(single, "adjusted-words"))
    return found.select(*_values_of(sentences, by, keys), *key[1:], "a")


def _spelled(counts: DataFrame, order: int, by: Sequence[str], ids: DataFrame) -> DataFrame:
    """``n, gram, a`` of counts of numbers."""
    schema = f"{_fields(counts, by)}n int, gram string, a long"
    return counts.mapInArrow(coded.spelled(coded.shared(ids), order, by), schema)


def tallies(adjusted: DataFrame, by: Sequence[str] = (), ids: DataFrame | None = None) -> DataFrame:
    """``n, t1, t2, t3, t4, size``: grams with adjusted count 1, 2, 3 and 4, and bytes; for counts of
    numbers as if all words were the longest one."""
    size = row_bytes(adjusted)
    if ids is not None:
        longest = ids.agg(F.max(F.octet_length("gram"))).first()[0]
        size = F.lit(ROW_BYTES) + F.when(F.col("n") > 1, F.col("n") * longest).otherwise(0).cast("long")
    return adjusted.groupBy(*by, "n").agg(
        *[F.count_if(F.col("a") == k).alias(f"t{k}") for k in (1, 2, 3, 4)],
        F.sum(size).alias("size"),
    )


def discounts(
    adjusted: DataFrame, fallback: Sequence[float] = FALLBACK, by: Sequence[str] = ()
) -> DataFrame:
    """``n, d1, d2, d3`` from the numbers of grams with adjusted count 1, 2, 3 and 4.

    An order where one of the first three numbers is zero, or where a discount is not
    within (0, k], takes all three values of ``fallback``. (A discount of zero would leave a
    context no mass to back off with, and that mass has no logarithm.)
    """
    return _discounts(tallies(adjusted, by), fallback, by)


def _discounts(tallied: DataFrame, fallback: Sequence[float], by: Sequence[str]) -> DataFrame:
    t = {k: F.col(f"t{k}") for k in (1, 2, 3, 4)}
    d = {k: F.col(f"e{k}") for k in (1, 2, 3)}
    valid = reduce(
        lambda x, y: x & y,
        [t[k] > 0 for k in (1, 2, 3)] + [(d[k] > 0) & (d[k] <= k) for k in (1, 2, 3)],
    )
    y = tallied.withColumn("y", F.try_divide(t[1].cast("double"), t[1] + 2 * t[2]))
    estimated = y.select(
        *by,
        "n",
        *t.values(),
        *[
            (k - F.try_divide((k + 1) * F.col("y") * t[k + 1], t[k])).alias(f"e{k}")
            for k in (1, 2, 3)
        ],
    )
    return estimated.select(
        *by,
        "n",
        *[
            F.when(valid, d[k]).otherwise(F.lit(float(fallback[k - 1]))).alias(f"d{k}")
            for k in (1, 2, 3)
        ],
    )


def _with_discounts(frame: DataFrame, disc: DataFrame, by: Sequence[str]) -> DataFrame:
    # bounded: one row per order and model
    return frame.join(F.broadcast(disc), [*by, "n"])


def context_stats(adjusted: DataFrame, disc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per context ``n, ctx, s, b``: total adjusted count and back-off weight.

    The discounted mass is summed as three integer counts, so it does not depend on the
    order in which rows arrive.
    """
    totals = _context_totals(adjusted, by, context_of())
    mass = F.expr("(d1 * n1 + d2 * n2 + d3 * n3) / s")
    return _with_discounts(totals, disc, by).select(*by, "n", "ctx", "s", mass.alias("b"))


def _context_totals(adjusted: DataFrame, by: Sequence[str], context: Column) -> DataFrame:
    return adjusted.groupBy(*by, "n", context.alias("ctx")).agg(
        F.sum("a").alias("s"),
        F.count_if(F.col("a") == 1).alias("n1"),
        F.count_if(F.col("a") == 2).alias("n2"),
        F.count_if(F.col("a") >= 3).alias("n3"),
    )


def _terms(adjusted: DataFrame, disc: DataFrame, by: Sequence[str]) -> DataFrame:
    discount = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2"))
    return _with_discounts(adjusted, disc, by).select(
        *by,
        "n",
        "gram",
        context_of().alias("ctx"),
        suffix_of().alias("suffix"),
        (F.col("a") - discount.otherwise(F.col("d3"))).alias("rest"),
    )


def _root(
    adjusted: DataFrame, contexts: DataFrame, by: Sequence[str], words: DataFrame | None = None
) -> DataFrame:
    """``s, b, low`` of the empty context: ``low`` is uniform over the types and <unk>, or over
    the given ``words``, the end symbol and <unk>."""
    root = contexts.filter(F.col("n") == 1).drop("ctx")
    if words is None:
        of_order = adjusted.filter(F.col("n") == 1)
        types = of_order.groupBy(*by, "n").agg(F.count(F.lit(1)).alias("types"))
        on, rest = [*by, "n"], 1
    else:
        types = words.groupBy(*words.drop("gram").columns).agg(F.count(F.lit(1)).alias("types"))
        on, rest = types.drop("types").columns, 2
    low = 1 / (F.coalesce("types", F.lit(0)) + rest)
    # bounded: one row per model
    joined = root.withColumn("n", F.lit(1)).join(F.broadcast(types), on, "left")
    return joined.select(*root.columns, low.alias("low"))


def _given_words(vocabulary: DataFrame, by: Sequence[str]) -> DataFrame:
    """``n, gram``: the distinct words of a vocabulary, reserved symbols left out; written."""
    own = [c for c in by if c in vocabulary.columns]
    words = vocabulary.filter(~F.col("tok").isin(*SYMBOLS))
    return materialize(words.select(*own, F.lit(1).alias("n"), F.col("tok").alias("gram")).distinct(), "words")


def _unseen(words: DataFrame, adjusted: DataFrame, root: DataFrame, by: Sequence[str]) -> DataFrame:
    """The given words that a model has not learned from: each has what <unk> has."""
    # bounded: one row per model
    every = words.join(F.broadcast(root), words.drop("gram").columns)
    seen = adjusted.filter(F.col("n") == 1).select(*by, "gram")
    mass = (F.col("b") * F.col("low")).alias("p")
    return every.join(seen, [*by, "gram"], "left_anti").select(*by, "n", "gram", mass, "low", "b")


def _lowest(terms: DataFrame, root: DataFrame, by: Sequence[str]) -> DataFrame:
    """The words and <unk>: ``n, gram, p, low, b``, with ``low`` the uniform probability and ``b`` the
    back-off weight of the empty context, which is the ``root``."""
    p = (F.col("rest") / F.col("s") + F.col("b") * F.col("low")).alias("p")
    root = F.broadcast(root)  # bounded: one row per model
    known = terms.filter(F.col("n") == 1).join(root, [*by, "n"]).select(*by, "n", "gram", p, "low", "b")
    mass = (F.col("b") * F.col("low")).alias("p")
    return known.unionByName(root.select(*by, "n", F.lit(UNK).alias("gram"), mass, "low", "b"))


def lm_probs(
    adjusted: DataFrame, order: int = ORDER, by: Sequence[str] = (), fallback: Sequence[float] = FALLBACK
) -> DataFrame:
    """Interpolated probabilities ``n, gram, p`` of all orders, ``<unk>`` included, from
    adjusted counts (written, as they are read several times)."""
    levels = _written_levels(adjusted, order, fallback, by, BROADCAST_BYTES, ["p"])
    return levels.filter(F.col("p").isNotNull())


def training_sentences(
    segs: DataFrame,
    vocabulary: DataFrame,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    ids: DataFrame | None = None,
) -> DataFrame:
    """``seg_id, words``: the tokens a model learns from, in order.

    Words outside the vocabulary are masked and then skipped, so their neighbours become
    adjacent; a segment left without words still counts as an empty sentence. With ``ids`` of all
    words of a written vocabulary, ``words`` are their numbers, and only these are shuffled.
    """
    if ids is not None:
        own = [c for c in by if c in vocabulary.columns]
        words = vocabulary.select(*own, F.col("tok").alias("gram")).distinct().join(ids, "gram")
        rows = spread(segs).select(*by, "seg_id", F.col("text").cast("string").alias("text"))
        schema = f"{_fields(rows, [*by, 'seg_id'])}words array<int>"
        numbers = rows.mapInArrow(coded.sentence_numbers(coded.shared(words, own), by), schema)
        # One sentence for each id, as with words.
        return numbers.groupBy(*by, "seg_id").agg(F.first("words", ignorenulls=True).alias("words"))
    masked = masked_words(segs, vocabulary, by, broadcast_bytes)
    return masked.select(*by, "seg_id", skip_symbols(F.col("words")).alias("words"))


def train_lm(
    segs: DataFrame,
    vocabulary: DataFrame,
    order: int = ORDER,
    fallback: Sequence[float] = FALLBACK,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    closed: bool = False,
) -> DataFrame:
    """Train one model per combination of ``by`` and return the written model frame.

    The lowest probabilities range over the words a model has learned from and <unk>. ``closed``
    tells the estimator the vocabulary: they range over all of its words then, so that a word of
    the vocabulary that a corpus lacks is a word of its model, too, and not <unk>.
    """
    if order < 2:
        raise ValueError("order must be at least 2")
    own = [c for c in by if c in vocabulary.columns]
    vocabulary = materialize(vocabulary.select(*own, "tok"), "vocabulary")
    ids = None
    grams = vocabulary.select(F.col("tok").alias("gram"))
    if fits_words(grams, broadcast_bytes):
        ids = word_ids(grams)
    sentences = training_sentences(segs, vocabulary, by, broadcast_bytes, ids)
    if ids is not None:
        sentences = materialize(sentences, "sentences")  # read twice
    adjusted = sentence_counts(sentences, order, by, ids, spelled=False)
    words = _given_words(vocabulary, by) if closed else None
    columns = ["logp", "bow", "weight"]
    return _written_levels(adjusted, order, fallback, by, broadcast_bytes, columns, words, ids)


def _written_levels(
    adjusted: DataFrame,
    order: int,
    fallback: Sequence[float],
    by: Sequence[str],
    broadcast_bytes: int,
    columns: Sequence[str],
    words: DataFrame | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """The ``columns`` of the model of written adjusted counts, with ``ids`` of all words if there are.

    If the counted size of all orders allows a broadcast, every gram looks up all of its suffixes
    in one pass, without a shuffle. Otherwise all grams are shuffled by their first two words, where
    their contexts are, and by their last two, where their suffixes are. The probabilities and contexts
    of single words are then broadcast if their size allows. Both ways do the same arithmetic.
    """
    tallied = localize(tallies(adjusted, by, ids))  # one row per order and model
    disc = _discounts(tallied, fallback, by)
    sizes: dict[int, int] = {}
    for row in tallied.collect():
        sizes[row["n"]] = sizes.get(row["n"], 0) + row["size"]
    whole = sum(sizes.values()) <= broadcast_bytes
    # Contexts of one word are as many as words.
    few = sizes.get(1, 0) <= broadcast_bytes
    numbers = None
    if ids is not None and whole:
        adjusted = materialize(_spelled(adjusted, order, by, ids), "adjusted", ["n"])
    elif ids is not None:
        numbers, single = adjusted, _spelled(adjusted.filter(F.col("n") == 1), order, by, ids)
        adjusted = materialize(single, "adjusted-words")
    counted = adjusted if whole else adjusted.filter(F.col("n") <= 2)
    contexts = context_stats(counted, disc, by)
    if numbers is not None:
        contexts = contexts.unionByName(_word_contexts(numbers, disc, by, ids))
    contexts = materialize(contexts, "contexts", ["n"])
    of_words = contexts.filter(F.col("n") == 2)
    terms, root = _terms(adjusted, disc, by), _root(adjusted, contexts, by, words)
    lowest = seen = _lowest(terms, root, by)
    if words is not None:
        lowest = lowest.unionByName(_unseen(words, adjusted, root, by))
    rows = _with_backoff(lowest, F.broadcast(of_words) if few else of_words, by)
    if whole:
        higher = _chained(terms, contexts, seen, order, by)
    else:
        if ids is None:
            single = adjusted.filter(F.col("n") == 1)
            ids = word_ids(single) if fits_words(single, broadcast_bytes) else None
            numbers = None if ids is None else _numbers_of(adjusted, order, by, ids)
        higher = _shuffled(adjusted if ids is None else numbers, disc, of_words, seen, order, by, few, ids)
    with short_rows(adjusted.sparkSession):
        return materialize(rows.unionByName(higher).select(*by, "n", "gram", *columns), "model")


def _word_contexts(numbers: DataFrame, disc: DataFrame, by: Sequence[str], ids: DataFrame) -> DataFrame:
    """``context_stats`` of the contexts of one word, from counts of numbers."""
    pairs = numbers.filter(F.col("n") == 2).select(
        *by, "n", "a", F.shiftright("pair_0", HALF).cast("int").alias("ctx")
    )
    totals = _context_totals(pairs, by, F.col("ctx"))
    mass = F.expr("(d1 * n1 + d2 * n2 + d3 * n3) / s")
    found = _with_discounts(totals, disc, by).select(*by, "n", "ctx", "s", mass.alias("b"))
    return decoded(found, ids, ["ctx"]).select(*by, "n", "ctx", "s", "b")


def _numbers_of(adjusted: DataFrame, order: int, by: Sequence[str], ids: DataFrame) -> DataFrame:
    """Adjusted counts of two words or more with words as numbers."""
    parts, words = F.split("gram", " "), [f"w{k}" for k in range(1, order + 1)]
    rows = adjusted.filter(F.col("n") > 1).select(
        *by, F.col("n").cast("int").alias("n"), "a", *[F.get(parts, F.lit(k)).alias(w) for k, w in enumerate(words)]
    )
    return coded_words(rows, ids, words).select(*by, "n", *packed([*words, "n"]), "a")


def _shuffled(
    adjusted: DataFrame,
    disc: DataFrame,
    contexts: DataFrame,
    unigrams: DataFrame,
    order: int,
    by: Sequence[str],
    few: bool,
    ids: DataFrame | None,
) -> DataFrame:
    """The model rows of all orders above the first, from two shuffles of the grams.

    Grams of one context of two words or more share the first two words, with the context itself as a
    gram. Sorted by their words they are neighbours there: each gram gets the counts of its context
    and, if it is one, its own. Then all suffixes of two words or more share the last two words, and
    are neighbours when sorted from the last word backwards: each gram gets the terms of its
    suffixes. ``contexts`` of one word and ``unigrams`` are broadcast if they are ``few``. Otherwise
    they are joined to the grams of two words alone: only these have such a context, and each suffix of
    two words is in the second shuffle, where the others get its last word's probability from it. With
    ``ids`` of all words, ``adjusted`` has words as numbers, two in a long, which are put back at the end.
    """
    if ids is not None:
        return _shuffled_numbers(adjusted, disc, contexts, unigrams, order, by, few, ids)
    first, last = [f"w{k}" for k in range(1, order + 1)], [f"t{k}" for k in range(order)]
    parts = F.split("gram", " ")
    rows = adjusted.filter(F.col("n") > 1).select(
        *by, F.col("n").cast("int").alias("n"), "a", *[F.get(parts, F.lit(k)).alias(w) for k, w in enumerate(first)]
    )
    start, end = first[:2], last[:2]
    along = [] if few else ["s_1", "b_1", "p_1"]
    if not few:
        context = contexts.select(*by, F.col("ctx").alias("w1"), F.col("s").alias("s_1"), F.col("b").alias("b_1"))
        word = unigrams.select(*by, F.col("gram").alias("w2"), F.col("p").alias("p_1"))
        pairs = rows.filter(F.col("n") == 2).join(context, [*by, "w1"]).join(word, [*by, "w2"])
        rows = rows.filter(F.col("n") > 2).unionByName(pairs, allowMissingColumns=True)
    rows = rows.repartition(*by, *start)
    for m in range(order - 1, 1, -1):
        of = W.partitionBy(*by, *start, *first[2:m])
        a = F.when(F.col("n") == m + 1, F.col("a"))  # of the grams whose context has these m words
        rows = rows.select(
            "*",
            F.sum(a).over(of).alias(f"s_{m}"),
            *[F.count(F.when(a == k, 1)).over(of).alias(f"n{k}_{m}") for k in (1, 2)],
            F.count(F.when(a >= 3, 1)).over(of).alias(f"n3_{m}"),
        )

    def mass(m: int, d: str) -> Column:
        return F.expr(f"({d}1 * n1_{m} + {d}2 * n2_{m} + {d}3 * n3_{m}) / s_{m}")

    above = disc.select(*by, (F.col("n") - 1).alias("n"), *[F.col(f"d{k}").alias(f"e{k}") for k in (1, 2, 3)])
    # bounded: one row per order and model
    rows = _with_discounts(rows, disc, by).join(F.broadcast(above), [*by, "n"], "left")
    if few:
        one = contexts.select(*by, F.col("ctx").alias("w1"), F.col("s").alias("s_1"), F.col("b").alias("b_1"))
        rows = lookup(rows, one, [*by, "w1"], broadcast=True)
    s, b, own = F.col("s_1"), F.col("b_1"), F.lit(None).cast("double")
    for m in range(2, order):
        s = F.when(F.col("n") == m + 1, F.col(f"s_{m}")).otherwise(s)
        b = F.when(F.col("n") == m + 1, mass(m, "d")).otherwise(b)
        own = F.when(F.col("n") == m, mass(m, "e")).otherwise(own)
    discount = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2"))
    rest = F.col("a") - discount.otherwise(F.col("d3"))
    backwards = [F.get(F.array(*first), F.col("n") - 1 - k).alias(t) for k, t in enumerate(last)]
    along = along[2:]
    rows = rows.select(*by, "n", *backwards, (rest / s).alias("share"), b.alias("b"), own.alias("own"), *along)
    rows = rows.repartition(*by, *end)
    low = F.col("p_1")
    for k in range(order - 1, 1, -1):
        of = W.partitionBy(*by, *end, *last[2:k])
        terms = [F.max(F.when(F.col("n") == k, F.col(c))).over(of).alias(f"{c}_{k}") for c in ("share", "b")]
        rows = rows.select("*", *terms)
    for k in range(2, order):
        longer = F.col("n") > k
        low = F.when(longer, F.col(f"share_{k}") + F.col(f"b_{k}") * low).otherwise(low)
    if few:
        words = unigrams.select(*by, F.col("gram").alias("t0"), F.col("p").alias("p_1"))
        rows = lookup(rows, words, [*by, "t0"], broadcast=True)
    elif order > 2:
        rows = rows.withColumn("p_1", F.max("p_1").over(W.partitionBy(*by, *end)))
    rows = rows.withColumn("low", low)
    rows = rows.withColumn("p", F.col("share") + F.col("b") * F.col("low"))
    bow = F.coalesce(F.log10("own"), F.lit(0.0))
    gain = F.log10("p") - F.log10("low") - F.log10("b")
    return rows.select(
        *by, "n", F.concat_ws(" ", *reversed(last)).alias("gram"),
        F.log10("p").alias("logp"), bow.alias("bow"), (gain + bow).alias("weight"), "p",
    )


def _shuffled_numbers(
    adjusted: DataFrame,
    disc: DataFrame,
    contexts: DataFrame,
    unigrams: DataFrame,
    order: int,
    by: Sequence[str],
    few: bool,
    ids: DataFrame,
) -> DataFrame:
    """``_shuffled`` for counts of numbers: the same two shuffles and sorts, of which tasks read the rows
    in Arrow batches. Contexts and probabilities of single words go along with the grams of two words."""
    pairs = coded.pairs_of(order + 1)
    found = {tuple(r[c] for c in (*by, "n")): (r["d1"], r["d2"], r["d3"]) for r in disc.collect()}
    keys = list(dict.fromkeys(key[:-1] for key in found))
    discounts_of = {(keys.index(key[:-1]), key[-1]): d for key, d in found.items()}
    key = _key_of(by, keys)
    grams, numbers = adjusted.filter(F.col("n") > 1), ", ".join(f"{p} long" for p in pairs)
    context = contexts.select(key, "ctx", F.col("s").cast("double").alias("s_1"), F.col("b").alias("b_1"))
    word = unigrams.select(key, "gram", F.col("p").alias("p_1"))
    context, word = coded_words(context, ids, ["ctx"]), coded_words(word, ids, ["gram"])
    two = grams.filter(F.col("n") == 2).select(
        key, *pairs, "a", F.shiftright("pair_0", HALF).cast("int").alias("ctx"),
        F.col("pair_0").bitwiseAND((1 << HALF) - 1).cast("int").alias("gram"),
    )
    two = lookup(two, context, ["key", "ctx"], broadcast=few)
    two = lookup(two, word, ["key", "gram"], broadcast=few)
    rows = grams.filter(F.col("n") > 2).select(key, *pairs, "a")
    rows = rows.unionByName(two.drop("ctx", "gram"), allowMissingColumns=True)
    rows = rows.select("key", *pairs, "a", "s_1", "b_1", "p_1")
    rows = _sorted_pairs(rows, ["key"], pairs).mapInArrow(
        coded.contexts_and_shares(order, ["key"], discounts_of),
        f"key int, {numbers}, share double, b double, own double, p_1 double",
    )
    rows = _sorted_pairs(rows, ["key"], pairs).mapInArrow(
        coded.probabilities(coded.shared(ids), order, ["key"]),
        "key int, n int, gram string, p double, low double, b double, own double",
    )
    bow = F.coalesce(F.log10("own"), F.lit(0.0))
    gain = F.log10("p") - F.log10("low") - F.log10("b")
    return rows.select(
        *_values_of(adjusted, by, keys), "n", "gram", F.log10("p").alias("logp"), bow.alias("bow"), (gain + bow).alias("weight"), "p"
    )


def _chained(
    terms: DataFrame, contexts: DataFrame, unigrams: DataFrame, order: int, by: Sequence[str]
) -> DataFrame:
    """The model rows of all orders above the first, from broadcasts of the terms of each order.

    The probability of a gram is its own term plus its context's back-off weight times the
    probability of its suffix, and so on down to the unigram: a gram's row takes the terms of
    all its suffixes, and the recursion is an expression of that row.
    """
    found = F.broadcast(contexts.select(*by, "n", "ctx", "s", "b"))
    own = terms.filter(F.col("n") > 1).join(found, [*by, "n", "ctx"])
    rows = own.select(*by, "n", "gram", (F.col("rest") / F.col("s")).alias("share"), "b")
    low = F.col("p_1")
    tables = {1: unigrams.select(*by, F.col("gram").alias("suffix_1"), F.col("p").alias("p_1"))}
    for k in range(2, order):
        of_order = terms.filter(F.col("n") == k).join(
            F.broadcast(contexts.filter(F.col("n") == k).select(*by, "ctx", "s", "b")), [*by, "ctx"]
        )
        tables[k] = of_order.select(
            *by,
            F.col("gram").alias(f"suffix_{k}"),
            (F.col("rest") / F.col("s")).alias(f"share_{k}"),
            F.col("b").alias(f"b_{k}"),
        )
        longer = F.col("n") > k
        low = F.when(longer, F.col(f"share_{k}") + F.col(f"b_{k}") * low).otherwise(low)
    for k, table in tables.items():
        suffix = F.when(F.col("n") > k, F.substring_index("gram", " ", -k))
        rows = rows.withColumn(f"suffix_{k}", suffix).join(F.broadcast(table), [*by, f"suffix_{k}"], "left")
    rows = rows.withColumn("low", low)
    p = F.col("share") + F.col("b") * F.col("low")
    backoff = contexts.select(
        *by, (F.col("n") - 1).cast("int").alias("n"), F.col("ctx").alias("gram"), F.log10("b").alias("bow")
    )
    level = rows.select(*by, "n", "gram", p.alias("p"), "low", "b").join(
        F.broadcast(backoff), [*by, "n", "gram"], "left"
    )
    bow = F.coalesce("bow", F.lit(0.0))
    gain = F.log10("p") - F.log10("low") - F.log10("b")
    return level.select(
        *by, "n", "gram", F.log10("p").alias("logp"), bow.alias("bow"), (gain + bow).alias("weight"), "p"
    )


def _with_backoff(level: DataFrame, contexts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The model rows of single words and of the start symbol; ``contexts`` are those of one word."""
    backoff = contexts.select(*by, F.col("ctx").alias("gram"), F.log10("b").alias("bow"))
    level = level.join(backoff, [*by, "gram"], "left")
    bow = F.coalesce("bow", F.lit(0.0))
    columns = [*by, F.lit(1).alias("n"), "gram"]
    rows = level.select(
        *columns, F.log10("p").alias("logp"), bow.alias("bow"), (F.log10("p") + bow).alias("weight"), "p"
    )
    no_value = F.lit(None).cast("double")
    start = backoff.filter(F.col("gram") == BOS).select(
        *columns, no_value.alias("logp"), "bow", F.col("bow").alias("weight"), no_value.alias("p")
    )
    return rows.unionByName(start)
