"""Scoring segments under two models in one pass.

Back-off scoring takes, at each position, the longest gram the model has and adds the
back-off weights of the contexts above it. That sum telescopes. With

    weight(g) = logp(g) + bow(g)                                  for a unigram
    weight(g) = logp(g) - logp(suffix g) - bow(context g) + bow(g)  otherwise

and the model closed under suffixes, a segment's total is the sum of ``weight`` over all
occurrences of model grams in it, plus log10 p(<unk>) per unknown word. So scoring needs no
per-position search, no window and no self-join: grams are looked up once and summed, the
sum is combined before the shuffle, and only one narrow row per segment is shuffled.

Weights are whole numbers of 2^-40, so a sum is exact and the same in any order: a score does
not depend on how the work was cut or on whether the models were broadcast. Sums are kept in two
parts, so that a segment may have any length, and a long segment is cut into pieces that overlap
by what the longest gram reaches back; its sums are added up like those of any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import (
    BOS,
    EOS,
    LONG_BYTES,
    ORDER,
    PIECE,
    UNK,
    cuts,
    empty_to_unk,
    endings,
    gram_ending,
    grams_ending,
    hide_symbols,
    perplexity,
    pieces,
    tokenize,
)
from ..sources.staging import (
    BROADCAST_BYTES,
    FREQUENT,
    TRACKED,
    fits_broadcast,
    frequent_lookup,
    lookup,
    materialize,
    short_rows,
    spread,
)
from . import coded
from .vocabulary import HALF, fits_words

SCALE = 6
UNIT = float(1 << 40)  # units of a weight
LIMB = 30  # bits of the lower part of a sum of weights
SKETCHED = 16  # one of so many segments shows which pairs of words are frequent
SHORT_BYTES = 1 << 16  # a text beyond this goes to Python in pieces
NO_ID = -1 << 63  # stands for a null seg_id
SALTS = 32  # places that the rows of a frequent pair of words are dealt out to


def unknown_logps(models: dict[str, DataFrame], by: Sequence[str]) -> dict[str, Column]:
    """log10 p(<unk>) of the tagged models as column expressions; collects one number per model."""
    tagged = [
        model.filter((F.col("n") == 1) & (F.col("gram") == UNK)).select(*by, "logp", F.lit(tag).alias("tag"))
        for tag, model in models.items()
    ]
    rows = reduce(DataFrame.unionByName, tagged).collect()
    found = {}
    for tag in models:
        value = F.lit(None).cast("double")
        for row in (r for r in rows if r["tag"] == tag):
            same = F.lit(True)
            for c in by:
                same = same & (F.col(c) == F.lit(row[c]))
            value = F.when(same, F.lit(row["logp"])).otherwise(value)
        found[tag] = value
    if {row["tag"] for row in rows} != set(models):
        raise ValueError("a model has no <unk> row: it was trained on an empty corpus")
    return found


def joint_weights(
    specific: DataFrame,
    general: DataFrame,
    by: Sequence[str] = (),
    unknown: dict[str, Column] | None = None,
) -> DataFrame:
    """Both models side by side: ``n, gram, w_s, w_g, known_s, known_g``.

    A word only one model knows counts as ``<unk>`` in the other one. Weights are in units.
    """
    on = [*by, "n", "gram"]
    models = {"s": specific, "g": general}
    unknown = unknown or unknown_logps(models, by)
    word = (F.col("n") == 1) & (F.col("gram") != BOS)
    tagged = [
        model.filter(F.col("gram") != UNK).select(*on, "weight", F.lit(tag).alias("tag"))
        for tag, model in models.items()
    ]
    # a gram occurs once per model, so the sum is that one weight, or null
    both = tagged[0].unionByName(tagged[1]).groupBy(*on).agg(
        *[F.sum(F.when(F.col("tag") == tag, F.col("weight"))).alias(f"m_{tag}") for tag in models]
    )
    columns = []
    for tag in models:
        missing = F.when(word, unknown[tag]).otherwise(F.lit(0.0))
        weight = F.coalesce(F.col(f"m_{tag}"), missing)
        columns.append(F.round(weight * F.lit(UNIT)).cast("long").alias(f"w_{tag}"))
    for tag in models:
        columns.append((word & F.col(f"m_{tag}").isNotNull()).cast("int").alias(f"known_{tag}"))
    return both.select(*on, *columns)


def segment_endings(
    segs: DataFrame,
    order: int = ORDER,
    by: Sequence[str] = (),
    carried: Sequence[str] = (),
    long_bytes: int = LONG_BYTES,
    piece: int = PIECE,
) -> DataFrame:
    """One row per token of the padded segment: the token ``t0`` and the tokens before it.

    Scored positions are the words and the end symbol. The rows of a segment's last piece, to
    which its end symbol belongs, have their number in ``positions``; it is null in others.
    """
    keys = [*by, "seg_id", *carried]
    text = F.coalesce("text", F.lit(""))
    cut = spread(segs).select(*keys, text.alias("text"), *cuts(text, order, long_bytes, piece))
    words = cut.select(*keys, F.inline(pieces(F.col("text"), piece))).select(
        *keys, "first", "last", "rest", tokenize(F.col("text")).alias("words"), tokenize(F.col("before")).alias("before")
    )
    # Every text has a last piece, which is the only one that may be empty.
    steps = words.withColumn("words", empty_to_unk(F.col("words")))
    positions = F.when(F.col("last"), F.col("rest") + F.size("words") + 1)
    steps = steps.select(*keys, positions.alias("positions"), "first", "last", "before", "words")
    for name in ("words", "before"):
        steps = steps.withColumn(name, hide_symbols(F.col(name)))
    none = F.array().cast("array<string>")
    start = F.when(F.col("first"), F.array(F.lit(BOS))).otherwise(none)
    end = F.when(F.col("last"), F.array(F.lit(EOS))).otherwise(none)
    steps = steps.withColumn("words", F.concat("before", start, "words", end))
    # What comes before a piece is part of grams, but ends none: it is scored with its own piece.
    skip = F.size("before")
    every = endings(F.col("words"), order)
    every = F.when(skip > 0, F.slice(every, skip + 1, F.size("words"))).otherwise(every)
    ends = steps.select(*keys, "positions", F.inline(every))
    return ends.filter(F.col("t0").isNotNull())


def model_lookup(
    segs: DataFrame,
    weights: DataFrame,
    order: int = ORDER,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every gram occurrence that a written weight table has, with its weights.

    No model gram contains an unknown word, so tokens are first looked up alone and only
    those the models know go on to be expanded into grams. Words, the most frequent keys,
    are few and fit a broadcast long after the longer grams no longer do. The models are closed
    under suffixes, so a longer gram is then built and shuffled only where the shorter one was
    found, order by order. Where the words don't fit either, all grams are looked up at once.
    The most frequent words and grams are kept out of every shuffle.
    """
    words = weights.filter(F.col("n") == 1)
    whole = fits_broadcast(weights, broadcast_bytes)
    known = whole or fits_broadcast(words, broadcast_bytes)
    ends = segment_endings(segs, order, by)
    if whole or not known:
        tokens = words.select(*by, F.col("gram").alias("t0"))
        if whole:
            ends = lookup(ends, tokens, [*by, "t0"], broadcast=True)
        else:
            ends = frequent_lookup(ends, tokens, [*by, "t0"], "t0")
        grams = ends.select(*by, "seg_id", "positions", F.inline(grams_ending(order=order)))
        grams = grams.filter(F.col("gram").isNotNull()).drop("n")
        if whole:
            return lookup(grams, weights, [*by, "gram"], broadcast=True)
        return frequent_lookup(grams, weights, [*by, "gram"], "gram")
    keys, texts = [*by, "seg_id", "positions"], [f"t{k}" for k in range(order)]
    # One broadcast of the words tells which tokens are known and what they weigh.
    ends = lookup(ends, words.withColumnRenamed("gram", "t0"), [*by, "t0"], broadcast=True)
    found, before = [ends.drop(*texts[1:]).withColumnRenamed("t0", "gram")], words.select(*by, F.col("gram").alias("t1"))
    rows = ends.filter(F.col("t1").isNotNull()).select(*keys, *texts)
    rows = lookup(rows, before, [*by, "t1"], broadcast=True).withColumnRenamed("t0", "gram")
    for n in range(2, order + 1):
        further = [f"t{k}" for k in range(n, order)]
        longer = F.concat(f"t{n - 1}", F.lit(" "), "gram").alias("gram")
        rows = rows.filter(F.col(f"t{n - 1}").isNotNull()).select(*keys, *further, longer)
        if n == 2:
            rows = materialize(rows, "pairs")  # read three times by the lookup
        rows = frequent_lookup(rows, weights.filter(F.col("n") == n), [*by, "gram"], "gram")
        if n < order:
            rows = materialize(rows, "found")  # what the next order begins with
        found.append(rows.drop(*further))
        rows = rows.select(*keys, *further, "gram")
    return reduce(DataFrame.unionByName, found)


def position_weights(
    segs: DataFrame,
    weights: DataFrame,
    order: int = ORDER,
    by: Sequence[str] = (),
    carried: Sequence[str] = (),
) -> DataFrame:
    """One row per known token with the summed weights of the model grams that end there.

    For a weight table whose counted size allows a broadcast. The table is probed order by
    order without any shuffle. Since the models are closed under suffixes, the gram of the
    next order is built and looked up only where the one before was found.
    """
    rows = segment_endings(segs, order, by, carried)
    names = {"w_s": [], "w_g": []}
    for n in range(1, order + 1):
        columns = [F.col(w).alias(f"{w}_{n}") for w in names]
        columns += ["known_s", "known_g"] if n == 1 else []
        table = weights.filter(F.col("n") == n).select(*by, "gram", *columns)
        gram = gram_ending(n)
        if n > 1:
            gram = F.when(F.col(f"w_s_{n - 1}").isNotNull(), gram)
        rows = rows.withColumn("gram", gram).join(
            F.broadcast(table), [*by, "gram"], "inner" if n == 1 else "left"
        )
        rows = rows.drop("gram")
        for name, found in names.items():
            found.append(F.coalesce(f"{name}_{n}", F.lit(0).cast("long")))
    sums = [reduce(lambda x, y: x + y, found).alias(name) for name, found in names.items()]
    return rows.select(*by, "seg_id", *carried, "positions", *sums, "known_s", "known_g")


def _frequent_pairs(tokens: DataFrame) -> DataFrame:
    """``key, pair_0`` of the pairs of words that hold more than a five-hundredth of the tokens; written."""
    top = F.expr(f"approx_top_k(pair_0, {FREQUENT}, {TRACKED})").alias("top")
    key = F.expr(f"place div {SALTS}").alias("key")
    most = tokens.filter(F.col("pair_0") > 0).groupBy(key).agg(F.count(F.lit(1)).alias("rows"), top)
    most = most.select("key", "rows", F.inline("top")).filter(F.col("count") * 500 > F.col("rows"))
    return materialize(most.select("key", F.col("item").alias("pair_0")), "frequent-pairs")


def paired_weights(
    segs: DataFrame,
    models: dict[str, DataFrame],
    words: DataFrame,
    order: int = ORDER,
    by: Sequence[str] = (),
) -> DataFrame:
    """The rows of ``position_weights`` for models beyond a broadcast, added up for parts of segments;
    ``unigrams`` is their number. ``words``, the written joint weights of single words, are broadcast.

    All model grams that end at a token share its last two words. So tokens, with the words before
    them as numbers, two in a long, and the grams of both models go through one shuffle by the last two.
    Sorted from the last word backwards, a gram stands before all tokens it ends at, and is the only
    one of its order and model among rows that share its words. Rows of frequent pairs are dealt out
    further, and their grams go to each of those places; a part of the segments shows which pairs
    these are, which decides on the place of rows only. What words weigh alone is added up where a
    text is read, and a token before which no known word stands goes nowhere.
    """
    known = coded.shared(words.select(*by, "gram", "w_s", "w_g", "known_s", "known_g"), by)
    columns = coded.columns(order)
    schema = ", ".join(f"{c} long" for c in columns)
    seg_id = F.coalesce(F.col("seg_id").cast("long"), F.lit(NO_ID)).alias("seg_id")
    texts = segs.select(*by, seg_id, F.coalesce("text", F.lit("")).alias("text"))

    def tokens(of: DataFrame, hot: Sequence[tuple[int, int]]) -> DataFrame:
        parts = of.select(*by, "seg_id", "text", *cuts(F.col("text"), order, SHORT_BYTES))
        parts = parts.select(*by, "seg_id", F.inline(pieces(F.col("text"))))
        return parts.mapInArrow(coded.segment_tokens(known, order, hot, SALTS), schema)

    some = texts.filter(F.pmod(F.xxhash64("seg_id"), F.lit(SKETCHED)) == 0)
    hot = [tuple(r) for r in _frequent_pairs(tokens(some, ())).collect()]
    rows = tokens(spread(texts), hot)
    for tag, model in enumerate(models.values()):
        weight = (F.col("weight") * F.lit(UNIT)).alias("w")
        grams = model.filter(F.col("n") > 1).select(*by, F.col("n").cast("int").alias("n"), "gram", weight)
        rows = rows.unionByName(grams.mapInArrow(coded.model_grams(known, order, tag, hot, SALTS), schema))
    rows = rows.repartition(*columns[:2]).sortWithinPartitions(*columns[:-1])
    found = rows.mapInArrow(
        coded.found_weights(order, SALTS), "key int, seg_id long, kind int, high long, low long"
    ).repartition("key", "seg_id")
    keys = {key: k for key, k in known.value.keys.items()}
    values = [
        F.get(F.array(*[F.lit(key[at]).cast(segs.schema[c].dataType) for key in keys]), F.col("key")).alias(c)
        for at, c in enumerate(by)
    ]

    def of(kind: int, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value).otherwise(F.lit(0).cast("long"))

    low_half = (1 << HALF) - 1
    return found.select(
        *values,
        F.when(F.col("seg_id") != NO_ID, F.col("seg_id")).cast(segs.schema["seg_id"].dataType).alias("seg_id"),
        F.when(F.col("kind") == coded.COUNTS, F.shiftright("high", HALF)).alias("positions"),
        of(coded.WEIGHTS, F.col("high")).alias("w_s"),
        of(coded.WEIGHTS, F.col("low")).alias("w_g"),
        of(coded.COUNTS, F.col("high").bitwiseAND(low_half)).alias("unigrams"),
        of(coded.COUNTS, F.shiftright("low", HALF)).alias("known_s"),
        of(coded.COUNTS, F.col("low").bitwiseAND(low_half)).alias("known_g"),
    )


def wide_sums(*weights: str) -> list[Column]:
    """The exact sums of columns of whole numbers, each in two parts of which neither overflows:
    multiples of 2^30, and what is left."""
    return [
        F.sum(part).alias(f"{name}_{limb}")
        for name in weights
        for limb, part in (
            ("high", F.shiftright(name, LIMB)),
            ("low", F.col(name).bitwiseAND((1 << LIMB) - 1)),
        )
    ]


def wide_total(name: str) -> Column:
    """The value of ``wide_sums`` in the unit of a score, rounded once."""
    high, low = F.col(f"{name}_high"), F.col(f"{name}_low")
    high, low = high + F.shiftright(low, LIMB), low.bitwiseAND((1 << LIMB) - 1)
    return high * F.lit((1 << LIMB) / UNIT) + low * F.lit(1 / UNIT)


def _summed(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """What was found, added up for each segment."""
    return found.groupBy(*by, "seg_id").agg(
        F.max("positions").alias("positions"),
        *wide_sums("w_s", "w_g"),
        *[F.sum(c).alias(c) for c in ("unigrams", "known_s", "known_g")],
    )


def score_lm(
    segs: DataFrame,
    specific: DataFrame,
    general: DataFrame,
    order: int = ORDER,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Total log10 probability of every segment under both models.

    ``seg_id, positions, logp_s, logp_g, oov_s, oov_g``. Every segment has a row, since the
    models know the end symbol. ``carried`` names narrow columns of the segments that the
    result keeps, so that nothing has to be read again for them.
    """
    models = {"s": specific, "g": general}
    unknown = unknown_logps(models, by)
    single = [model.filter(F.col("n") == 1) for model in models.values()]
    words = materialize(joint_weights(*single, by, unknown), "word-weights")
    # A gram is in both models at most: what is beyond twice the limit is not worth joining.
    both = reduce(DataFrame.unionByName, [model.select(*by, "n", "gram") for model in models.values()])
    paired = not fits_broadcast(both, 2 * broadcast_bytes) and fits_words(words, broadcast_bytes)
    paired = paired and segs.schema["seg_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    whole = False
    if paired:
        with short_rows(segs.sparkSession):
            sums = materialize(_summed(paired_weights(segs, models, words, order, by), by), "sums")
    else:
        weights = materialize(joint_weights(specific, general, by, unknown), "weights", ["n"])
        whole = fits_broadcast(weights, broadcast_bytes)
        if whole:
            found = position_weights(segs, weights, order, by, carried).withColumn("n", F.lit(1))
        else:
            found = model_lookup(segs, weights, order, by, broadcast_bytes)
        found = found.withColumn("unigrams", (F.col("n") == 1).cast("long"))
        # what is carried depends on seg_id alone
        sums = _summed(found, [*by, *(carried if whole else ())])
    if carried and not whole:
        # there the tokens are shuffled, and should not take it along
        sums = sums.join(segs.select(*by, "seg_id", *carried), [*by, "seg_id"])
    # one unigram is the start symbol, which is no position
    unseen = F.col("positions") - (F.col("unigrams") - 1)
    totals = [
        (wide_total(f"w_{tag}") + unseen * unk).alias(f"logp_{tag}") for tag, unk in unknown.items()
    ]
    oov = [(F.col("positions") - F.col(f"known_{tag}")).alias(f"oov_{tag}") for tag in unknown]
    return sums.select(*by, "seg_id", *carried, "positions", *totals, *oov)


def oov_rate(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unknown words per segment and model."""
    return scores.select(*by, "seg_id", "oov_s", "oov_g")


def rounded(value: Column) -> Column:
    # adding zero turns a negative zero into zero
    return F.round(value, SCALE) + F.lit(0.0)


def score_diff(
    scores: DataFrame, metric: str = "logprob", by: Sequence[str] = (), carried: Sequence[str] = ()
) -> DataFrame:
    """``seg_id, diff``: specific minus general, six decimals.

    ``logprob`` takes total log10 probabilities, ``perplexity`` per-word perplexities.
    """
    if metric == "logprob":
        diff = F.col("logp_s") - F.col("logp_g")
    elif metric == "perplexity":
        of = {t: perplexity(F.col(f"logp_{t}"), F.col("positions")) for t in ("s", "g")}
        diff = of["s"] - of["g"]
    else:
        raise ValueError(f"unknown metric: {metric!r}")
    return scores.select(*by, "seg_id", *carried, rounded(diff).alias("diff"))


def align_scores(specific: DataFrame, general: DataFrame) -> DataFrame:
    """Scores of the same segments under two models, each ``seg_id, logp``, side by side."""
    return specific.select("seg_id", F.col("logp").alias("logp_s")).join(
        general.select("seg_id", F.col("logp").alias("logp_g")), "seg_id"
    )


def align_sides(src_diff: DataFrame, tgt_diff: DataFrame) -> DataFrame:
    """Differences of the same pairs on both sides: ``seg_id, src_diff, tgt_diff``."""
    return src_diff.select("seg_id", F.col("diff").alias("src_diff")).join(
        tgt_diff.select("seg_id", F.col("diff").alias("tgt_diff")), "seg_id"
    )


def score_sum(src_diff: DataFrame, tgt_diff: DataFrame) -> DataFrame:
    """``seg_id, score``: the two rounded differences added, six decimals."""
    total = rounded(F.col("src_diff") + F.col("tgt_diff"))
    return align_sides(src_diff, tgt_diff).select("seg_id", total.alias("score"))


def check_complete(segs: DataFrame, scores: DataFrame) -> None:
    """Raise unless every segment has a score."""
    missing = segs.select("seg_id").join(scores.select("seg_id"), "seg_id", "left_anti")
    n = missing.count()
    if n:
        raise ValueError(f"{n} segments have no score")
