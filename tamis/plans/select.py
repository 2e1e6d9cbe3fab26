"""The whole pipeline: rank a general corpus by similarity to a specific one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ORDER
from ..operators.ngram_model import FALLBACK, train_lm
from ..operators.ranking import PRINTS, TIE_ROWS, attach_ranks, fingerprints, rank_keys
from ..operators.sampling import sample_first_n, sample_random_n
from ..operators.scoring import rounded, score_diff, score_lm
from ..operators.vocabulary import count_segments, token_counts, vocab
from ..sources.corpus import Corpus
from ..sources.sinks import Models
from ..sources.staging import BROADCAST_BYTES


@dataclass(frozen=True)
class Settings:
    """Parameters of the pipeline beyond the sides and the metric."""

    order: int = ORDER
    min_count: int = 2
    fallback: tuple[float, float, float] = FALLBACK
    seed: int = 0
    broadcast_bytes: int = BROADCAST_BYTES
    tie_rows: int = TIE_ROWS
    closed: bool = False  # tell the estimator the vocabulary, see ``train_lm``


def rank_mode(rank_src: bool, rank_tgt: bool) -> tuple[str, ...]:
    """The sides that take part in the score; at least one must."""
    sides = tuple(s for s, on in (("src", rank_src), ("tgt", rank_tgt)) if on)
    if not sides:
        raise ValueError("at least one of rank_src and rank_tgt must be true")
    return sides


def by_side(pairs: DataFrame, sides: tuple[str, ...], carried: Sequence[str] = ()) -> DataFrame:
    """``side, seg_id, text``: one row per pair and side, from a single scan."""
    texts = [F.struct(F.lit(s).alias("side"), F.col(s).alias("text")) for s in sides]
    return pairs.select("seg_id", *carried, F.inline(F.array(*texts))).select(
        "side", "seg_id", *carried, "text"
    )


def first_rows(general: DataFrame | Corpus) -> Callable[[int], DataFrame]:
    """How to get the first segments of a corpus: from a ``Corpus`` without reading the rest."""
    return general.first if isinstance(general, Corpus) else partial(sample_first_n, general)


def pairs_of(corpus: DataFrame | Corpus) -> DataFrame:
    return corpus.pairs if isinstance(corpus, Corpus) else corpus


def train_models(
    general: DataFrame | Corpus,
    specific: DataFrame | Corpus,
    sides: tuple[str, ...],
    sample: str | DataFrame = "first",
    settings: Settings = Settings(),
) -> DataFrame:
    """Models of both corpora for all sides: a model frame with ``model`` and ``side``.

    The general model learns from as many segments as the specific corpus has; both see
    only the words that occur more than once in the specific corpus.
    """
    specific = pairs_of(specific)
    if isinstance(sample, DataFrame):
        drawn = sample
    elif sample == "first":
        drawn = first_rows(general)(count_segments(specific).first()["n"])
    elif sample == "random":
        n = count_segments(specific).first()["n"]
        drawn = sample_random_n(pairs_of(general), n, settings.seed)
    else:
        raise ValueError(f"unknown sample: {sample!r}")
    wanted = by_side(specific, sides)
    words = vocab(token_counts(wanted, ["side"]), settings.min_count)
    texts = wanted.withColumn("model", F.lit("specific")).unionByName(
        by_side(drawn, sides).withColumn("model", F.lit("general"))
    )
    return train_lm(
        texts,
        words,
        settings.order,
        settings.fallback,
        by=["model", "side"],
        broadcast_bytes=settings.broadcast_bytes,
        closed=settings.closed,
    )


def fit(
    general: DataFrame | Corpus,
    specific: DataFrame | Corpus,
    rank_src: bool = True,
    rank_tgt: bool = True,
    sample: str | DataFrame = "first",
    settings: Settings = Settings(),
) -> Models:
    """The models that ``select`` ranks by, to be kept by ``save_models`` or handed to it."""
    frame = train_models(general, specific, rank_mode(rank_src, rank_tgt), sample, settings)
    return Models(frame, settings.order, settings.min_count, settings.closed)


def _fitting(models: Models, sides: tuple[str, ...], settings: Settings) -> DataFrame:
    """The frame of kept models, or an error if they can't score these sides with these settings."""
    lacking = set(sides) - set(models.sides)
    if lacking:
        raise ValueError(f"the models know the sides {models.sides}, not {', '.join(sorted(lacking))}")
    for name in ("order", "min_count", "closed"):
        if getattr(models, name) != getattr(settings, name):
            raise ValueError(
                f"the models were trained with {name} {getattr(models, name)}, not {getattr(settings, name)}"
            )
    return models.frame.filter(F.col("side").isin(*sides))


def side_diffs(
    general: DataFrame,
    models: DataFrame,
    sides: tuple[str, ...],
    metric: str = "logprob",
    settings: Settings = Settings(),
    carried: Sequence[str] = (),
) -> DataFrame:
    """``side, seg_id, diff``: the rounded score difference of every general segment."""
    specific, of_general = (
        models.filter(F.col("model") == name).drop("model") for name in ("specific", "general")
    )
    scores = score_lm(
        by_side(general, sides, carried),
        specific,
        of_general,
        settings.order,
        by=["side"],
        broadcast_bytes=settings.broadcast_bytes,
        carried=carried,
    )
    return score_diff(scores, metric, by=["side"], carried=carried)


def _complete(sides: tuple[str, ...], value: Column) -> Column:
    """A pair's value, or an error if not all sides have a score."""
    missing = F.raise_error(F.concat(F.lit("a side has no score in segment "), F.col("seg_id")))
    all_there = F.count("diff") == len(sides)
    return F.when(all_there, value).otherwise(missing.cast("double"))


def sum_sides(diffs: DataFrame, sides: tuple[str, ...], carried: Sequence[str] = ()) -> DataFrame:
    """``seg_id, score``: the differences of all sides of a pair added up, in one narrow
    aggregation. A pair that lacks a side is an error."""
    total = _complete(sides, rounded(F.sum("diff")))
    return diffs.groupBy("seg_id", *carried).agg(total.alias("score")).select("seg_id", "score", *carried)


def score_pairs(
    general: DataFrame,
    models: DataFrame,
    sides: tuple[str, ...],
    metric: str = "logprob",
    settings: Settings = Settings(),
    carried: Sequence[str] = (),
) -> DataFrame:
    """``seg_id, score`` of every pair, and the columns ``carried``."""
    return sum_sides(side_diffs(general, models, sides, metric, settings, carried), sides, carried)


def select(
    general: DataFrame | Corpus,
    specific: DataFrame | Corpus | None = None,
    rank_src: bool = True,
    rank_tgt: bool = True,
    metric: str = "logprob",
    sample: str | DataFrame = "first",
    settings: Settings = Settings(),
    top: int | None = None,
    models: Models | None = None,
) -> DataFrame:
    """Rank the general pairs, most in-domain first, without repeats.

    Takes pair frames or opened corpora and returns a pair frame with ``rank, score, seg_id,
    src, tgt``, for the ``top`` pairs only if given. ``sample`` is ``first``, ``random``, or the
    drawn pairs. With ``models``, made by ``fit`` and kept or not, nothing is trained, and the
    specific corpus is not needed; models of other sides or settings are an error.

    The general texts are read once for scores, digests and the order of ties, and once to put
    them to their ranks; a third time only where whole texts have to break ties. The sample
    reads the files it needs if the corpus was opened by ``open_corpus``.
    """
    sides = rank_mode(rank_src, rank_tgt)
    if models is not None:
        trained = _fitting(models, sides, settings)
    elif specific is not None:
        trained = train_models(general, specific, sides, sample, settings)
    else:
        raise ValueError("either a specific corpus or models are needed")
    pairs = pairs_of(general)
    keyed = score_pairs(fingerprints(pairs), trained, sides, metric, settings, PRINTS)
    ranks = rank_keys(
        keyed,
        pairs,
        ascending=metric == "perplexity",
        top=top,
        tie_rows=settings.tie_rows,
        broadcast_bytes=settings.broadcast_bytes,
    )
    return attach_ranks(pairs, ranks, top, settings.broadcast_bytes)
