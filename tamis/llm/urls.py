"""URL filter: fixed rules first, then a likelihood ratio of two character language models.

URLs that a rule decides teach two variable-order Markov models, one of accepted and one of
rejected URLs. The probability of a character after a context of up to four is smoothed with
that after the next shorter one:

    P(c | context) = (n(context c) + M P(c | shorter)) / (n(context) + M)

Taking logarithms, the difference of both models telescopes into one weight per gram: what the
gram adds as a prediction, and the factor it leaves as the context of the next character. So a
URL's score is the sum of the weights of its grams, one lookup each. Weights are whole
millionths, and sums do not depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import fold_of, lower_ascii
from tamis.sources.staging import fits_broadcast, materialize

GRAM = 5  # longest gram: a character after four others
SMOOTHING = 2.0
ALPHABET = 256.0
MILLION = 1_000_000
BIN = 10_000  # millionths per bin when the cut is searched: 0.01 nats per character
WIDEST = 2_000  # bins on either side of zero
CALIBRATION = 0  # this fold of the decided URLs finds the cut; the others train the models
WEIGHT_BYTES = 64 * 1024 * 1024  # counted size up to which the weights are broadcast
# They mark the start and the end of a URL.
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for no ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.expr("substring(u, instr(u, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    return (
        lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1)),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    )


def longest_rule(rules: tuple[UrlRule, ...], host: str, path: str, of) -> Column:
    """``of`` the longest rule that fits; null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    out = None
    for rule in ordered:
        fits = (
            (F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)
        ) & F.col(path).startswith(rule.path)
        out = F.when(fits, F.lit(of(rule))) if out is None else out.when(fits, F.lit(of(rule)))
    return F.lit(None).cast("string") if out is None else out


def parsed_pages(pages: DataFrame, page_id: str, url: str, rules: tuple[UrlRule, ...]) -> DataFrame:
    """``uid``, ``page_id``, ``host``, ``path``, ``rule``, ``decided``; written once, as the
    rows are read several times and need an identity of their own."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("u"))
    host, path = split_url(F.col("u"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path")).select(
        "*",
        longest_rule(rules, "host", "path", lambda r: r.name).alias("rule"),
        longest_rule(rules, "host", "path", lambda r: r.verdict).alias("decided"),
        F.monotonically_increasing_id().alias("uid"),
    )
    return materialize(rows, "urls")


def grams(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``gram`` for every gram of 1 to ``GRAM`` characters of every URL."""
    marked = F.concat(F.lit(START), "host", "path", F.lit(END))
    # All characters once, then for each end the suffixes of what stands there.
    letters = F.split(marked, "")
    shifted = [letters] + [
        F.concat(F.array_repeat(F.lit(None).cast("string"), k), letters) for k in range(1, GRAM)
    ]
    windows = F.arrays_zip(*[c.alias(f"t{k}") for k, c in enumerate(shifted)])
    at = rows.select(*keep, F.explode(windows).alias("w")).where(F.col("w.t0").isNotNull())
    endings = [
        F.concat(*[F.col(f"w.t{j}") for j in range(k, -1, -1)]) for k in range(GRAM)
    ]
    return at.select(*keep, F.explode(F.array_compact(F.array(*endings))).alias("gram"))


def gram_weights(decided: DataFrame) -> DataFrame:
    """``gram``, ``weight``: millionths that an occurrence adds to accepted over rejected.

    The empty gram holds what every character adds.
    """
    accepted, rejected = F.col("decided") == "allow", F.col("decided") == "block"
    counted = materialize(
        grams(decided, "decided")
        .groupBy("gram")
        .agg(
            F.sum(accepted.cast("long")).alias("a"),
            F.sum(rejected.cast("long")).alias("r"),
        ),
        "url-grams",
    )
    # How often a context is followed by something: all its occurrences, but for an end.
    contexts = (
        counted.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("context"))
        .agg(F.sum("a").alias("ca"), F.sum("r").alias("cr"))
    )
    contexts = materialize(contexts, "url-contexts")

    def p(n: str, c: str, shorter: Column) -> Column:
        return (F.col(n) + F.lit(SMOOTHING) * shorter) / (F.col(c) + F.lit(SMOOTHING))

    def left(c: str) -> Column:
        return F.lit(SMOOTHING) / (F.col(c) + F.lit(SMOOTHING))

    levels: list[DataFrame] = []
    for n in range(1, GRAM + 1):
        at = counted.where(F.length("gram") == n).join(
            contexts, F.expr("substring(gram, 1, length(gram) - 1)") == F.col("context")
        )
        if n == 1:
            at = at.withColumn("sa", F.lit(1 / ALPHABET)).withColumn("sr", F.lit(1 / ALPHABET))
        else:
            shorter = levels[-1].select(
                F.col("gram").alias("suffix"), F.col("pa").alias("sa"), F.col("pr").alias("sr")
            )
            at = at.join(shorter, F.expr("substring(gram, 2)") == F.col("suffix"))
        at = at.select(
            "gram", "ca", "cr", "sa", "sr",
            p("a", "ca", F.col("sa")).alias("pa"),
            p("r", "cr", F.col("sr")).alias("pr"),
        )
        levels.append(materialize(at, f"url-level-{n}"))
    added = F.log(F.col("pa") / (left("ca") * F.col("sa"))) - F.log(
        F.col("pr") / (left("cr") * F.col("sr"))
    )
    predicted = reduce(DataFrame.unionByName, levels).select("gram", added.alias("w"))
    factor = F.log(left("ca")) - F.log(left("cr"))
    left_over = contexts.select(F.col("context").alias("gram"), factor.alias("w"))
    both = predicted.unionByName(left_over).select(
        "gram", F.round(F.col("w") * MILLION).cast("long").alias("part")
    )
    return materialize(both.groupBy("gram").agg(F.sum("part").alias("weight")), "url-weights")


def scored_urls(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """``uid``, ``total`` (millionths) and ``n`` (characters with both marks)."""
    every = weights.where(F.col("gram") == "").first()
    base = every["weight"] if every else 0
    table = F.broadcast(weights) if fits_broadcast(weights, WEIGHT_BYTES) else weights
    found = grams(rows, "uid").join(table, "gram").groupBy("uid").agg(F.sum("weight").alias("sum"))
    n = (F.length("host") + F.length("path") + 2).cast("long")
    return rows.select("uid", n.alias("n")).join(found, "uid", "left").select(
        "uid", "n", (F.coalesce("sum", F.lit(0)) + F.col("n") * base).cast("long").alias("total")
    )


def best_cut(scored: DataFrame) -> int | None:
    """The score per character, in bins, from which URLs are allowed: that with the least sum
    of the shares wrongly blocked and wrongly allowed among the URLs kept for calibration; of
    several the lowest. None if one kind is missing."""
    kept = scored.where(F.col("decided").isNotNull() & (fold_of(F.col("page_id")) == CALIBRATION))
    counts = {
        r["bin"]: (r["good"], r["bad"])
        for r in kept.groupBy("bin")
        .agg(
            F.sum((F.col("decided") == "allow").cast("long")).alias("good"),
            F.sum((F.col("decided") == "block").cast("long")).alias("bad"),
        )
        .collect()  # at most 2 * WIDEST + 1 rows
    }
    good, bad = (sum(c[i] for c in counts.values()) for i in (0, 1))
    if not good or not bad:
        return None
    best, cut = None, None
    lost, passed = 0, bad  # allowed from the lowest bin on
    for at in sorted(counts):
        error = lost * bad + passed * good
        if best is None or error < best:
            best, cut = error, at
        lost += counts[at][0]
        passed -= counts[at][1]
    return cut


def judge_urls(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: tuple[UrlRule, ...] = RULES,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` of every page.

    ``score`` is the log-likelihood ratio per character (nats, to a millionth) for every URL;
    it decides those that no rule does. If the rules decide no URL of one kind, there is
    nothing to learn from, and undecided URLs are allowed. Null and unparsable URLs are scored
    as empty. Repeated rows are judged alike.
    """
    rows = parsed_pages(pages, page_id, url, rules)
    training = rows.where(
        F.col("decided").isNotNull() & (fold_of(F.col("page_id")) != CALIBRATION)
    )
    weights = gram_weights(training)
    per_letter = F.expr(f"greatest(least(floor(total / n / {BIN}), {WIDEST}), -{WIDEST})").cast("int")
    scored = materialize(
        rows.join(scored_urls(rows, weights), "uid").withColumn("bin", per_letter), "url-scores"
    )
    cut = best_cut(scored)
    learned = F.when(F.lit(cut is None) | (F.col("bin") >= (cut or 0)), "allow").otherwise("block")
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("decided", learned).alias("verdict"),
        (F.round(F.col("total") / F.col("n")) / MILLION).alias("score"),
    )


def op7_urls(pages: DataFrame) -> DataFrame:
    """The verdict on every page by the production rules and the learned models."""
    return judge_urls(pages).drop("score")
