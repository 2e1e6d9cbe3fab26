"""Secrets in texts, by regular expressions behind a trigram inverted index.

Each rule's expression implies a Boolean query: trigrams that any text with a match must hold.
Documents are indexed by the trigrams that the queries name, the postings are intersected, and
only the candidates of a rule are searched with its expression. A rule that implies no trigram
is run over every text.
"""

from __future__ import annotations

import re._parser as expressions
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import FILE, ROW, in_files, stored, text_of
from tamis.sources.staging import fits_broadcast, materialize

# Counted size up to which the table of candidates is broadcast; beyond it, it is shuffled.
CANDIDATE_BYTES = 64 * 1024 * 1024
# Strings that a part of an expression may stand for before the query is cut there.
EXPANSIONS = 64

Clause = frozenset[frozenset[str]]  # alternatives, each a set of trigrams that occur together


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping; those whose ``group`` is shorter
    than ``least`` are dropped, but the text they cover is used up."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


# The base rules, then rules for other well-known forms of credentials.
BASE_RULES = (
    Rule(
        "assign",
        f"({either_case('password|passwd|secret|token|api_?key')})"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    # Both take up all that follows, so the least length can stand in the expression: 16 and 32.
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", "xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _strings(node: tuple) -> set[str] | None:
    """All lower-cased strings a node of a parsed expression matches; None if many."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        found: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                found.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < EXPANSIONS:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "BRANCH":
        parts = [_sequence(branch) for branch in arg[1]]
        return None if None in parts else _limited(set().union(*parts))
    if op == "MAX_REPEAT":
        least, most, inner = arg
        once = _sequence(inner)
        if once is None or most > 8:
            return None
        out, power = set(), {""}
        for times in range(most + 1):
            out |= power if times >= least else set()
            power = {a + b for a in power for b in once}
            if len(power) > EXPANSIONS:
                return None
        return _limited(out)
    return None


def _limited(strings: set[str]) -> set[str] | None:
    return strings if len(strings) <= EXPANSIONS else None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        part = _strings(node)
        if part is None or len(out) * len(part) > EXPANSIONS:
            return None
        out = {a + b for a in out for b in part}
    return out


def trigram_query(pattern: str) -> list[Clause]:
    """What a text with a match must hold, in any letter case: of every clause, all trigrams
    of at least one alternative. An empty list if the expression implies nothing."""
    clauses: list[Clause] = []

    def close(strings: set[str]) -> None:
        if all(len(s) >= 3 for s in strings):
            sets = {trigrams(s) for s in strings}
            clauses.append(frozenset(a for a in sets if not any(b < a for b in sets)))

    def walk(nodes) -> None:
        held = {""}
        for node in nodes:
            part = _strings(node)
            if part is not None and len(held) * len(part) <= EXPANSIONS:
                held = {a + b for a in held for b in part}
                continue
            close(held)
            held = {""} if part is None else part
            if part is None and str(node[0]) == "SUBPATTERN":
                walk(node[1][3])
            elif part is None and str(node[0]) == "MAX_REPEAT" and node[1][0] > 0:
                walk(node[1][2])
        close(held)

    walk(expressions.parse(pattern))
    return list(dict.fromkeys(clauses))


def trigram_postings(docs: DataFrame, wanted: list[str], doc_id: str, text: str) -> DataFrame:
    """``trigram``, ``doc_id``: the index, for the trigrams that some query names."""
    lowered = F.lower(text_of(text))
    present = F.array_compact(
        F.array(*[F.when(F.contains(F.col("t"), F.lit(g)), F.lit(g)) for g in wanted])
    )
    return docs.select(F.col(doc_id).alias("doc_id"), lowered.alias("t")).select(
        F.explode(present).alias("trigram"), "doc_id"
    )


def candidates(postings: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """``doc_id``, ``kinds``: the rules whose query a document satisfies, by intersecting the
    postings. Only documents with at least one rule. Rows that share an id share a candidate."""
    held = postings.groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))

    def satisfied(clauses: list[Clause]) -> Column:
        def together(alternative: frozenset[str]) -> Column:
            return reduce(
                Column.__and__, [F.array_contains("held", g) for g in sorted(alternative)]
            )

        def clause(alternatives: Clause) -> Column:
            return reduce(Column.__or__, [together(a) for a in sorted(alternatives, key=sorted)])

        return reduce(Column.__and__, [clause(c) for c in clauses])

    kinds = F.array_compact(
        F.array(*[F.when(satisfied(q), F.lit(kind)) for kind, q in queries.items()])
    )
    return held.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def find_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per secret: ``FILE``, ``ROW`` (the row it is in), ``kind``, ``rank`` (place of the
    rule in ``rules``), ``start``, ``stop`` (characters of the text, end exclusive), ``secret``.

    A null or empty text has none. Repeated rows each have their own.
    """
    rows = stored(docs, doc_id, text).select(
        F.col(doc_id).alias("doc_id"), text_of(text).alias("text"), FILE, ROW
    )
    queries = {rule.kind: q for rule in rules if (q := trigram_query(rule.pattern))}
    wanted = sorted({g for q in queries.values() for clause in q for a in clause for g in a})
    found = materialize(
        candidates(trigram_postings(docs, wanted, doc_id, text), queries), "secret-candidates"
    ).select(F.col("doc_id").alias("id"), "kinds")
    if fits_broadcast(found, CANDIDATE_BYTES):
        found = F.broadcast(found)
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left")

    none = F.array().cast("array<string>")
    matched = []
    for rank, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        wholes = F.regexp_extract_all("text", pattern, F.lit(0))
        if rule.kind in queries:
            candidate = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
            wholes = F.when(candidate, wholes).otherwise(none)
        matched.append(wholes.alias(f"m{rank}"))
    rows = rows.select(FILE, ROW, "text", *matched)

    # The pieces between matches give their places: each match starts where the pieces and
    # matches before it end.
    def listed(rank: int, rule: Rule) -> Column:
        any_match = F.size(f"m{rank}") > 0
        pieces = F.when(any_match, F.split("text", rule.pattern, -1))
        groups = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
        zipped = F.arrays_zip(
            F.col(f"m{rank}").alias("secret"),
            pieces.alias("piece"),
            F.when(any_match, groups).alias("tested"),
        )

        def hit(z: Column, i: Column) -> Column:
            return F.struct(
                F.lit(rank).alias("rank"),
                i.alias("i"),
                z["secret"].alias("secret"),
                F.length(z["piece"]).cast("long").alias("gap"),
                (F.length(z["tested"]) >= rule.least).alias("holds"),
            )

        return F.transform(F.filter(zipped, lambda z: z["secret"].isNotNull()), hit)

    parts = [F.coalesce(listed(k, rule), F.array()) for k, rule in enumerate(rules)]
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    hits = rows.where(
        reduce(Column.__or__, [F.size(f"m{rank}") > 0 for rank in range(len(rules))])
    ).select(FILE, ROW, F.explode(F.concat(*parts)).alias("hit"))
    upto = W.partitionBy(FILE, ROW, "rank").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    size = F.length("secret").cast("long")
    return (
        hits.select(FILE, ROW, "hit.*")
        .withColumn("stop", F.sum(F.col("gap") + size).over(upto))
        .where("holds")
        .select(
            FILE,
            ROW,
            F.element_at(kinds, F.col("rank") + 1).alias("kind"),
            "rank",
            (F.col("stop") - size).alias("start"),
            "stop",
            "secret",
        )
    )


def op9_secrets(docs: DataFrame) -> DataFrame:
    """Per document, the number of base secrets by kind and the places of all secrets.

    Documents without any have zeros, the digest of the empty string and an empty ``spans``.
    """
    docs = in_files(docs, "doc_id", "text")
    base = [rule.kind for rule in BASE_RULES]
    place = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("stop").cast("string"))
    by_row = (
        find_secrets(docs)
        .groupBy(FILE, ROW)
        .agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", place.alias("place")))).alias("all"))
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == kind))

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: s["place"]))

    summed = by_row.select(
        FILE,
        ROW,
        *[count(kind).cast("long").alias(f"n_{kind}") for kind in base],
        joined(F.filter("all", lambda s: s["kind"].isin(base))).alias("base"),
        joined(F.col("all")).alias("spans"),
    )
    zero = F.lit(0).cast("long")
    return (
        stored(docs, "doc_id")
        .join(summed, [FILE, ROW], "left")
        .select(
            "doc_id",
            *[F.coalesce(f"n_{kind}", zero).alias(f"n_{kind}") for kind in base],
            F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
            F.coalesce("spans", F.lit("")).alias("spans"),
        )
    )
