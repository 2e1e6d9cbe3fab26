"""Sources interleaved by target weights with Pfair scheduling.

The rows of a source are cut into blocks of equal length. Block k of a source of weight w (its
share of all slots) may run from slot floor(k / w) and must have run by slot ceil((k + 1) / w).
In every slot the released block with the earliest deadline runs. On one resource whose weights
sum to one, that meets every deadline, and after t slots a source has had more than w t - 1 and
fewer than w t + 1 blocks.

Weights are whole numbers, so releases and deadlines repeat after as many slots as the weights
sum to. Only that one period is laid out step by step; every block's slot follows from it by
arithmetic, on all rows at once. When a source has no block left, the rest go on from there
with their weights relative to each other, in a new phase. No row is dropped or repeated.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import (
    FILE,
    PART,
    ROW,
    SEQ,
    in_order,
    plain,
    restored,
    stored,
    totals_before,
    with_places,
)
from tamis.sources.staging import fits_broadcast, materialize

# Production weights, and the weight that all sources not named share equally.
WEIGHTS: Mapping[str, int] = {"src0": 4, "src1": 2, "src2": 2, "src3": 1}
OTHERS_WEIGHT = 11
# So many sources not named, null included, have releases and deadlines among all slots. Where there
# are more, they are one group there, as the driver lays out a period of the weights, which grows with
# them; inside the group each has its own, see ``taking_turns``.
OWN_SOURCES = 32
BLOCK_ROWS = 8


def period(weights: Sequence[int]) -> list[list[tuple[int, int, int]]]:
    """For each source, (slot, release, deadline) of its blocks in one period.

    Earliest deadline first among released blocks; of equal deadlines the source listed first.
    """
    total = sum(weights)
    blocks: list[list[tuple[int, int, int]]] = [[] for _ in weights]
    waiting = sorted(
        (k * total // w, -(-(k + 1) * total // w), s) for s, w in enumerate(weights) for k in range(w)
    )
    ready: list[tuple[int, int, int]] = []
    taken = 0
    for slot in range(total):
        while taken < len(waiting) and waiting[taken][0] <= slot:
            release, deadline, s = waiting[taken]
            heapq.heappush(ready, (deadline, s, release))
            taken += 1
        deadline, s, release = heapq.heappop(ready)
        blocks[s].append((slot, release, deadline))
    return blocks


@dataclass(frozen=True)
class Phase:
    """A stretch of slots in which the same groups are active."""

    start: int  # first slot
    slots: int
    weights: dict[int, int]  # of the active groups
    first: dict[int, int]  # block with which each begins
    blocks: dict[int, int]  # how many each gets
    layout: dict[int, list[tuple[int, int, int]]]


def phases(counts: Mapping[int, int], weights: Mapping[int, int]) -> list[Phase]:
    """The phases until every group's blocks have run. ``counts``: blocks by group."""
    out: list[Phase] = []
    done = dict.fromkeys(counts, 0)
    start = 0
    while active := sorted(g for g in counts if done[g] < counts[g]):
        # Windows depend on the shares only; the least whole numbers have the shortest period.
        common = math.gcd(*[weights[g] for g in active])
        used = {g: weights[g] // common for g in active}
        total = sum(used.values())
        layout = dict(zip(active, period([used[g] for g in active])))

        def slot(g: int, k: int) -> int:
            return k // used[g] * total + layout[g][k % used[g]][0]

        slots = min(slot(g, counts[g] - done[g] - 1) for g in active) + 1
        rounds, rest = divmod(slots, total)
        blocks = {
            g: rounds * used[g] + sum(s < rest for s, _, _ in layout[g]) for g in active
        }
        out.append(Phase(start, slots, used, {g: done[g] for g in active}, blocks, layout))
        for g in active:
            done[g] += blocks[g]
        start += slots
    return out


def literals(spark: SparkSession, rows: list[tuple[int, ...]], names: str) -> DataFrame:
    """A few rows of whole numbers as a relation in the plan."""
    width = names.count(",") + 1
    values = ", ".join(f"({', '.join(f'{x}L' for x in row)})" for row in rows or [(0,) * width])
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})" + ("" if rows else " WHERE false"))


def groups_of(
    rows: DataFrame, source: str, weights: Mapping[str, int], others: int
) -> tuple[list[str | None], list[int], bool]:
    """Source and weight of every group, in the order that decides between equal deadlines: the
    named ones, then the others by name; null is last, as a source or for all others, which is told."""
    own = F.coalesce(F.col(source).isin(*weights), F.lit(False)) if weights else F.lit(False)
    found = rows.where(~own).select(F.col(source).alias("name")).distinct().limit(OWN_SOURCES + 1).collect()
    many = len(found) > OWN_SOURCES
    if many:
        rest: list[str | None] = [None]
    else:
        rest = sorted((r["name"] for r in found), key=lambda name: (name is None, name or ""))
    each = max(len(rest), 1)
    return [*weights, *rest], [w * each for w in weights.values()] + [others] * len(rest), many


def taking_turns(rows: DataFrame, source: str, order: Sequence[str], block_rows: int) -> DataFrame:
    """The rows of sources with equal weights with ``__turn``, the block of its source that a row is in.

    Among m sources of equal weights, block k of each may run from slot k m and must have run by slot
    (k + 1) m. Earliest deadline first is then to take turns: block k of every source that has one, in
    the order of their names, before block k + 1 of any. So slots follow from sorting, for any number
    of sources.
    """
    placed = in_order(rows, [F.col(source).asc_nulls_last(), *order], "turn-order")
    at = F.col("__before") + F.col(SEQ)
    indexed = placed.join(totals_before(placed, __before="*"), PART).withColumn("__at", at)
    firsts = indexed.groupBy(F.col(source).alias("__name")).agg(F.min("__at").alias("__first"))
    firsts = materialize(firsts, "turn-firsts")
    firsts = F.broadcast(firsts) if fits_broadcast(firsts) else firsts
    found = indexed.join(firsts, F.col(source).eqNullSafe(F.col("__name")))
    return found.select(*rows.columns, F.expr(f"(__at - __first) div {block_rows}").alias("__turn"))


def mix(
    rows: DataFrame,
    source: str,
    order: Sequence[str],
    weights: Mapping[str, int] = WEIGHTS,
    others: int = OTHERS_WEIGHT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Narrow ``rows`` with their place in the mixture.

    Added: ``mix_group`` (the source), ``block`` (of the source, from 0), ``release`` and
    ``deadline`` (slots), ``slot`` (of the block) and ``position`` (of the row, from 0 without
    gaps).

    A source without a weight, the null one included, has an equal share of ``others``. Where
    there are more than ``OWN_SOURCES`` of them, they are one group, whose ``mix_group`` is null and
    whose blocks are cut from the blocks of its sources as they take turns (``taking_turns``).

    Of a source rows follow ``order``, ties the place in the input. Only names of at most
    ``OWN_SOURCES`` sources and counts per group pass the driver. An empty table gives an empty
    mixture; a source named without rows has no part in it.
    """
    spark = rows.sparkSession
    if min([*weights.values(), others]) < 1:
        raise ValueError("weights are positive whole numbers")
    names, share, many = groups_of(rows, source, weights, others)
    # The last group is for what is not named, if there is such a group.
    pooled = F.lit(len(names) - 1 if names[-1:] == [None] else None).cast("int")
    number = F.coalesce(
        *[F.when(F.col(source).eqNullSafe(F.lit(name)), F.lit(g)) for g, name in enumerate(names)], pooled
    )
    grouped, by = rows.withColumn("__group", number), ["__group", *order]
    if many:
        among = F.col("__group") == len(names) - 1
        rest = taking_turns(grouped.where(among), source, order, block_rows)
        grouped = grouped.where(~among).withColumn("__turn", F.lit(0).cast("long")).unionByName(rest)
        by = ["__group", "__turn", F.col(source).asc_nulls_last(), *order]
    placed = in_order(grouped, by, "mix-order")
    before = totals_before(placed, __before="*")
    indexed = placed.join(before, PART).withColumn("__index", F.col("__before") + F.col(SEQ))
    # One row per group.
    groups = {
        r["__group"]: (r["rows"], r["first"])
        for r in indexed.groupBy("__group")
        .agg(F.count("*").alias("rows"), F.min("__index").alias("first"))
        .collect()
    }
    plan = phases({g: -(-n // block_rows) for g, (n, _) in groups.items()}, dict(enumerate(share)))

    # Small tables whose size depends on the weights alone: a row per phase and group, and a
    # row per phase and slot of its period.
    turns, layout = [], []
    for p, phase in enumerate(plan):
        total = sum(phase.weights.values())
        for g, w in phase.weights.items():
            if phase.blocks[g]:
                turns.append((p, g, phase.first[g], phase.first[g] + phase.blocks[g], w, total, phase.start))
                layout += [(p, g, k, *x) for k, x in enumerate(phase.layout[g])]
    turns_df = literals(spark, turns, "p, g, first, last, w, total, start")
    layout_df = literals(spark, layout, "p, g, k, l_slot, l_release, l_deadline")
    firsts = literals(spark, [(g, first) for g, (_, first) in groups.items()], "g, first_index")
    own = F.broadcast
    blocked = (
        indexed.join(own(firsts), F.col("__group") == F.col("g"))
        .drop("g")
        .withColumn("__inside", F.col("__index") - F.col("first_index"))
        .withColumn("block", F.expr(f"__inside div {block_rows}"))
        .join(
            own(turns_df),
            (F.col("__group") == F.col("g"))
            & (F.col("block") >= F.col("first"))
            & (F.col("block") < F.col("last")),
        )
        .withColumn("__k", F.col("block") - F.col("first"))
        .withColumn("__round", F.expr("start + (__k div w) * total"))
        .withColumn("__of", F.expr("__k % w"))
        .join(
            own(layout_df.withColumnsRenamed({"p": "lp", "g": "lg", "k": "lk"})),
            (F.col("p") == F.col("lp")) & (F.col("g") == F.col("lg")) & (F.col("__of") == F.col("lk")),
        )
        .withColumn("slot", F.col("__round") + F.col("l_slot"))
        .withColumn("release", F.col("__round") + F.col("l_release"))
        .withColumn("deadline", F.col("__round") + F.col("l_deadline"))
    )
    # A group's last block may be short by some rows; later slots move up by as many.
    last_slot = {}
    for phase in plan:
        for g in phase.weights:
            k = phase.blocks[g] - 1
            if phase.blocks[g]:
                total = sum(phase.weights.values())
                last_slot[g] = (
                    phase.start + k // phase.weights[g] * total + phase.layout[g][k % phase.weights[g]][0]
                )
    position = F.col("slot") * block_rows + F.expr(f"__inside % {block_rows}")
    for g, (n, _) in groups.items():
        if short := -n % block_rows:
            position = position - F.when(F.col("slot") > last_slot[g], short).otherwise(0)
    group = F.get(F.array(*[F.lit(name).cast("string") for name in names]), F.col("__group"))
    return blocked.select(
        *rows.columns, group.alias("mix_group"), "block", "release", "deadline", "slot",
        position.cast("long").alias("position"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Whole documents, their columns as they were, whatever their names, stored in the order of
    the mixture.

    The rows are range-partitioned by their position and sorted, so that the files, read in
    the order of their names, hold the mixture.
    """
    inner = plain(docs, "doc_id", "source")
    rows = stored(inner)
    narrow = rows.select(FILE, ROW, F.col("source").alias("__source"), F.col("doc_id").alias("__id"))
    places = mix(narrow, "__source", ["__id", FILE, ROW], **options)
    places = materialize(places.select(FILE, ROW, F.col("position").alias("__position")), "mixture")
    placed = with_places(rows, places)
    ordered = placed.repartitionByRange("__position").sortWithinPartitions("__position")
    return restored(ordered, inner, docs)


def op10_mixing(docs: DataFrame) -> DataFrame:
    """Every document's place in the mixture with the production weights."""
    narrow = materialize(docs.select("doc_id", "source"), "mix-rows")
    return mix(narrow, "source", ["doc_id", "source"])
