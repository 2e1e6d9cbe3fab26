import random
from fractions import Fraction

import pytest
from conftest_llm import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tamis.llm.mixing import mix, mixed_documents, op10_mixing, period, phases

WEIGHTS = {"src0": 3, "src1": 2, "src2": 1}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=6))
def test_a_period_keeps_every_window(weights):
    blocks, total = period(weights), sum(weights)
    assert sorted(slot for own in blocks for slot, _, _ in own) == list(range(total))
    for own, w in zip(blocks, weights):
        for k, (slot, release, deadline) in enumerate(own):
            assert release == k * total // w and deadline == -(-(k + 1) * total // w)
            assert release <= slot < deadline
        for t in range(total + 1):
            had = sum(slot < t for slot, _, _ in own)
            assert abs(had - Fraction(w * t, total)) < 1


def simulated(counts, weights):
    """Block by block: the order of groups, each slot the released block with the earliest
    deadline, and weights anew when a group has run out."""
    left, out = dict(counts), []
    while any(left.values()):
        active = sorted(g for g in left if left[g])
        total = sum(weights[g] for g in active)
        had, t = dict.fromkeys(active, 0), 0
        while all(left[g] for g in active):
            ready = [
                (-(-(had[g] + 1) * total // weights[g]), g) for g in active if had[g] * total // weights[g] <= t
            ]
            g = min(ready)[1]
            out.append(g)
            had[g] += 1
            left[g] -= 1
            t += 1
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 40)), min_size=1, max_size=5))
def test_phases_match_a_simulation(groups):
    weights = {g: w for g, (w, _) in enumerate(groups)}
    counts = {g: n for g, (_, n) in enumerate(groups)}
    order = simulated(counts, weights)
    slots = {}
    for phase in phases(counts, weights):
        total = sum(phase.weights.values())
        for g, n in phase.blocks.items():
            for k in range(n):
                w = phase.weights[g]
                slots[phase.start + k // w * total + phase.layout[g][k % w][0]] = g
    assert [slots[t] for t in range(len(order))] == order


def check(found, block_rows):
    assert sorted(r.position for r in found) == list(range(len(found)))
    by_slot = {}
    for r in sorted(found, key=lambda r: r.position):
        by_slot.setdefault(r.slot, []).append(r)
        assert r.release <= r.slot < r.deadline
    assert sorted(by_slot) == list(range(len(by_slot)))
    assert list(by_slot) == sorted(by_slot)
    assert all(len({(r.mix_group, r.block) for r in rows}) == 1 and len(rows) <= block_rows for rows in by_slot.values())
    return [rows[0].mix_group for rows in by_slot.values()]


def expected_groups(rows, weights, others, block_rows, pooled=False):
    """The order of sources by the simulation."""
    found = {r[2] for r in rows} - set(weights)
    rest = [None] if pooled else sorted(found, key=lambda name: (name is None, name or ""))
    groups = [*weights, *rest]
    own = [name if name in weights or not pooled else None for _, _, name in rows]
    share = [w * max(len(rest), 1) for w in weights.values()] + [others] * len(rest)
    counts = {g: -(-own.count(name) // block_rows) for g, name in enumerate(groups)}
    return [groups[g] for g in simulated(counts, dict(enumerate(share)))]


def mixed_rows(n=300):
    rng = random.Random(6)
    # A source without a weight whose rows lie together, and others dealt at random.
    return [
        (i, "x", "own" if 40 <= i < 90 else rng.choice(["src0"] * 6 + ["src1", "src2", "src7", "src8", None]))
        for i in range(n)
    ]


@pytest.mark.parametrize("block_rows", [1, 4])
def test_rows_match_the_simulation(spark, block_rows):
    rows = mixed_rows()
    found = mix(documents(spark, rows), "source", ["doc_id"], WEIGHTS, 2, block_rows).collect()
    assert all(r.mix_group == r.source for r in found)
    assert check(found, block_rows) == expected_groups(rows, WEIGHTS, 2, block_rows)


def test_every_source_keeps_within_a_block_of_its_share(spark):
    rows = mixed_rows()
    order = check(mix(documents(spark, rows), "source", ["doc_id"], WEIGHTS, 2, 1).collect(), 1)
    names = set(order)
    others = len(names - set(WEIGHTS))
    share = {s: Fraction(WEIGHTS[s] * others if s in WEIGHTS else 2) for s in names}
    total = sum(share.values())
    # Until the first source has run out; later phases are those of the simulation.
    stop = min(len(order) - order[::-1].index(s) for s in names)
    for t in range(stop + 1):
        assert all(abs(order[:t].count(s) - share[s] * t / total) < 1 for s in names)


def test_more_sources_than_have_a_group_are_mixed_as_one(spark, monkeypatch):
    monkeypatch.setattr("tamis.llm.mixing.OWN_SOURCES", 3)
    rows = mixed_rows()
    found = mix(documents(spark, rows), "source", ["doc_id"], WEIGHTS, 2, 4).collect()
    assert check(found, 4) == expected_groups(rows, WEIGHTS, 2, 4, pooled=True)


@pytest.mark.parametrize("block_rows", [1, 4])
def test_sources_of_one_group_take_turns(spark, monkeypatch, block_rows):
    """More sources than have a group: each keeps within a block of its share of the group's rows."""
    monkeypatch.setattr("tamis.llm.mixing.OWN_SOURCES", 3)
    rows = mixed_rows()
    found = mix(documents(spark, rows), "source", ["doc_id"], WEIGHTS, 2, block_rows).collect()
    pooled = [r for r in sorted(found, key=lambda r: r.position) if r.mix_group is None]
    of = {}
    for i, _, name in sorted(rows):
        if name not in WEIGHTS:
            of.setdefault(name, []).append(i)
    expected = sorted((at // block_rows, name is None, name or "", i) for name, ids in of.items() for at, i in enumerate(ids))
    assert len(of) == 4 and [r.doc_id for r in pooled] == [i for *_, i in expected]
    stop = len(of) * (min(map(len, of.values())) // block_rows) * block_rows  # while all sources have blocks
    for t in range(0, stop, block_rows):
        had = [sum(r.source == name for r in pooled[:t]) for name in of]
        assert all(abs(n - Fraction(t, len(of))) < block_rows for n in had)


def test_odd_rows(odd):
    found = op10_mixing(odd).collect()
    assert len(found) == len(ODD)
    check(found, 8)


def test_documents_are_stored_in_the_order_of_the_mixture(spark, tmp_path):
    rows = [(i, f"text {i}", f"src{i % 6}") for i in range(200)] + ODD
    docs = documents(spark, rows)
    out = str(tmp_path / "mixed")
    mixed_documents(docs).write.parquet(out)
    place = {r.doc_id: r.position for r in op10_mixing(docs.where("doc_id >= 8")).collect()}
    back = spark.read.parquet(out)
    assert back.columns == docs.columns and back.count() == len(rows)
    ordered = back.select("*", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index").collect()
    assert {r.doc_id for r in ordered} == {d for d, *_ in rows}
    full = mix(docs.select("doc_id", "source"), "source", ["doc_id"]).collect()
    named = {}
    for r in full:
        named.setdefault(r.doc_id, []).append(r.position)
    for at, r in enumerate(ordered):
        assert at in named[r.doc_id]
    assert place


def test_a_source_without_rows_and_an_empty_table(spark, none):
    assert op10_mixing(none).collect() == []
    found = mix(documents(spark, [(1, "x", "src1")]), "source", ["doc_id"], WEIGHTS).collect()
    assert [(r.slot, r.position) for r in found] == [(0, 0)]
    with pytest.raises(ValueError):
        mix(none, "source", ["doc_id"], {"src0": 0})
