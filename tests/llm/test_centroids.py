import hashlib
import itertools

import numpy as np
import pytest

from tamis.llm import centroids as M

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, place int, `a.b` int, _metadata int"


def table(spark, rows):
    """Columns beyond the first have names that the operator uses itself."""
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA)


def brute(rows, width=64, clusters=8, rounds=10):
    kept = [
        (vec_id, [int(np.floor(1024 * float(np.float32(x)))) for x in v])
        for vec_id, v in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)
    ]
    digest = lambda vec_id: hashlib.sha256(f"3:{vec_id}".encode()).hexdigest()
    centroids = [v for _, v in sorted((digest(i), v) for i, v in kept if i is not None)[:clusters]]
    if not centroids:
        return []

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        of = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (k, _) in zip(kept, of) if k == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    of = assign()
    inertia = [sum(d for k, d in of if k == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia), sha[k]) for (i, _), (k, d) in zip(kept, of)), key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def vectors(n, seed, groups=12, spread=0.1, width=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (groups, width))
    return [(i, (centres[rng.integers(groups)] + rng.normal(0, spread, width)).astype(np.float32).tolist()) for i in range(n)]


def test_odd_rows(spark):
    given = vectors(40, 1)
    same = given[0][1]
    given += [(None, same), (None, None), (41, None), (42, []), (43, same[:63]), (44, [*same, 1.0])]
    given += [(45, [None, *same[1:]]), (46, [float("nan"), *same[1:]]), (47, [float("-inf"), *same[1:]])]
    given += [(5, same), (5, same), (5, given[7][1])]
    found = rows(M.op13_centroids(table(spark, given)))
    assert found == brute(given) and len(found) == 44


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_matches_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    given = vectors(700, 2, spread=spread)
    assert rows(M.op13_centroids(table(spark, given).repartition(3))) == brute(given)


def test_one_vector_for_half_of_all_rows(spark):
    given = vectors(400, 3)
    given = [(i, given[0][1] if i % 2 else v) for i, v in given]
    assert rows(M.op13_centroids(table(spark, given))) == brute(given)


def test_few_and_no_rows(spark):
    given = vectors(3, 4)
    assert rows(M.op13_centroids(table(spark, given))) == brute(given)
    assert M.op13_centroids(table(spark, [])).collect() == []
    assert M.op13_centroids(table(spark, [(None, given[0][1]), (1, None)])).collect() == []


def test_ties_go_to_the_smaller_number(spark):
    low, high, middle = [0.0] * 64, [1.0] * 64, [0.5] * 64
    given = [(i, v) for i, v in enumerate([low, high] + [middle] * 6)]
    assert rows(M.op13_centroids(table(spark, given))) == brute(given)


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_goes_through_every_cell_in_single_steps(n, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
    places = [p.tobytes() for p in M.curve_places(cells, bits)]
    assert len(set(places)) == len(cells)
    walked = cells[sorted(range(len(cells)), key=places.__getitem__)]
    assert (abs(np.diff(walked, axis=0)).sum(1) == 1).all()


def test_candidates_hold_every_nearest_and_few_others():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-1000, 1000, (8, 6))
    low = rng.integers(-1000, 1000, (300, 6))
    high = low + rng.integers(0, 300, (300, 6))
    possible = M.candidate_centroids(low, high, centroids)
    for _ in range(50):
        v = rng.integers(low, high + 1)
        d = ((v[:, None] - centroids) ** 2).sum(2)
        assert possible[d == d.min(1)[:, None]].sum() == (d == d.min(1)[:, None]).sum()
    assert possible.mean() < 0.5
