import numpy as np
import pytest

from tamis.llm import hard_negatives as M

SCHEMA = "vec_id long, embedding array<float>, label int, score long, slot int, `a.b` int, _metadata int"


def table(spark, rows):
    """Columns beyond the three have names that the operator uses itself."""
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def brute(rows, top=5):
    kept = []
    for vec_id, vector, label in rows:
        if vector is None or label is None or not all(x is not None and np.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    out = []
    for i, (vec_id, label, v) in enumerate(kept):
        if vec_id is None or vec_id % 100:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), other is None, other or 0, j, other, k)
            for j, (other, k, w) in enumerate(kept)
            if j != i
        ]
        scored.sort(key=lambda s: s[:4])
        for p in [s for s in scored if s[5] == label][:top]:
            found = [s for s in scored if s[5] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]]
            for rank, s in enumerate(found[:top], 1):
                out.append((vec_id, p[4], rank, s[4], -p[0], -s[0]))
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def clustered(n, width, seed, spread=0.3):
    """Vectors of several lengths around few directions, with repeats and ties."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, width))
    out = []
    for i in range(n):
        v = centres[i % 6] * rng.choice([0.2, 1, 3]) + rng.normal(0, spread, width)
        out.append((i, [float(np.float32(x)) for x in np.round(v, 1)], int(rng.integers(0, 4))))
    return out


ODD = [
    (None, [0.5, 0.5], 1),
    (100, None, 1),
    (100, [0.5, None], 1),
    (100, [float("nan"), 1.0], 1),
    (100, [float("inf"), 1.0], 1),
    (100, [0.5, 0.4], None),
    (100, [0.5, 0.4], 1),
    (100, [0.5, 0.4], 1),
    (200, [], 2),
    (200, [0.0, 0.0], 2),
    (300, [0.5], 3),
    (1, [0.5, 0.4, 0.1], 2),
    (2, [0.5, 0.4], 2),
    (3, [0.5, 0.4], 2),
    (None, [0.4, 0.4], 2),
    (4, [-0.5, -0.4], 1),
    (0, [-0.5, -0.4], 2),
]


def test_odd_rows(spark):
    assert rows(M.op11_hard_negatives(table(spark, ODD))) == brute(ODD)


@pytest.mark.parametrize(("dense", "bucket", "tile"), [(0.0, 16, 3), (2.0, 16, 512), (0.05, 1024, 512)])
def test_matches_brute_force(spark, monkeypatch, dense, bucket, tile):
    given = clustered(900, 5, 1)
    monkeypatch.setattr(M, "DENSE", dense)
    monkeypatch.setattr(M, "BUCKET", bucket)
    monkeypatch.setattr(M, "TILE", tile)
    found = rows(M.op11_hard_negatives(table(spark, given).repartition(3)))
    assert found and found == brute(given)


def test_rounds_of_anchors(spark):
    given = clustered(1500, 4, 2)
    moved = [(i, v, (k + 1) % 10 if i % 7 == 0 else k) for i, v, k in given]
    of = M.hard_negatives(table(spark, moved), "vec_id % 100 = 0", round_bytes=3000)
    assert rows(of) == brute(given)


def test_one_vector_for_a_third_of_all_rows(spark):
    given = clustered(600, 4, 3)
    same = [0.5, 0.25, -1.0, 0.125]
    given = [(i, same if i % 3 == 0 else v, k) for i, v, k in given]
    assert rows(M.op11_hard_negatives(table(spark, given))) == brute(given)


def test_pruning_keeps_what_is_needed_and_drops_the_rest():
    rng = np.random.default_rng(4)
    v = rng.normal(0, 100, (500, 6)).astype(np.int64)
    q = rng.normal(0, 100, (40, 6)).astype(np.int64)
    ids = np.arange(500)
    bucket = M.Bucket(ids, ids, np.zeros(500, bool), ids, v)
    anchors = M.Anchors(np.arange(40), np.arange(40), q)
    scores = q @ v.T
    need = np.sort(scores, 1)[:, -10]
    for dense in (0.0, 2.0):
        limit, M.DENSE = M.DENSE, dense
        a, row, score = bucket.pairs(anchors, np.arange(40), need)
        M.DENSE = limit
        expected = np.argwhere(scores >= need[:, None])
        assert sorted(zip(a, row)) == sorted(map(tuple, expected))
        assert (score == scores[a, row]).all()
    # More than the longest row can reach: the bucket is skipped.
    beyond = np.full(40, int(np.linalg.norm(v, axis=1).max() * np.linalg.norm(q, axis=1).max()) + 2)
    assert len(bucket.pairs(anchors, np.arange(40), beyond)[0]) == 0


def test_empty_table(spark):
    assert M.op11_hard_negatives(table(spark, [])).collect() == []
    assert M.op11_hard_negatives(table(spark, [(1, [1.0], 1)])).collect() == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="component beyond"):
        M.op11_hard_negatives(table(spark, [(100, [1e9], 1), (1, [1.0], 1)])).collect()
