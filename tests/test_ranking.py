import random

import brute
import pytest
from pyspark.sql import functions as F

from tamis.operators import ranking as R
from tamis.operators import sampling as N

SCHEMA = "seg_id long, score double, src string, tgt string"


def ranked_ids(frame, **settings):
    rows = R.rank(frame, **settings).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    return [r["seg_id"] for r in rows]


def check(spark, rows, **settings):
    frame = spark.createDataFrame(rows, SCHEMA)
    for ascending in (False, True):
        expected = brute.rank(rows, ascending)
        assert ranked_ids(frame, ascending=ascending, **settings) == expected


def test_repeats_ties_and_line_breaks(spark):
    rows = [
        (9, 1.0, "same", "x"), (4, 1.0, "same", "x"), (5, 1.0, "same", "x"),
        (1, 2.5, "a", "t"), (2, 2.5, "b", "t"), (3, 2.5, "b", "u"),
        (6, -3.0, "tab\there", ""), (7, -3.0, "line\nbreak", ""), (8, 0.0, "", ""),
    ]
    check(spark, rows)
    assert ranked_ids(spark.createDataFrame(rows, SCHEMA)) == [3, 2, 1, 4, 8, 6, 7]


def test_boundary_of_source_and_target(spark):
    # the texts joined end to end are alike, the pairs are not
    check(spark, [(1, 0.0, "ab", "c"), (2, 0.0, "a", "bc"), (3, 0.0, "", "abc"), (4, 0.0, "1:a", "b")])


def hot_rows():
    """Most rows share a score and a long beginning and differ only far behind it."""
    rng = random.Random(3)
    rows, seg_id = [], 0
    common = "Ω😀 common " * 40
    for i in range(120):
        rows.append((seg_id := seg_id + 1, 1.5, common + f"{i:03d}", "t"))
    for i in range(60):  # one source, many targets
        rows.append((seg_id := seg_id + 1, 1.5, common, "é" * 70 + chr(0x1F600 + i)))
    for i in range(40):  # each the beginning of the next
        rows.append((seg_id := seg_id + 1, 1.5, "x" * (i + 30), ""))
    for i in range(80):
        rows.append((seg_id := seg_id + 1, rng.choice([0.5, 1.5, 2.0]), f"text {rng.random()}", "t"))
    rows += [(seg_id + 1 + i, r[1], r[2], r[3]) for i, r in enumerate(rows[::7])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tie_rows", [100_000, 50, 4])
def test_hot_ties_are_split(spark, tie_rows):
    check(spark, hot_rows(), tie_rows=tie_rows)


def test_ties_are_split_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(R, "TIE_BYTES", 5000)
    check(spark, hot_rows())


def test_the_same_text_with_other_scores_stays(spark):
    check(spark, [(1, 1.0, "a", "x"), (2, 2.0, "a", "x"), (3, 2.0, "a", "x")])


@pytest.mark.parametrize("top", [0, 1, 5, 60, 10_000])
@pytest.mark.parametrize("ascending", [False, True])
def test_top_orders_the_best_only(spark, monkeypatch, top, ascending):
    frame = spark.createDataFrame(hot_rows(), SCHEMA)
    whole = brute.rank(hot_rows(), ascending)
    seen = []
    index = R.dense_index
    monkeypatch.setattr(R, "dense_index", lambda df, *rest: seen.append(df.count()) or index(df, *rest))
    ranks = R.rank_ids(
        frame.drop("score"), frame.select("seg_id", "score"), ascending, top=top
    )
    found = [r["seg_id"] for r in ranks.orderBy("rank").collect()]
    assert found == whole[:top]
    # no more rows are ordered than share the best scores
    scores = {r[0]: r[1] for r in hot_rows()}
    worst = scores[whole[min(top, len(whole)) - 1]] if top else None
    bound = sum((scores[i] <= worst) if ascending else (scores[i] >= worst) for i in whole) if top else 0
    assert seen == [bound]


def test_ties_without_broadcast(spark):
    check(spark, hot_rows(), broadcast_bytes=0)


def test_null_text_and_many_rows(spark):
    frame = spark.range(50000).select(
        F.col("id").alias("seg_id"),
        (F.col("id") % 997 / 10).alias("score"),
        F.concat(F.lit("t"), F.col("id") % 10007).alias("src"),
        F.lit("").alias("tgt"),
    )
    # equal texts have equal scores
    frame = frame.withColumn("score", F.round(F.abs(F.hash("src")) % 1000 / 7, 6))
    rows = [tuple(r) for r in frame.collect()]
    assert ranked_ids(frame) == brute.rank(rows)


def test_missing_score_is_an_error(spark):
    pairs = spark.createDataFrame([(1, "a", ""), (2, "b", "")], "seg_id long, src string, tgt string")
    scores = spark.createDataFrame([(1, 0.5)], "seg_id long, score double")
    with pytest.raises(Exception, match="no score for segment 2"):
        R.rank_ids(pairs, scores)


def test_scores_of_other_ids_are_an_error(spark):
    pairs = spark.createDataFrame([(i, f"s{i}", "t") for i in range(6)], "seg_id long, src string, tgt string")
    keyed = R.fingerprints(pairs).withColumn("score", F.col("seg_id") * 0.5)
    assert R.rank_keys(keyed, pairs).count() == 6
    # One id lost and another one doubled: as many rows as there should be.
    swapped = keyed.withColumn("seg_id", F.when(F.col("seg_id") == 4, F.lit(3)).otherwise(F.col("seg_id")))
    with pytest.raises(ValueError, match="not of the same ids"):
        R.rank_keys(swapped, pairs)
    with pytest.raises(ValueError, match="6 pairs, 5 scores"):
        R.rank_keys(keyed.filter("seg_id <> 2"), pairs)


def test_dedup_and_sort(spark):
    rows = [(3, 1.0, "a", "x"), (1, 1.0, "a", "x"), (2, 1.0, "b", "x"), (4, 2.0, "c", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = R.dedup_ranked(frame)
    assert sorted(r["seg_id"] for r in kept.collect()) == [1, 2, 4]
    assert [r["seg_id"] for r in R.sort_ranked(kept).collect()] == [4, 2, 1]
    assert [r["seg_id"] for r in R.sort_ranked(kept, ascending=True).collect()] == [1, 2, 4]


def test_top(spark):
    frame = spark.createDataFrame([(i, float(i), f"t{i}", "") for i in range(20)], SCHEMA)
    assert sorted(r["seg_id"] for r in N.top_n(R.rank(frame), 3).collect()) == [17, 18, 19]
    ranks = R.rank_ids(frame.drop("score"), frame.select("seg_id", "score"))
    for limit in (1 << 20, 0):
        few = R.attach_ranks(frame.drop("score"), ranks, 3, limit)
        assert sorted((r["rank"], r["seg_id"]) for r in few.collect()) == [(1, 19), (2, 18), (3, 17)]
