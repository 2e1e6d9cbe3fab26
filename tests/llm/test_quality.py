import zlib

import numpy as np
import pytest
from conftest_llm import ODD, documents
from pyspark.sql import functions as F

from tamis.llm.quality import Fourier, isotonic, keep_good, op6_quality, statistics

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def scores(docs, labels):
    return {r.doc_id: r for r in op6_quality(docs, labels).collect()}


def test_held_out_labels_are_predicted_and_never_read(spark, tables):
    docs, labels = tables
    found = scores(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    held = [(found[d].predicted, q) for d, q in known.items() if found[d].held_out]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.95
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    turned = labels.withColumn("quality", F.when(fold == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = scores(docs, turned)
    assert all(abs(again[d].score - r.score) < 1e-9 for d, r in found.items())


def test_scores_equal_a_direct_fit(spark, tables):
    """Least squares by augmented rows instead of normal equations, and the isotonic fit by its
    min-max formula, over all rows at once."""
    docs, labels = tables
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    x = np.array([statistics(text) for _, text in rows])
    labels_of = {}
    for r in labels.collect():
        if r.quality is not None:
            labels_of.setdefault(r.doc_id, []).append(r.quality)
    fold = np.array([zlib.crc32(str(d).encode()) % 5 for d, _ in rows])
    y = np.array([np.mean(labels_of[d]) if d in labels_of else np.nan for d, _ in rows])

    scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1)
    drawn = Fourier.drawn(x.mean(axis=0), scale)
    z = np.clip((x - x.mean(axis=0)) / scale, -8, 8)
    features = np.sqrt(2 / 256) * np.cos(z @ drawn.directions + drawn.offsets)
    features = np.column_stack([features, np.ones(len(z))])

    fit = np.isin(fold, (1, 2, 3)) & ~np.isnan(y)
    ridge = np.sqrt(1e-4 * fit.sum()) * np.eye(257)
    above = np.vstack([features[fit], ridge])
    weights = np.linalg.lstsq(above, np.concatenate([y[fit], np.zeros(257)]), rcond=None)[0]
    raw = features @ weights

    held = (fold == 4) & ~np.isnan(y)
    place = np.minimum(((np.clip(raw[held], -0.5, 1.5) + 0.5) * 1000).astype(int), 1999)
    bins = np.unique(place)
    n = np.array([(place == b).sum() for b in bins])
    total = np.array([y[held][place == b].sum() for b in bins])
    k = len(bins)
    level = np.array([
        max(min(total[i : j + 1].sum() / n[i : j + 1].sum() for j in range(m, k)) for i in range(m + 1))
        for m in range(k)
    ])
    centre = (bins + 0.5) / 1000 - 0.5
    pools = [np.flatnonzero(level == value) for value in np.unique(level)]
    at = [np.average(centre[p], weights=n[p]) for p in pools]
    expected = 0.999 * np.interp(raw, at, [level[p[0]] for p in pools]) + 0.001 * np.clip(raw, 0, 1)

    found = scores(docs, labels)
    assert len(found) == len(rows)
    assert max(abs(found[d].score - e) for (d, _), e in zip(rows, expected)) < 1e-6
    assert all(found[d].predicted == int(e >= 0.3) for (d, _), e in zip(rows, expected) if abs(e - 0.3) > 1e-6)


def test_inputs_are_the_text_alone(spark, tables):
    docs, labels = tables
    same = docs.union(docs.select((F.col("doc_id") + 100_000).alias("doc_id"), "text", F.lit("xx"), F.lit("s"), "n_chars"))
    found = scores(same, labels)
    assert all(abs(found[d].score - found[d + 100_000].score) < 1e-12 for d in range(0, 1000, 7))


def test_odd_rows_and_labels(spark, odd):
    labels = spark.createDataFrame(
        [(2, 1, 0), (2, 0, 0), (3, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )
    for given in (labels, labels.where("false")):
        found = op6_quality(odd, given).collect()
        assert len(found) == len(ODD)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_keep_good_keeps_rows_as_they_are(spark, tables):
    docs, labels = tables
    docs = docs.withColumn("x", F.lit(1)).withColumn("score", F.lit(0.0))
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    good = {d for d, r in scores(docs, labels).items() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == good


def test_isotonic_is_the_monotone_fit():
    raw, level = isotonic(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 0, 1, 1.0]))
    assert np.all(np.diff(level) > 0) and np.allclose(level, [0, 1 / 3, 1])
    assert np.allclose(raw, [0, 2, 4.5])


def test_statistics_of_nothing():
    assert statistics(None) == statistics("") and np.isfinite(statistics(None)).all()


def test_empty_table(spark, none, tables):
    assert op6_quality(none, tables[1]).collect() == []
    assert len(op6_quality(documents(spark, [(1, "x")]), tables[1].where("false")).collect()) == 1
