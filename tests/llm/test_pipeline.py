"""The pipeline, stage by stage, against what each stage's operator says of its input."""

import corpus_pipeline
import pytest
from conftest_llm import ODD, documents
from pyspark.sql import functions as F
from test_jaccard_join import brute as near_brute

from tamis.llm.decontamination import op2_decontamination
from tamis.llm.quality import op6_quality


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of every stage on the smallest tables, each written and read again."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(stages):
    assert [name for name, _ in stages[1:]] == ["quality", "duplicates", "leaks", "mixture", "shards"]
    assert all(df.columns == stages[0][1].columns for _, df in stages[:-1])


def test_rejected_documents_go(spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    good = [r.doc_id for r in op6_quality(stages[0][1], labels).collect() if r.predicted]
    assert 0 < len(good) < stages[0][1].count() and ids(stages[1][1]) == sorted(good)


def test_one_of_each_group_stays(stages):
    names = {name for _, n, name in near_brute(pairs(stages[1][1])) if n}
    assert ids(stages[2][1]) == sorted(names) and len(names) < stages[1][1].count()


def test_leaks_go(spark, stages):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    clean = [r.doc_id for r in op2_decontamination(stages[2][1], items).collect() if not r.contaminated]
    assert ids(stages[3][1]) == sorted(clean) and len(clean) < stages[2][1].count()


def test_mixture_and_shards(stages):
    assert ids(stages[3][1]) == ids(stages[4][1]) == ids(stages[5][1])
    place = "_metadata.row_index"
    order = [
        r.doc_id
        for r in stages[4][1].select("doc_id", "_metadata.file_path", place).orderBy("file_path", "row_index").collect()
    ]
    shards = sorted(stages[5][1].collect(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in shards] == order
    sizes = [len(r.text.encode()) + 16 for r in shards]
    totals = [sum(n for n, r in zip(sizes, shards) if r.shard == s) for s in range(40)]
    assert max(totals) - sum(sizes) / 40 <= max(sizes)


def test_run_is_all_stages(spark, stages):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stages[-1][1].collect()))


NAMES = ["a.b", "Shard", "__file", "__row", "__position", "__size", "_metadata", "c1", "passages", "`", "component"]


def test_columns_of_any_name(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    plain_docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    named = plain_docs.select("*", *[F.concat(F.lit(name), F.col("doc_id")).alias(name) for name in NAMES])
    for name, stage in corpus_pipeline.STAGES:
        found = []
        for i, df in enumerate((plain_docs, named)):
            path = str(tmp_path / f"{name}-{i}")
            stage(spark, df, sf_dir).write.parquet(path)
            found.append(spark.read.parquet(path))
        plain_docs, named = found
        assert ids(named) == ids(plain_docs)
        kept = [n for n in NAMES if not (name == "shards" and n == "Shard")]
        assert set(named.columns) - set(plain_docs.columns) == set(kept)
        for row in named.collect():
            assert all(row[n] == f"{n}{row['doc_id']}" for n in kept)


def test_odd_and_empty_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    for rows in (ODD, []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = stage(spark, docs, sf_dir)
            assert name == "shards" or docs.columns == before
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() <= len(rows)
