import os
import re

import brute
import pytest
from pyspark.sql import functions as F
from test_model import GENERAL, SPECIFIC, made_up

from tamis.catalog.corpora import dialogues, documents, segments
from tamis.operators import ngram_model as M
from tamis.operators import ranking as R
from tamis.operators import sampling as N
from tamis.operators import scoring as S
from tamis.operators import vocabulary as V
from tamis.plans import select as P
from tamis.sources import sinks
from tamis.sources.corpus import open_corpus
from tamis.sources.staging import materialize, new_path, scratch

OTHER = [f"v{i}" for i in range(30)]


def pair_rows(texts, seed):
    targets = made_up(seed, len(texts), OTHER)
    return [(10 * i + 3, text, target) for i, (text, target) in enumerate(zip(texts, targets))]


GENERAL_ROWS = pair_rows(GENERAL, 5)
GENERAL_ROWS += [(5000 + i, src, tgt) for i, (_, src, tgt) in enumerate(GENERAL_ROWS[::4])]
SPECIFIC_ROWS = pair_rows(SPECIFIC[:60], 6)


@pytest.fixture(scope="module")
def corpora(spark):
    schema = "seg_id long, src string, tgt string"
    return tuple(spark.createDataFrame(rows, schema) for rows in (GENERAL_ROWS, SPECIFIC_ROWS))


def expected(sides, metric="logprob"):
    sums = {}
    for side in sides:
        specific = [r[side] for r in SPECIFIC_ROWS]
        sample = [r[side] for r in sorted(GENERAL_ROWS)[: len(specific)]]
        vocab = brute.vocabulary(specific)
        models = [brute.train(texts, vocab) for texts in (specific, sample)]
        for row in GENERAL_ROWS:
            (n, s, _), (_, g, _) = (brute.score(row[side], m) for m in models)
            diff = s - g if metric == "logprob" else 10 ** (-s / n) - 10 ** (-g / n)
            sums[row[0]] = sums.get(row[0], 0.0) + round(diff, 6)
    rows = [(r[0], round(sums[r[0]], 6), r[1], r[2]) for r in GENERAL_ROWS]
    return brute.rank(rows, ascending=metric == "perplexity")


def ids(ranked):
    return [r["seg_id"] for r in ranked.orderBy("rank").collect()]


def test_both_sides(corpora):
    assert ids(P.select(*corpora)) == expected((1, 2))


def test_one_side(corpora):
    assert ids(P.select(*corpora, rank_tgt=False)) == expected((1,))


def test_perplexity_and_top(corpora):
    best = P.select(*corpora, rank_src=False, metric="perplexity", top=25)
    assert ids(best) == expected((2,), "perplexity")[:25]


def test_shuffled_joins_give_the_same(spark, corpora):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        settings = P.Settings(broadcast_bytes=0, tie_rows=2)
        assert ids(P.select(*corpora, settings=settings)) == expected((1, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_kept_models_give_the_same_and_train_nothing(spark, corpora, monkeypatch):
    general, specific = corpora
    path = new_path(spark, "kept")
    sinks.save_models(P.fit(*corpora), path)
    kept = sinks.load_models(spark, path)
    assert kept.sides == ("src", "tgt")
    trained = ids(P.select(*corpora))
    with monkeypatch.context() as m, scratch(spark) as folder:
        m.setattr(P, "train_models", None)
        m.setattr(P, "train_lm", None)
        assert ids(P.select(general, models=kept)) == trained
        assert ids(P.select(general, rank_tgt=False, models=kept)) == expected((1,))
        tables = {name.rsplit("-", 1)[0] for name in os.listdir(folder)}
    assert "weights" in tables and not tables & {"vocab", "adjusted", "contexts", "model"}
    with pytest.raises(ValueError, match="order"):
        P.select(general, models=kept, settings=P.Settings(order=3))
    with pytest.raises(ValueError, match="closed"):
        P.select(general, models=kept, settings=P.Settings(closed=True))
    with pytest.raises(ValueError, match="specific"):
        P.select(general)
    one = sinks.Models(kept.frame.filter("side = 'src'"), kept.order, kept.min_count, kept.closed)
    with pytest.raises(ValueError, match="tgt"):
        P.select(general, models=one)


def test_changed_or_unfinished_models_are_refused(spark, corpora, tmp_path):
    path = f"{tmp_path}/kept"
    models = P.fit(*corpora, rank_tgt=False)
    sinks.save_models(models, path)
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.save_models(models, path)
    sinks.save_models(models, path, mode="overwrite")
    assert sinks.load_models(spark, path).frame.count() == models.frame.count()
    sinks.save_model(models.frame.withColumn("bow", F.col("bow") + 1e-9), f"{tmp_path}/other")
    part = next(f for f in os.listdir(f"{path}/model=general/side=src") if f.endswith(".parquet"))
    os.remove(f"{path}/model=general/side=src/{part}")
    with pytest.raises(ValueError, match="manifest"):
        sinks.load_models(spark, path)
    with pytest.raises(FileNotFoundError, match="manifest"):
        sinks.load_models(spark, f"{tmp_path}/other")


def test_drawn_sample(corpora):
    general, specific = corpora
    drawn = general.orderBy("seg_id").limit(specific.count())
    assert ids(P.select(general, specific, rank_tgt=False, sample=drawn)) == expected((1,))


def test_wrong_parameters(corpora):
    with pytest.raises(ValueError, match="at least one"):
        P.select(*corpora, rank_src=False, rank_tgt=False)
    with pytest.raises(ValueError, match="sample"):
        P.select(*corpora, sample="middle")


def test_french_is_found(spark):
    sf_dir = "/root/testdata/sf0.01"
    ranked = P.select(*documents(spark, sf_dir), rank_tgt=False, metric="perplexity", top=100)
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS seg_id", "lang")
    # one in ten documents of the general corpus is French
    assert ranked.join(langs, "seg_id").filter("lang = 'fr'").count() >= 50


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executions(spark):
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = store.executionsList()
    return [found.apply(i) for i in range(found.size())]


def text_scans(spark, since, folder, column):
    """How many scans of the folder in the plans executed since read the column."""
    total = 0
    for run in executions(spark):
        if run.executionId() <= since:
            continue
        text = run.physicalPlanDescription()
        tree, _, details = text.partition("\n\n(")
        tree = tree.split("== Initial Plan ==")[0]
        for number in re.findall(r"Scan parquet\s+\((\d+)\)", tree):
            node = re.search(rf"\({number}\) Scan parquet.*?(?=\n\n|\Z)", "(" + details, re.S)
            if node and folder in node[0] and f"{column}:string" in node[0].split("ReadSchema")[1]:
                total += 1
    return total


@pytest.mark.parametrize("ties", [False, True])
def test_general_text_is_read_twice(spark, tmp_path, ties):
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(f"{tmp_path}/general")
    rows = [(f"{i} {src}" if not ties else src + " same" * 20 + f" {i}", t) for i, (_, src, t) in enumerate(GENERAL_ROWS)]
    if ties:
        rows += [("same " * 20 + f"unseen{i}", "") for i in range(3)]
    for k in range(8):
        part = rows[k::8]
        pq.write_table(pa.table({"en": [r[0] for r in part], "de": [r[1] for r in part]}), f"{tmp_path}/general/{k}.parquet")
    general = open_corpus(spark, f"{tmp_path}/general", "en", "de")
    schema = "seg_id long, src string, tgt string"
    specific = spark.createDataFrame(SPECIFIC_ROWS[:3], schema)
    before = max(run.executionId() for run in executions(spark))
    models = P.train_models(general, specific, ("src",))
    trained = max(run.executionId() for run in executions(spark))
    ranked = P.select(general, specific, rank_tgt=False)
    assert ranked.count() == len(set(rows))
    ranked.write.parquet(f"{tmp_path}/out")
    assert models.count()
    training = text_scans(spark, before, "general", "en") - text_scans(spark, trained, "general", "en")
    # Without training: once for scores, once for the output, and again for ties only.
    whole = text_scans(spark, trained, "general", "en") - training
    assert whole == (3 if ties else 2)


def test_a_side_without_a_score_is_an_error(spark, corpora):
    general, specific = corpora
    models = P.train_models(general, specific, ("src", "tgt"))
    diffs = materialize(P.side_diffs(general, models, ("src", "tgt")), "diffs")
    assert P.sum_sides(diffs, ("src", "tgt")).count() == general.count()
    broken = diffs.filter("NOT (seg_id = 13 AND side = 'tgt')")
    with pytest.raises(Exception, match="a side has no score in segment 13"):
        P.sum_sides(broken, ("src", "tgt")).collect()
    scores = P.sum_sides(diffs, ("src", "tgt")).filter("seg_id <> 13")
    with pytest.raises(Exception, match="no score for segment 13"):
        R.rank_ids(general, scores)


def test_scores_are_the_same_on_both_ways(spark, smallest):
    docs = documents(spark, smallest)
    models = P.train_models(*docs, ("src",)).drop("side")
    pair = [models.filter(f"model = '{m}'").drop("model") for m in ("specific", "general")]
    ways = [
        sorted(map(tuple, S.score_lm(segments(docs.general), *pair, broadcast_bytes=limit).collect()))
        for limit in (1 << 28, 0)
    ]
    assert ways[0] == ways[1]


BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition", "collect_list")


def test_plan_of_scores(spark, smallest):
    pairs = dialogues(spark, smallest)
    sides = ("src", "tgt")
    models = P.train_models(*pairs, sides)
    plan = plan_of(P.side_diffs(pairs.general, models, sides))
    # grams meet the model by broadcast, and are summed before the one exchange of scores
    assert plan.count("BroadcastHashJoin") >= 2
    assert "partial_sum" in plan
    for bad in BAD:
        assert bad not in plan, bad
    weights = S.joint_weights(
        *[models.filter(f"model = '{m}'").drop("model") for m in ("specific", "general")], ["side"]
    )
    assert "Python" not in plan_of(weights)


def test_plan_of_training_samples_and_ranks(spark, smallest):
    docs = documents(spark, smallest)
    counts = V.token_counts(segments(docs.specific))
    assert "partial_count" in plan_of(counts)
    sentences = M.training_sentences(segments(docs.specific), V.vocab(counts))
    adjusted = M.adjusted_counts(M.ngram_counts(sentences))
    assert plan_of(adjusted).count("partial_") >= 2
    for df in (M.ngram_counts(sentences), adjusted, M.lm_probs(materialize(adjusted, "adjusted"))):
        for bad in BAD[:4]:
            assert bad not in plan_of(df), bad
    # a sample is a filter: nothing is sorted or shuffled
    flat = materialize(docs.general, "general")
    for sample in (N.sample_first_n(flat, 7), N.sample_random_n(flat, 7)):
        assert "Exchange" not in plan_of(sample) and "Sort" not in plan_of(sample)
    scores = flat.select("seg_id", F.lit(0.5).alias("score"))
    ranks = R.rank_ids(flat, scores)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan_of(R.attach_ranks(flat, ranks))
    # the best few are sent to the texts, which are not shuffled
    best = R.attach_ranks(flat, R.rank_ids(flat, scores, top=5), 5)
    final = plan_of(best)
    assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final


def test_general_documents_are_not_shuffled(spark, tmp_path):
    """Documents labelled twice, without a language or an id, and ids that occur twice."""
    docs = [(1, "a", "fr"), (2, "b", "de"), (3, "c", None), (4, "d", "fr"), (None, "e", "fr"), (2, "f", "fr"), (5, "g", None)]
    labels = [(1, 1), (2, 1), (2, 1), (3, 1), (None, 1), (4, 0), (2, 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    found = documents(spark, str(tmp_path))
    texts = [sorted(r["src"] for r in rows.collect()) for rows in found]
    assert texts == [["b", "b", "d", "e", "g"], ["a", "f"]]
    for rows in found:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
