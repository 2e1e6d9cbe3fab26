import math
import random

import brute
import pytest
from pyspark.sql import functions as F

from tamis.operators import ngram_model as M
from tamis.operators import scoring as S
from tamis.operators import vocabulary as V
from tamis.sources import sinks
from tamis.sources.staging import frequent_lookup, materialize, new_path, row_bytes


def made_up(seed, n, words):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 12))) for _ in range(n)]


WORDS = [f"w{i}" for i in range(40)]
SPECIFIC = made_up(1, 120, WORDS) + ["w0 <s> w1 </s> <unk> w2 <s> <unk>", "", "   "]
GENERAL = made_up(2, 110, WORDS[10:] + WORDS[:5] + ["other", "<unk>"])
SCORED = GENERAL + ["", " ", "never seen words", "w0 <s> w1 </s> w2", "w39", "other other"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "seg_id long, text string")


@pytest.fixture(scope="module")
def words(spark):
    rows = [(w,) for w in sorted(brute.vocabulary(SPECIFIC))]
    return spark.createDataFrame(rows, "tok string")


@pytest.fixture(scope="module")
def models(spark, words):
    return tuple(M.train_lm(frame(spark, texts), words) for texts in (SPECIFIC, GENERAL))


def check_model(model, texts, fallback=(0.5, 1.0, 1.5)):
    expected = brute.train(texts, brute.vocabulary(SPECIFIC), fallback=fallback)
    rows = {tuple(r["gram"].split(" ")): r for r in model.collect()}
    assert set(rows) == set(expected["p"]) | {("<s>",)}
    for gram, row in rows.items():
        assert row["n"] == len(gram)
        assert row["bow"] == pytest.approx(math.log10(expected["b"].get(gram, 1.0)), abs=1e-9)
        if gram == ("<s>",):
            assert row["logp"] is None
        else:
            assert row["logp"] == pytest.approx(math.log10(expected["p"][gram]), abs=1e-9)


def test_models_equal_brute_force(models):
    for model, texts in zip(models, (SPECIFIC, GENERAL)):
        check_model(model, texts)


def test_training_by_shuffled_joins(spark, words):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check_model(M.train_lm(frame(spark, SPECIFIC), words, broadcast_bytes=0), SPECIFIC)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_several_models_in_one_frame(spark, words, models):
    tagged = [
        frame(spark, texts).withColumn("model", F.lit(name))
        for name, texts in (("a", SPECIFIC), ("b", GENERAL))
    ]
    both = M.train_lm(tagged[0].unionByName(tagged[1]), words, by=["model"])
    for name, alone in (("a", models[0]), ("b", models[1])):
        part = {r["gram"]: r for r in both.filter(F.col("model") == name).collect()}
        rows = {r["gram"]: r for r in alone.collect()}
        assert part.keys() == rows.keys()
        for gram, row in rows.items():
            assert part[gram]["weight"] == pytest.approx(row["weight"], abs=1e-9)


def test_probabilities_sum_to_one(models):
    for model in models:
        unigrams = model.filter("n = 1 AND gram <> '<s>'")
        total = unigrams.agg(F.sum(F.pow(F.lit(10.0), "logp"))).first()[0]
        assert total == pytest.approx(1.0, abs=1e-12)


def test_closed_under_prefix_and_suffix(models):
    for model in models:
        grams = {r["gram"] for r in model.select("gram").collect()}
        for gram in grams:
            parts = gram.split(" ")
            if len(parts) > 1:
                assert " ".join(parts[1:]) in grams and " ".join(parts[:-1]) in grams


def test_fallback_discounts(spark):
    texts = ["a b", "a c", "a d", "b c", "d"]
    vocabulary = spark.createDataFrame([(w,) for w in "abcd"], "tok string")
    sentences = M.training_sentences(frame(spark, texts), vocabulary)
    adjusted = M.adjusted_counts(M.ngram_counts(sentences))
    rows = {r["n"]: (r["d1"], r["d2"], r["d3"]) for r in M.discounts(adjusted).collect()}
    expected = brute.train(texts, set("abcd"))["discounts"]
    assert rows == {n: pytest.approx(expected[n]) for n in (1, 2, 3, 4)}  # no gram of order 5
    assert (0.5, 1.0, 1.5) in rows.values()
    other = M.discounts(adjusted, (0.4, 0.9, 1.4)).collect()
    assert (0.4, 0.9, 1.4) in {(r["d1"], r["d2"], r["d3"]) for r in other}


def test_known_values(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    segs = docs.filter("lang = 'fr' AND doc_id % 4 = 0").selectExpr("doc_id AS seg_id", "text")
    assert V.vocab_stats(segs).first().asDict() == {"rows": 48, "types": 7741, "kept": 2578}
    vocabulary = V.vocab(V.token_counts(segs))
    adjusted = M.adjusted_counts(M.ngram_counts(M.training_sentences(segs, vocabulary)))
    sizes = {r["n"]: r["count"] for r in adjusted.groupBy("n").count().collect()}
    assert sizes == {1: 2579, 2: 10454, 3: 12268, 4: 12478, 5: 12572}
    first = M.discounts(adjusted).filter("n = 1").first()
    found = [round(first[c], 4) for c in ("d1", "d2", "d3")]
    assert found == [0.3887, 1.6069, 2.2659]


def check_scores(scores):
    vocabulary = brute.vocabulary(SPECIFIC)
    expected = [brute.train(texts, vocabulary) for texts in (SPECIFIC, GENERAL)]
    rows = {r["seg_id"]: r for r in scores.collect()}
    assert len(rows) == len(SCORED)
    for i, text in enumerate(SCORED):
        for tag, model in zip("sg", expected):
            positions, total, oov = brute.score(text, model)
            assert rows[i]["positions"] == positions
            assert rows[i][f"logp_{tag}"] == pytest.approx(total, abs=1e-9), text
            assert rows[i][f"oov_{tag}"] == oov, text


def test_scores_equal_brute_force(spark, models):
    check_scores(S.score_lm(frame(spark, SCORED), *models))


@pytest.mark.parametrize("limit", [0, 9000])
def test_scores_by_shuffled_joins(spark, models, limit):
    # 0: nothing is broadcast; 9000: the words are, the longer grams are not
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check_scores(S.score_lm(frame(spark, SCORED), *models, broadcast_bytes=limit))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


# Pieces of few tokens, with texts of as many, one more, one less; whitespace at cuts.
CUT = [
    "", " \u3000 ", " " * 50, "w1", " \t".join(["w1 w2"] * 9), " w1 <s> w3 <unk> other w2" * 9 + " \n",
    *(" ".join((WORDS * 2)[:n]) for n in (7, 8, 9, 12, 16, 17)),
]


@pytest.mark.parametrize(("piece", "limit"), [(8, 0), (8, 9000), (8, 1 << 28), (5, 1 << 28), (11, 1 << 28)])
def test_scores_of_pieces(spark, models, piece, limit, monkeypatch):
    whole = S.segment_endings
    monkeypatch.setattr(S, "segment_endings", lambda *a: whole(*a, long_bytes=0, piece=piece))
    rows = {r["seg_id"]: r for r in S.score_lm(frame(spark, CUT), *models, broadcast_bytes=limit).collect()}
    vocabulary = brute.vocabulary(SPECIFIC)
    for tag, texts in (("s", SPECIFIC), ("g", GENERAL)):
        model = brute.train(texts, vocabulary)
        for i, text in enumerate(CUT):
            positions, total, oov = brute.score(text, model)
            assert (rows[i]["positions"], rows[i][f"oov_{tag}"]) == (positions, oov), text
            assert rows[i][f"logp_{tag}"] == pytest.approx(total, abs=1e-9), text


def test_a_segment_of_three_million_tokens(spark, models):
    block = " ".join(random.Random(7).choices(WORDS + ["other"], k=1000)) + " "
    texts = frame(spark, [block * 3000]).repartition(1)
    scores = [S.score_lm(texts, *models, broadcast_bytes=limit).first() for limit in (1 << 28, 0)]
    assert scores[0] == scores[1]
    vocabulary = brute.vocabulary(SPECIFIC)
    for tag, corpus in (("s", SPECIFIC), ("g", GENERAL)):
        model = brute.train(corpus, vocabulary)
        # Every further block adds the same.
        two, three = (brute.score(block * n, model) for n in (2, 3))
        positions, total, oov = (b + (b - a) * 2997 for a, b in zip(two, three))
        assert (scores[0]["positions"], scores[0][f"oov_{tag}"]) == (positions, oov)
        assert scores[0][f"logp_{tag}"] == pytest.approx(total, rel=1e-9)


def test_wide_sums_do_not_overflow(spark):
    big = (1 << 62) + 12345
    rows = [(0, -big)] * 9 + [(1, big)] * 5 + [(1, -1)] + [(2, 3)]
    df = spark.createDataFrame(rows, "k int, w long").groupBy("k").agg(*S.wide_sums("w"))
    found = {r["k"]: r["t"] for r in df.select("k", S.wide_total("w").alias("t")).collect()}
    assert found == {0: -9 * big / S.UNIT, 1: (5 * big - 1) / S.UNIT, 2: 3 / S.UNIT}


def test_closed_vocabulary(spark, words):
    some = words.unionByName(spark.createDataFrame([("never",), ("<s>",), ("never",)], "tok string"))
    model = M.train_lm(frame(spark, GENERAL), some, closed=True)
    rows = {r["gram"]: r for r in model.collect()}
    given = brute.vocabulary(SPECIFIC) - {"<s>", "</s>", "<unk>"} | {"never"}
    unigrams = {g for g, r in rows.items() if r["n"] == 1}
    assert unigrams == given | {"<s>", "</s>", "<unk>"}
    assert sum(10 ** rows[g]["logp"] for g in unigrams - {"<s>"}) == pytest.approx(1, abs=1e-12)
    assert rows["never"]["logp"] == rows["<unk>"]["logp"] and rows["never"]["bow"] == 0
    # A word that a corpus lacks is known to its model.
    scores = S.score_lm(frame(spark, ["w9 never x"]), model, M.train_lm(frame(spark, GENERAL), some)).first()
    assert (scores["oov_s"], scores["oov_g"]) == (1, 3)


def test_closed_vocabulary_by_side(spark):
    texts = [("src", "a b a"), ("src", "b"), ("tgt", "c"), ("tgt", "")]
    segs = spark.createDataFrame([(s, i, t) for i, (s, t) in enumerate(texts)], "side string, seg_id long, text string")
    both = segs.withColumn("model", F.lit("m")).unionByName(segs.withColumn("model", F.lit("n")))
    vocabulary = spark.createDataFrame([("src", w) for w in "abd"] + [("tgt", w) for w in "ce"], "side string, tok string")
    model = M.train_lm(both, vocabulary, by=["model", "side"], closed=True)
    for name in "mn":
        for side, given in (("src", "abd"), ("tgt", "ce")):
            rows = model.filter(f"model = '{name}' AND side = '{side}' AND n = 1 AND gram <> '<s>'").collect()
            assert {r["gram"] for r in rows} == {*given, "</s>", "<unk>"}
            assert sum(10 ** r["logp"] for r in rows) == pytest.approx(1, abs=1e-12)


def test_a_gram_in_half_of_all_rows(spark, models):
    rng = random.Random(8)
    texts = [" ".join(["w1 w2 w3"] * 40 + rng.choices(WORDS, k=120)) for _ in range(300)]
    weights = materialize(S.joint_weights(*models), "weights")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        segs = materialize(frame(spark, texts), "segs")
        for limit in (0, 9000):
            found = S.model_lookup(segs, weights, broadcast_bytes=limit)
            # What was shuffled: no task has much more than another.
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(gram" in plan
            common = found.groupBy("gram").count().orderBy(F.desc("count")).limit(3).collect()
            assert min(r["count"] for r in common) > 300 * 40
            most = spark.createDataFrame([(r["gram"],) for r in common], "gram string")
            rest = found.join(F.broadcast(most), "gram", "left_anti").groupBy("gram").count()
            whole = S.model_lookup(segs, weights)
            assert sorted(rest.collect()) == sorted(
                whole.join(F.broadcast(most), "gram", "left_anti").groupBy("gram").count().collect()
            )
            assert found.count() == whole.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_frequent_key_is_not_shuffled(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.hash("id") % 20000))
        also = F.when(F.col("id") % 7 == 1, F.lit("frequent, but not in the table")).otherwise(key)
        rows = materialize(spark.range(0, 200_000, 1, 8).select("id", also.alias("k")), "rows")
        table = rows.filter("k NOT LIKE 'freq%'").select("k", F.length("k").alias("n")).distinct()
        table = materialize(table, "table")
        found = frequent_lookup(rows, table, ["k"], "k")
        assert found.count() == rows.filter("k NOT LIKE 'freq%'").count()
        in_task = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        # The first tasks read the rows, the last ones what was shuffled.
        shuffled = sorted(r["count"] for r in in_task if r["task"] >= rows.rdd.getNumPartitions())
        assert shuffled and shuffled[-1] < 2 * shuffled[len(shuffled) // 2]
        assert sum(shuffled) < 0.5 * found.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_symmetry(spark, models):
    segs = frame(spark, SCORED)
    same = S.score_diff(S.score_lm(segs, models[0], models[0])).collect()
    assert {r["diff"] for r in same} == {0.0}
    there = {r["seg_id"]: r["diff"] for r in S.score_diff(S.score_lm(segs, *models)).collect()}
    back = S.score_diff(S.score_lm(segs, *reversed(models))).collect()
    assert there == {r["seg_id"]: -r["diff"] or 0.0 for r in back}


def test_word_missing_from_one_model(spark):
    vocabulary = spark.createDataFrame([("a",), ("b",)], "tok string")
    specific = M.train_lm(frame(spark, ["a b", "b a a"]), vocabulary)
    general = M.train_lm(frame(spark, ["a", "a a"]), vocabulary)
    row = S.score_lm(frame(spark, ["a b"]), specific, general).first()
    assert (row["oov_s"], row["oov_g"]) == (0, 1)


def test_empty_corpus_is_an_error(spark, models):
    vocabulary = spark.createDataFrame([("a",)], "tok string")
    nothing = M.train_lm(frame(spark, ["x"]).filter("false"), vocabulary)
    with pytest.raises(ValueError, match="empty corpus"):
        S.score_lm(frame(spark, ["a"]), models[0], nothing)


def test_metrics(spark):
    rows = [(1, 3, -6.0, -9.0)]
    scores = spark.createDataFrame(rows, "seg_id long, positions long, logp_s double, logp_g double")
    assert S.score_diff(scores).first()["diff"] == 3.0
    assert S.score_diff(scores, "perplexity").first()["diff"] == pytest.approx(100.0 - 1000.0)
    with pytest.raises(ValueError, match="metric"):
        S.score_diff(scores, "other")


def test_check_complete(spark):
    segs = frame(spark, ["a", "b"])
    S.check_complete(segs, segs)
    with pytest.raises(ValueError, match="1 segments"):
        S.check_complete(segs, segs.filter("seg_id = 0"))


def test_saved_model(spark, models):
    path = new_path(spark, "saved")
    sinks.save_model(models[0].withColumn("model", F.lit("m")).withColumn("side", F.lit("src")), path)
    loaded = sinks.load_model(spark, path).filter("model = 'm'").drop("model", "side")
    assert sorted(map(str, loaded.select(models[0].columns).collect())) == sorted(map(str, models[0].collect()))


@pytest.mark.parametrize("order", [2, 3, 5])
def test_sentence_counts_equal_adjusted_counts(spark, order):
    texts = SPECIFIC + ["w1 w1 w1 w1 w1 w1 w1", "w2", "w1 w1 w1 w1 w1 w1 w1"]
    rows = [("a", t.split()) for t in texts] + [("b", t.split()) for t in GENERAL]
    # sentences to learn from hold no reserved symbols
    rows = [(m, [w for w in t if w not in ("<s>", "</s>", "<unk>")]) for m, t in rows]
    sentences = spark.createDataFrame(rows, "model string, words array<string>")
    expected = M.adjusted_counts(M.ngram_counts(sentences, order, ["model"]), order, ["model"])
    found = M.sentence_counts(sentences, order, ["model"])
    assert found.columns == expected.columns and found.schema["n"].dataType == expected.schema["n"].dataType
    assert sorted(found.collect()) == sorted(expected.collect())


def test_large_tables_are_never_broadcast_together(spark, words, monkeypatch):
    # orders that fit the limit one by one, but not together: what is broadcast stays below it
    hints = []
    monkeypatch.setattr(M.F, "broadcast", lambda df, of=M.F.broadcast: hints.append(df) or of(df))
    sentences = M.training_sentences(frame(spark, SPECIFIC), words)
    sizes = sorted(r["size"] for r in M.tallies(M.sentence_counts(sentences)).collect())
    hints.clear()
    check_model(M.train_lm(frame(spark, SPECIFIC), words, broadcast_bytes=sizes[-1]), SPECIFIC)
    large = [df for df in hints if df.agg(F.sum(row_bytes(df))).first()[0] > sum(sizes) / 10]
    assert sum(df.agg(F.sum(row_bytes(df))).first()[0] for df in large) <= 3 * sizes[-1]


def test_longer_grams_are_built_where_the_shorter_one_was_found(spark, models, monkeypatch):
    weights = materialize(S.joint_weights(*models), "weights")
    looked_up = []

    def counted(rows, *args):
        looked_up.append(rows.count())
        return frequent_lookup(rows, *args)

    monkeypatch.setattr(S, "frequent_lookup", counted)
    segs = materialize(frame(spark, SCORED), "segs")
    found = S.model_lookup(segs, weights, broadcast_bytes=9000)
    by_order = dict(found.groupBy("n").count().collect())
    # of each order at most what the order below found, and not all grams at once
    assert len(looked_up) == 4
    assert all(looked_up[n - 2] <= by_order[n - 1] for n in range(2, 6))
    columns = ["seg_id", "n", "gram", "w_s", "w_g"]
    whole = S.model_lookup(segs, weights).select(*columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


@pytest.mark.parametrize("order", [2, 5])
def test_one_shuffle_finds_what_broadcasts_find(spark, words, order, monkeypatch):
    """Pairs in most rows, words of one model only, reserved symbols, and two sides."""
    both = {
        name: frame(spark, texts).withColumn("model", F.lit(name)).withColumn("side", F.lit("src"))
        for name, texts in (("specific", SPECIFIC), ("general", GENERAL))
    }
    every = both["specific"].unionByName(both["general"])
    every = every.unionByName(every.withColumn("side", F.lit("tgt")).filter("seg_id % 2 = 0"))
    trained = M.train_lm(every, words, order, by=["model", "side"])
    models = [trained.filter(F.col("model") == name).drop("model") for name in ("specific", "general")]
    texts = SCORED + CUT + ["w1 w2 " * 30 + " ".join(random.Random(k).choices(WORDS, k=20)) for k in range(40)]
    segs = frame(spark, texts).withColumn("side", F.lit("src"))
    segs = materialize(segs.unionByName(segs.withColumn("side", F.lit("tgt"))), "segs")
    used, hot = [], []
    paired, frequent = S.paired_weights, S._frequent_pairs
    monkeypatch.setattr(S, "paired_weights", lambda *a: used.append(1) or paired(*a))
    monkeypatch.setattr(S, "_frequent_pairs", lambda *a: hot.append(frequent(*a)) or hot[-1])
    small = sum(m.filter("n = 1").agg(F.sum(row_bytes(m))).first()[0] for m in models)
    found, whole = (S.score_lm(segs, *models, order, ["side"], limit).collect() for limit in (small, 1 << 28))
    assert used == [1] and hot[0].count() > 0
    assert len(found) == 2 * len(texts) and sorted(found) == sorted(whole)


@pytest.mark.parametrize(("order", "closed"), [(2, False), (5, False), (4, True)])
def test_two_shuffles_train_what_broadcasts_train(spark, words, order, closed, monkeypatch):
    texts = {"a": SPECIFIC, "b": GENERAL, "c": ["w1 w1 w1 w1 w1 w1 w2", "w2"], "d": [""]}
    each = [frame(spark, t).withColumn("model", F.lit(m)) for m, t in texts.items()]
    segs = materialize(each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3]), "segs")
    joined = []
    monkeypatch.setattr(M, "_shuffled", lambda *a, of=M._shuffled: joined.append(1) or of(*a))
    small = M.train_lm(segs, words, order, by=["model"], closed=closed).collect()
    assert not joined
    for limit in (0, 60_000):  # words shuffled, too, or broadcast
        large = M.train_lm(segs, words, order, by=["model"], broadcast_bytes=limit, closed=closed)
        assert sorted(map(repr, large.collect())) == sorted(map(repr, small))
    assert len(joined) == 2


@pytest.mark.parametrize("order", [2, 5])
def test_words_are_shuffled_as_numbers(spark, words, order, capsys):
    sentences = M.training_sentences(frame(spark, SPECIFIC + GENERAL), words)
    ids = M.word_ids(words.select(F.col("tok").alias("gram")))
    expected = M.sentence_counts(sentences, order)
    plans = []
    written = M.materialize

    def kept(df, name, *rest):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return written(df, name, *rest)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(M, "materialize", kept)
        found = M.sentence_counts(sentences, order, (), ids)
        assert sorted(found.collect()) == sorted(expected.collect())
        model = M.train_lm(frame(spark, SPECIFIC), words, order, broadcast_bytes=12_000)
        check = M.train_lm(frame(spark, SPECIFIC), words, order)
    assert sorted(map(repr, model.collect())) == sorted(map(repr, check.collect()))
    by_name = dict(plans[:-4])  # the last tables are those of the model that is broadcast
    assert "RepartitionByExpression [pair_0" in by_name["adjusted"]
    assert by_name["model"].count("RepartitionByExpression [pair_0") == 2
    # A model holds no column that nothing reads.
    assert model.columns == ["n", "gram", "logp", "bow", "weight"]


def test_words_beyond_a_broadcast_of_rows_go_as_numbers(spark, words, models, monkeypatch):
    # 3,000 bytes: less than a row for each word takes, more than buckets of words do
    plans, written, used, paired = [], M.materialize, [], S.paired_weights
    monkeypatch.setattr(S, "paired_weights", lambda *a: used.append(1) or paired(*a))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(
            M, "materialize", lambda df, name, *a: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or written(df, name, *a)
        )
        model = M.train_lm(frame(spark, SPECIFIC), words, broadcast_bytes=3000)
    by_name = dict(plans)
    assert "RepartitionByExpression [pair_0" in by_name["adjusted"]
    assert by_name["model"].count("RepartitionByExpression [pair_0") == 2
    assert sorted(map(repr, model.collect())) == sorted(map(repr, models[0].collect()))
    segs = materialize(frame(spark, SCORED), "segs")
    found, whole = (S.score_lm(segs, *models, broadcast_bytes=limit).collect() for limit in (3000, 1 << 28))
    assert used == [1] and sorted(found) == sorted(whole)


def test_one_broadcast_finds_words_and_their_weights(spark, models, monkeypatch):
    weights = materialize(S.joint_weights(*models), "weights")
    broadcast, of = [], S.lookup
    monkeypatch.setattr(S, "lookup", lambda *a, **k: broadcast.append(a[1].columns) or of(*a, **k))
    segs = materialize(frame(spark, SCORED), "segs")
    found = S.model_lookup(segs, weights, broadcast_bytes=9000)
    assert sum("t0" in c or "gram" in c for c in broadcast) == 1 and broadcast[1:] == [["t1"]]
    whole = S.model_lookup(segs, weights)
    assert sorted(found.columns) == sorted(whole.columns)
    assert sorted(map(repr, found.select(whole.columns).collect())) == sorted(map(repr, whole.collect()))


def test_grams_of_numbers_are_walked_over_without_windows(spark, words, models, monkeypatch):
    plans, of = {}, M.materialize

    def kept(df, name, *rest):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return of(df, name, *rest)

    monkeypatch.setattr(M, "materialize", kept)
    monkeypatch.setattr(S, "materialize", kept)
    M.train_lm(frame(spark, SPECIFIC), words, broadcast_bytes=3000)
    S.score_lm(materialize(frame(spark, SCORED), "segs"), *models, broadcast_bytes=3000)
    for name in ("adjusted", "model", "sums"):
        assert "MapInArrow" in plans[name] and "Window" not in plans[name]
    # What is shuffled for a sentence are the numbers of its words.
    assert plans["sentences"].index("Aggregate") < plans["sentences"].index("MapInArrow")


def test_one_sentence_for_each_id(spark, words):
    segs = frame(spark, SPECIFIC)
    twice = materialize(segs.unionByName(segs.filter("seg_id % 3 = 0")), "segs")
    for limit in (3000, 1 << 28):
        check_model(M.train_lm(twice, words, broadcast_bytes=limit), SPECIFIC)


def test_numbered_texts_in_pieces(spark, models, monkeypatch):
    texts = SCORED + CUT + ["", None, " \t ", "<s> w1 </s> <unk>", "w1 w2 w3 " * 40, "\x1cw1\x85w2\u2003w3\u200bw4"]
    # ids that are null, and one of two texts
    seg_id = F.when(F.col("seg_id") == 3, F.lit(4)).when(F.col("seg_id") % 5 != 0, F.col("seg_id")).alias("seg_id")
    segs = materialize(frame(spark, texts).select(seg_id.cast("long"), "text"), "segs")
    whole = sorted(S.score_lm(segs, *models, broadcast_bytes=1 << 28).collect(), key=repr)
    monkeypatch.setattr(S, "SHORT_BYTES", 0)
    monkeypatch.setattr(S, "cuts", lambda text, order, size, cut=S.cuts: cut(text, order, size, 7))
    monkeypatch.setattr(S, "pieces", lambda text, of=S.pieces: of(text, 7))
    found = sorted(S.score_lm(segs, *models, broadcast_bytes=3000).collect(), key=repr)
    assert len(found) == segs.select("seg_id").distinct().count() and found == whole


@pytest.mark.parametrize("order", [2, 3, 5])
def test_what_ends_with_a_table_goes_on_in_the_next(order, monkeypatch):
    """Grams and tokens in their order, a few rows at a time, with a frequent pair that is dealt out."""
    import numpy as np
    import pyarrow as pa

    from tamis.operators import coded

    rng = random.Random(order)
    names = ["<s>", "</s>", *(f"w{k}" for k in range(5))]
    own = {"gram": names, "id": list(range(1, 8)), "w_s": [3] * 7, "w_g": [5] * 7, "known_s": [1] * 7, "known_g": [0] * 7}

    class Known:
        value = coded.Words(pa.table(own))

    texts = [" ".join(rng.choices([*names[2:], "x"], k=30)) for _ in range(20)]
    every = {" ".join(t[k : k + n]) for text in texts for t in [["<s>", *text.split(), "</s>"]] for n in range(2, order + 1) for k in range(33 - n)}
    known = sorted(g for g in every if "x" not in g)
    grams = [rng.sample(known, len(known) // 2) for _ in range(2)]
    weights = [{g: rng.randrange(1, 1000) for g in of} for of in grams]
    hot = [(0, (3 << 31) | 4), (0, (5 << 31) | 5)]
    pieces = pa.RecordBatch.from_pydict(
        {"seg_id": list(range(20)), "text": texts, "before": [""] * 20, "first": [True] * 20, "last": [True] * 20, "rest": [0] * 20}
    )
    rows = list(coded.segment_tokens(Known, order, hot, 32)(iter([pieces])))
    for tag, of in enumerate(weights):
        batch = pa.RecordBatch.from_pydict({"n": [len(g.split()) for g in of], "gram": list(of), "w": [float(w) for w in of.values()]})
        rows += coded.model_grams(Known, order, tag, hot, 32)(iter([batch]))
    names = coded.columns(order)
    table = pa.Table.from_batches(rows).sort_by([(c, "ascending") for c in names[:-1]])
    expected = {}
    for seg_id, text in enumerate(texts):
        tokens = ["<s>", *text.split(), "</s>"]
        found = [" ".join(tokens[k : k + n]) for n in range(2, order + 1) for k in range(len(tokens) - n + 1)]
        words = sum(t != "x" for t in tokens)
        expected[seg_id] = [w * words + sum(of.get(g, 0) for g in found) for w, of in zip((3, 5), weights)]
    for size in (2, 7, 1 << 18):
        monkeypatch.setattr(coded, "CHUNK", size)
        found = pa.Table.from_batches(coded.found_weights(order, 32)(iter(table.to_batches(max_chunksize=3)))).to_pylist()
        sums = {seg_id: [0, 0] for seg_id in range(20)}
        for r in found:
            if r["kind"] == coded.WEIGHTS:
                sums[r["seg_id"]] = list(np.add(sums[r["seg_id"]], [r["high"], r["low"]]))
        assert sums == expected
