import pytest

from tamis.operators import sampling as N
from tamis.operators import vocabulary as V
from tamis.sources import sinks
from tamis.sources.corpus import numbered_lines
from tamis.sources.staging import new_path

TEXTS = [(0, "a a b"), (1, None), (2, ""), (3, "  "), (4, "b c <unk> a"), (5, "d")]


@pytest.fixture(scope="module")
def segs(spark):
    return spark.createDataFrame(TEXTS, "seg_id long, text string")


@pytest.fixture(scope="module")
def words(segs):
    return V.vocab(V.token_counts(segs))


def test_counts(segs, words):
    assert V.count_segments(segs).first()["n"] == 6
    counted = {r["tok"]: r["cnt"] for r in V.token_counts(segs).collect()}
    assert counted == {"a": 3, "b": 2, "c": 1, "<unk>": 1, "d": 1}
    assert {r["tok"] for r in words.collect()} == {"a", "b"}
    assert V.vocab_stats(segs).first().asDict() == {"rows": 6, "types": 5, "kept": 2}


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_mask(segs, words, limit):
    masked = {r["seg_id"]: r["text"] for r in V.mask_oov(segs, words, broadcast_bytes=limit).collect()}
    assert masked == {0: "a a b", 1: "", 2: "", 3: "", 4: "b <unk> <unk> a", 5: "<unk>"}


def test_mask_with_sides(spark, words):
    rows = [("x", 1, "a b"), ("y", 1, "a b")]
    segs = spark.createDataFrame(rows, "side string, seg_id long, text string")
    vocabulary = spark.createDataFrame([("x", "a"), ("y", "b")], "side string, tok string")
    masked = V.mask_oov(segs, vocabulary, by=["side"]).collect()
    assert {(r["side"], r["text"]) for r in masked} == {("x", "a <unk>"), ("y", "<unk> b")}


@pytest.mark.parametrize("few", [0, 32])
def test_mask_of_many_unknown_words(spark, monkeypatch, few):
    monkeypatch.setattr(V, "FEW", few)
    texts = [[f"w{i * k % 997}" for i in range(600 * k)] for k in (1, 2, 3)]
    segs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "seg_id long, text string")
    kept = {f"w{i}" for i in range(0, 997, 3)}
    vocabulary = spark.createDataFrame([(w,) for w in kept], "tok string")
    masked = {r["seg_id"]: r["words"] for r in V.masked_words(segs, vocabulary).collect()}
    assert masked == {i: [w if w in kept else "<unk>" for w in t] for i, t in enumerate(texts)}


def test_masking_shuffles_distinct_tokens(spark, segs, words, capsys):
    from pyspark.sql import functions as F

    long = spark.createDataFrame([(i, "a b " * 500 + f"c{i} " * 500) for i in range(20)], "seg_id long, text string")
    masked = V.masked_words(long, words)
    masked.explain()
    plan = capsys.readouterr().out
    assert "collect_list" not in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert masked.agg(F.sum(F.size("words"))).first()[0] == 20 * 1500


def test_write_filtered_text(spark, segs, words):
    dest = new_path(spark, "masked")
    assert sinks.write_filtered_text(segs, words, dest, 5) == 5
    lines = numbered_lines(spark, dest).orderBy("seg_id").collect()
    assert [r["text"] for r in lines] == ["a a b", "", "", "", "b <unk> <unk> a"]


def test_sample_first(spark, segs):
    assert [r["seg_id"] for r in N.sample_first_n(segs, 3).orderBy("seg_id").collect()] == [0, 1, 2]
    assert N.sample_first_n(segs, 99).count() == 6
    assert N.sample_first_n(segs, 0).count() == 0


@pytest.mark.parametrize("n", [1, 2, 500, 999, 1000])
def test_sample_first_of_gappy_ids(spark, n):
    ids = [i * i * 7919 - 5000 for i in range(1000)]
    frame = spark.createDataFrame([(i,) for i in ids], "seg_id long")
    kept = sorted(r["seg_id"] for r in N.sample_first_n(frame, n).collect())
    assert kept == ids[:n]


@pytest.mark.parametrize("n", [1, 17, 300])
def test_sample_random(spark, n):
    import hashlib

    frame = spark.range(300).withColumnRenamed("id", "seg_id")
    order = sorted(range(300), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    kept = sorted(r["seg_id"] for r in N.sample_random_n(frame, n, seed=7).collect())
    assert kept == sorted(order[:n])


def test_place_among_equal_values(spark):
    frame = spark.createDataFrame([(v,) for v in (5, 5, 5, 1, 9)], "v long")
    assert N.nth_smallest(frame, "v", 1) == (1, 1)
    assert N.nth_smallest(frame, "v", 3) == (5, 2)
    assert N.nth_smallest(frame, "v", 5) == (9, 1)
    assert N.nth_smallest(frame, "v", 6) is None


def test_words_are_masked_once(spark, capsys):
    """Taking tokens out of masked arrays doesn't work the arrays out a second time for a filter."""
    from pyspark.sql import functions as F

    from tamis.catalog.queries import per_token
    from tamis.functions.text import empty_to_unk, skip_symbols

    texts = [(i, "a b " * i + f"c{i}") for i in range(5)] + [(5, ""), (None, "a d")]
    segs = spark.createDataFrame(texts, "seg_id long, text string")
    vocabulary = spark.createDataFrame([("a",), ("b",)], "tok string")
    masked = V.masked_words(segs, vocabulary).select(F.col("seg_id").alias("doc_id"), F.col("words").alias("w"))
    tokens = per_token(masked, skip_symbols)
    tokens.explain(extended=True)
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("array_contains(") == 1
    assert sorted(r["tok"] for r in tokens.collect()) == ["a"] * 11 + ["b"] * 10
    every = per_token(masked, skip_symbols, empty_to_unk).collect()
    assert sorted(r["doc_id"] for r in every if r["tok"] == "<unk>") == [0, 5]


def test_a_sorted_array_is_searched_by_as_many_steps_as_its_size_has_bits(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(V, "FEW", -1)
    assert [len(V.HALVES[n.bit_length()]) for n in (0, 1, 2, 255, 256)] == [0, 1, 2, 8, 9]
    rows = [([f"w{i:03d}" for i in range(0, 2 * n, 2)], f"w{k:03d}") for n in range(20) for k in range(2 * n + 1)]
    searched = spark.createDataFrame(rows, "words array<string>, w string").repartition(2)
    found = searched.select("words", "w", V._among(F.col("words"), F.col("w")).alias("has")).collect()
    assert len(found) == len(rows) and all(r["has"] == (r["w"] in r["words"]) for r in found)


def test_numbers_of_words_are_packed(spark):
    from pyspark.sql import functions as F

    most = (1 << 31) - 1
    rows = [(1, most, None), (most, most, 7), (None, 1, most), (most, None, None), (2, 2, 3)]
    frame = spark.createDataFrame(rows, "a int, b int, c int").select("*", *V.packed(["a", "b", "c"]))
    assert frame.columns[3:] == ["pair_0", "pair_1"]
    back = frame.select(*V.unpacked(["a", "b", "c"])).collect()
    assert sorted(map(tuple, back)) == sorted(tuple(v or 0 for v in r) for r in rows)
    by_pairs = [tuple(v or 0 for v in r[:3]) for r in frame.orderBy("pair_0", "pair_1").collect()]
    assert by_pairs == sorted(by_pairs)
    words = spark.createDataFrame([("x",), ("y",), ("x",)], "gram string")
    ids = V.numbered(words)
    texts = spark.createDataFrame([("x", "y"), ("y", "z"), (None, "x")], "p string, q string")
    numbers = V.coded(texts, ids, ["p", "q"])
    assert sorted(r["id"] for r in ids.collect()) == [1, 2] and numbers.filter("q IS NULL").count() == 1
    words_again = V.decoded(numbers, ids, ["p", "q"]).select("p", "q").collect()
    assert sorted(map(tuple, words_again), key=str) == sorted([("x", "y"), ("y", None), (None, "x")], key=str)


@pytest.mark.parametrize("few_marks", [False, True])
def test_words_are_found_in_buckets(spark, monkeypatch, few_marks):
    from pyspark.sql import functions as F

    if few_marks:  # words that share their mark are told apart
        monkeypatch.setattr(V, "mark", lambda word: F.pmod(F.xxhash64(word), F.lit(3)).cast("int"))
    words = spark.createDataFrame([(s, f"w{i}", i) for s in "ab" for i in range(200) if s == "a" or i % 2], "side string, gram string, id int")
    table = V.buckets(words, "gram", ["id"], ["side"], limit=0)
    assert table.frame.count() <= 2 * 350 // V.PER_BUCKET
    rows = [(s, w) for s in "abc" for w in [*(f"w{i}" for i in range(250)), None, ""]]
    found = V.found_in(spark.createDataFrame(rows, "side string, w string").withColumn("k", F.col("w")), table, "w").collect()
    known = {(r["side"], r["gram"]): r["id"] for r in words.collect()}
    assert len(found) == len(rows) and all(r["found_id"] == known.get((r["side"], r["k"])) for r in found)


def test_words_in_buckets_fit_where_rows_of_words_do_not(spark):
    from tamis.sources.staging import fits_broadcast

    words = spark.createDataFrame([(f"word{i}",) for i in range(1000)], "gram string")
    assert V.fits_words(words, 50_000) and not fits_broadcast(words, 50_000)
    assert not V.fits_words(words, 20_000)
