import sys

import pytest
from pyspark.sql import functions as F

from tamis.functions import text as X


def one(spark, value, function):
    frame = spark.createDataFrame([(value,)], "v string")
    return frame.select(function(X.tokenize(F.col("v")))).first()[0]


def test_whitespace_is_that_of_python(spark):
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert len(spaces) == 29
    decoys = ["​", "﻿", "⁠", "-"]
    texts = [f"a{c}b" for c in spaces + decoys]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    rows = frame.select("i", X.tokenize(F.col("v")).alias("w")).collect()
    assert {r["i"]: r["w"] for r in rows} == {i: t.split() for i, t in enumerate(texts)}


def test_token_class_has_every_other_character():
    import regex

    pattern = regex.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{int(m[1], 16):08x}", X.TOKEN)
    token = regex.compile(pattern)
    for code in range(sys.maxunicode + 1):
        assert bool(token.fullmatch(chr(code))) != chr(code).isspace(), hex(code)


@pytest.mark.parametrize("text", [None, "", "   ", "\n\t", " a  b ", "　a ", "x"])
def test_tokenize_edges(spark, text):
    assert one(spark, text, lambda w: w) == (text or "").split()


def test_empty_to_unk(spark):
    assert one(spark, " ", X.empty_to_unk) == ["<unk>"]
    assert one(spark, "a", X.empty_to_unk) == ["a"]


def test_symbols(spark):
    text = "a <s> b </s> <unk> c"
    assert one(spark, text, X.skip_symbols) == ["a", "b", "c"]
    assert one(spark, text, X.hide_symbols) == ["a", "<unk>", "b", "<unk>", "<unk>", "c"]
    assert one(spark, "a b", X.hide_symbols) == ["a", "b"]
    assert one(spark, "a b", X.pad_sentence) == ["<s>", "a", "b", "</s>"]


@pytest.mark.parametrize("text", ["", "a", "a b", "a b c d e f g", "a a a"])
def test_ngrams(spark, text):
    words = text.split()
    expected = sorted(
        (n, " ".join(words[i : i + n]))
        for n in range(1, 6)
        for i in range(len(words) - n + 1)
    )
    assert sorted(tuple(g) for g in one(spark, text, X.ngrams)) == expected


def test_long_segment_stays_linear(spark):
    # 200,000 tokens: a copy of the array per token would not finish
    frame = spark.range(1).select(F.array_join(F.array_repeat(F.lit("w"), 200000), " ").alias("v"))
    words = frame.select(X.tokenize(F.col("v")).alias("w"))
    ends = words.select(F.inline(X.endings(F.col("w")))).filter("t0 is not null")
    assert ends.select(F.inline(X.grams_ending())).filter("gram is not null").count() == 999990


def test_perplexity(spark):
    value = spark.range(1).select(X.perplexity(F.lit(-6.0), F.lit(3))).first()[0]
    assert value == pytest.approx(100.0)
