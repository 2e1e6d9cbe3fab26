"""Tables for the tests of this folder."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, t string, node long, x int"
LONG = "one two three four five six seven eight nine ten " * 6000


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that clash with
    names the operators use."""
    full = []
    for row in rows:
        doc_id, text, source = (*row, None)[:3]
        full.append((doc_id, text, None, source, len(text or ""), 7, "clash", 1, 2))
    return spark.createDataFrame(full, SCHEMA)


# Nulls, empty texts, ties and repeated rows, a long text, texts without words.
ODD = [
    (None, None, None),
    (None, "a text without an id", "src0"),
    (1, "", "src0"),
    (1, None, "src0"),
    (2, "the same text twice in the table", "src1"),
    (2, "the same text twice in the table", "src1"),
    (2, "another text under the same id", None),
    (3, LONG, "src2"),
    (4, "!!! ??? ...", "src9"),
    (5, "Êàü ñandú 数据 🙂 end", "src0"),
    (6, "\n\t \r", "src0"),
    (7, "word", "src0"),
]


@pytest.fixture
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture
def none(spark):
    return documents(spark, [])
