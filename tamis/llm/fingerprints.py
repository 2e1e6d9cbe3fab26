"""Document fingerprints from spot signatures.

An anchor is a common word. Behind every anchor (the last, where several follow each other) the
next two content words form a chain, and anchor and chain a signature. The fingerprint is the set
of signatures, each as a 32-bit checksum. Running text has an anchor every few words, while
navigation and lists have few, so the set stands for the prose of a page.

Sets whose sizes alone bound their Jaccard similarity below ``LEAST`` are unlike without a look at
their elements; others are intersected. The partition by set size is a label: sets more than one
partition apart are always below that bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import FILE, PART, ROW, SEQ, in_order, lower_ascii, stored, text_of
from tamis.sources.staging import fits_broadcast, materialize

LEAST = 0.1  # similarity below which two sets count as unlike
# Counted size up to which the table of neighbours is broadcast; beyond it, it is shuffled.
NEIGHBOUR_BYTES = 64 * 1024 * 1024

# Common words of four languages.
ANCHORS = tuple(
    """
    the of and to in is that for it with as was on be are this by or an at from a
    le la les de des du et un une en que qui dans pour par sur au est
    el los las y una por con para del se es su al no
    der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch
    """.split()
)
_ANY = "|".join(ANCHORS)
# A content word with the anchors before it. The anchors are taken up as a whole, so a word that
# follows them is none.
RUN = rf"(?<= )(?:(?:{_ANY}) )*+[^ ]+ "
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal(text: Column) -> Column:
    """A-Z lower-cased, words of digits, letters and non-ASCII characters between single spaces;
    a space before the first and after the last."""
    return F.regexp_replace(F.concat(F.lit(" "), lower_ascii(text), F.lit(" ")), SEPARATORS, " ")


def with_signatures(docs: DataFrame, text: str, name: str) -> DataFrame:
    """The rows and under ``name`` the distinct signatures of a text as a sorted array of
    checksums.

    A text without anchored chains has all its pairs of consecutive content words instead; one
    without two words its only word; one without words nothing. Every step is a projection of
    its own, so that no step is evaluated twice.
    """
    kept = docs.columns
    steps = docs.withColumn("__words", normal(F.col(text)))
    steps = steps.withColumn("__runs", F.regexp_extract_all("__words", F.lit(RUN), F.lit(0)))
    steps = steps.withColumn("__content", F.transform("__runs", lambda r: F.substring_index(r, " ", -2)))
    # A run is "anchor ... anchor word "; its last anchor and word are the last three parts.
    following = F.slice("__content", F.lit(2), F.greatest(F.size("__content"), F.lit(1)))
    zipped = F.arrays_zip(F.col("__runs").alias("run"), following.alias("next"))
    steps = steps.withColumn("__pairs", F.filter(zipped, lambda z: z["next"].isNotNull()))
    anchored = F.filter("__pairs", lambda z: F.instr(z["run"], " ") < F.length(z["run"]))
    chains = F.transform(anchored, lambda z: F.concat(F.substring_index(z["run"], " ", -3), z["next"]))
    steps = steps.withColumn("__chains", chains)
    plain = F.transform("__pairs", lambda z: F.concat(z["run"], z["next"]))
    only = F.when(F.col("__words") != " ", F.array("__words")).otherwise(F.array().cast("array<string>"))
    chosen = (
        F.when(F.size("__chains") > 0, F.col("__chains")).when(F.size("__pairs") > 0, plain).otherwise(only)
    )
    steps = steps.withColumn("__chosen", chosen)
    codes = F.transform("__chosen", lambda s: F.crc32(s.cast("binary")))
    return steps.select(*kept, F.array_sort(F.array_distinct(codes)).alias(name))


def as_text(codes: Column) -> Column:
    """Eight hexadecimal digits per signature, in order."""
    return F.lower(F.concat_ws("", F.transform(codes, lambda c: F.lpad(F.hex(c), 8, "0"))))


def partition_of(codes: Column) -> Column:
    """The partition by set size: sets more than one apart are less alike than ``LEAST``."""
    return F.floor(F.log(F.greatest(F.size(codes), F.lit(1))) / F.lit(math.log(1 / LEAST))).cast("int")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sets of signatures; 0 where the sizes rule out ``LEAST``, and 1
    for two empty sets."""
    x, y = F.col(a), F.col(b)
    small = F.least(F.size(x), F.size(y)).cast("double")
    large = F.greatest(F.size(x), F.size(y)).cast("double")
    both = F.size(F.array_intersect(x, y)).cast("double")
    apart = F.abs(partition_of(x) - partition_of(y)) > 1
    return (
        F.when(large == 0, F.lit(1.0))
        .when(apart | (small < large * LEAST), F.lit(0.0))
        .otherwise(both / (small + large - both))
    )


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``signatures`` and their ``partition``; nothing is shuffled. A null
    text is empty."""
    found = with_signatures(docs.withColumn("__text", text_of(text)), "__text", "signatures")
    return found.drop("__text").withColumn("partition", partition_of(F.col("signatures")))


def next_documents(rows: DataFrame) -> DataFrame:
    """For every distinct id: ``receiver``, its longest text's length ``n``, and the place
    (``FILE``, ``ROW``) of the document with the next greater id; after the last the first.

    Of several rows with one id, that with the least hash of its text stands for it. A null id
    is one id, before all others. Only ids and lengths are ordered.
    """
    narrow = rows.select("doc_id", F.length("text").alias("n"), F.xxhash64("text").alias("h"), FILE, ROW)
    ids = materialize(
        narrow.groupBy("doc_id").agg(
            F.max("n").alias("n"), F.min(F.struct("h", FILE, ROW)).alias("at")
        ).select("doc_id", "n", F.col(f"at.{FILE}").alias("d_file"), F.col(f"at.{ROW}").alias("d_row")),
        "ids",
    )
    placed = in_order(ids, ["doc_id"], "id-order")
    first = F.struct("doc_id", "d_file", "d_row")
    parts = placed.groupBy(PART).agg(F.min_by(first, SEQ).alias("head"))
    # One row per range.
    along = W.orderBy(PART)
    every = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    heads = parts.select(
        PART, F.coalesce(F.lead("head").over(along), F.first("head").over(every)).alias("following")
    )
    inside = W.partitionBy(PART).orderBy(SEQ)
    return (
        placed.withColumn("donor", F.lead(first).over(inside))
        .join(heads, PART)
        .withColumn("donor", F.coalesce("donor", "following"))
        .select(
            F.col("doc_id").alias("receiver"),
            "n",
            F.col("donor.doc_id").alias("d_id"),
            F.col("donor.d_file").alias("d_file"),
            F.col("donor.d_row").alias("d_row"),
        )
    )


def op3_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike they are to it and to
    the next document's.

    The last quarter of the text is replaced by as many first characters of the next document.
    A null text is empty. Rows that share an id have the same next document. With one document,
    it is its own next.
    """
    rows = stored(docs, "doc_id", "text").select("doc_id", text_of("text").alias("text"), FILE, ROW)
    following = materialize(next_documents(rows), "next-documents")
    donors = rows.withColumnsRenamed({"doc_id": "own_id"})
    place = (F.col(FILE) == F.col("d_file")) & (F.col(ROW) == F.col("d_row"))
    if fits_broadcast(following, NEIGHBOUR_BYTES):
        given = donors.join(F.broadcast(following), place)
    else:  # the id takes part, so that the shuffle is the same as that of the receivers
        given = donors.join(following, F.col("own_id").eqNullSafe(F.col("d_id")) & place)
    given = with_signatures(given, "text", "next_signatures").select(
        "receiver", F.expr("substring(text, 1, n div 4)").alias("start"), "next_signatures"
    )
    edited = F.expr(
        "concat(substring(text, 1, length(text) - length(text) div 4), substring(start, 1, length(text) div 4))"
    )
    pairs = (
        rows.select("doc_id", "text")
        .join(given, F.col("doc_id").eqNullSafe(F.col("receiver")))
        .select("doc_id", "text", edited.alias("edited"), "next_signatures")
    )
    pairs = with_signatures(with_signatures(pairs, "text", "own"), "edited", "changed")
    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "next_signatures").alias("near_next"),
    )
