"""Helpers shared by the operators of this package."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.sources.staging import fits_broadcast, materialize

# Internal columns. Every operator first selects what it needs; where a stage hands on all
# columns of the caller, ``plain`` takes them out of the way of these.
FILE, ROW = "__file", "__row"
PART, SEQ = "__part", "__seq"

# Counted size up to which a narrow table of rows is broadcast to the documents; beyond it, the
# documents are shuffled to it.
NARROW_BYTES = 64 * 1024 * 1024

PARTITION_BITS = 33  # monotonically_increasing_id(): partition above, row below


def quoted(name: str) -> str:
    """A column name as it stands, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def named_columns(df: DataFrame, **columns: str) -> DataFrame:
    """The given columns only, under the names of the keywords."""
    return df.select(*[df[quoted(column)].alias(name) for name, column in columns.items()])


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_of(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes."""
    return F.crc32(F.encode(text, "UTF-8"))


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """A fixed fold per document: CRC-32 of the id as text. A null id is in no fold (-1)."""
    return F.coalesce(F.pmod(utf8_crc32(doc_id.cast("string")), F.lit(folds)).cast("int"), F.lit(-1))


def plain(docs: DataFrame, *known: str) -> DataFrame:
    """All columns under names that clash with nothing; those ``known`` keep theirs. ``restored``
    gives the others their names back."""
    names = [c if c in known else f"c{i}" for i, c in enumerate(docs.columns)]
    return docs.select(*[docs[quoted(c)].alias(name) for c, name in zip(docs.columns, names)])


def restored(rows: DataFrame, inner: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, from rows that have those of ``inner``, which ``plain`` made."""
    return rows.select(*[F.col(name).alias(c) for name, c in zip(inner.columns, docs.columns)])


def _place(rows: DataFrame) -> list[Column]:
    # asked for like this, it is the file's own also where a column is called the same
    meta = rows.metadataColumn("_metadata")
    return [meta["file_path"].alias(FILE), meta["row_index"].alias(ROW)]


def in_files(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns as a plain read of files; a frame that is none is written first. What joins
    several ``stored`` frames of the same documents starts from here."""
    wanted = docs.select(*[docs[quoted(c)] for c in columns or docs.columns])
    try:
        wanted.select(*_place(wanted))
        return wanted
    except AnalysisException:
        return materialize(wanted, "stored")


def stored(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns with the place of each row in storage: ``FILE`` and ``ROW``.

    The place identifies a row, repeated ones included, and is the same in every scan,
    however the files are split. Columns whose names may clash with these go through ``plain``.
    """
    rows = in_files(docs, *columns)
    return rows.select(*[rows[quoted(c)] for c in rows.columns], *_place(rows))


def with_places(rows: DataFrame, narrow: DataFrame) -> DataFrame:
    """The rows of ``stored`` joined to a written narrow table with a row for each of them."""
    small = fits_broadcast(narrow, NARROW_BYTES)
    return rows.join(F.broadcast(narrow) if small else narrow, [FILE, ROW])


def in_order(rows: DataFrame, by: Sequence[str | Column], name: str) -> DataFrame:
    """Write rows in a global order and add ``PART``, the range of the order a row lies in,
    and ``SEQ``, its place there (from 0).

    Rows equal in ``by`` are spread over ranges by their place in the input, so that one
    value may hold any share of the rows. ``rows`` should be narrow and cheap to read: the
    range boundaries are found in a pass of their own.
    """
    tie = "__tie"
    keyed = rows.withColumn(tie, F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(*by, tie).sortWithinPartitions(*by, tie).drop(tie)
    at = F.monotonically_increasing_id()
    placed = ranged.withColumn(SEQ, at).select(
        *rows.columns,
        F.shiftrightunsigned(SEQ, PARTITION_BITS).cast("int").alias(PART),
        F.col(SEQ).bitwiseAND((1 << PARTITION_BITS) - 1).alias(SEQ),
    )
    return materialize(placed, name)


def totals_before(placed: DataFrame, **sums: str | Column) -> DataFrame:
    """One row per range: ``PART`` and, for each name, the total over all ranges before it;
    under ``all_`` and the name, the total over all ranges.

    The windows run over one row per range, of which there are at most as many as shuffle
    partitions.
    """
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy(PART).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    totals = placed.groupBy(PART).agg(
        *[F.sum(F.lit(1) if of == "*" else of).cast("long").alias(name) for name, of in sums.items()]
    )
    return totals.select(
        PART,
        *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in sums],
        *[F.sum(name).over(every).alias(f"all_{name}") for name in sums],
    )
