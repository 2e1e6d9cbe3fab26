"""Reading corpora and giving every segment the number of its row.

A pair frame has ``seg_id, src, tgt``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .row_groups import FILE, ROW, read_row_groups, row_groups
from .staging import fits_broadcast, lookup, materialize, rows_before


def _texts(df: DataFrame, src_col: str, tgt_col: str) -> list[Column]:
    def text(column: str) -> Column:
        if column not in df.columns:
            raise ValueError(f"no column {column!r}; the corpus has {df.columns}")
        kind = df.schema[column].dataType
        quoted = F.col(f"`{column}`")
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            quoted = F.array_join(quoted, " ")
        elif not isinstance(kind, T.StringType):
            raise TypeError(f"column {column!r} is {kind.simpleString()}, not string or array<string>")
        return F.coalesce(quoted, F.lit(""))

    return [text(src_col), text(tgt_col)]


def project_text(df: DataFrame, src_col: str, tgt_col: str) -> DataFrame:
    """The two text columns as ``src`` and ``tgt``, null as the empty string; ``seg_id`` stays.

    Strings are taken as they are; arrays of strings are token lists and are joined by one
    space. Other types are rejected.
    """
    src, tgt = _texts(df, src_col, tgt_col)
    others = [c for c in df.columns if c == "seg_id"]
    return df.select(*others, src.alias("src"), tgt.alias("tgt"))


ORDER, SKIP = "__order", "__skip"


def _place(df: DataFrame) -> list[Column]:
    """File and row of a scan, under names of our own, whatever the columns are called."""
    meta = df.metadataColumn("_metadata")
    return [meta["file_path"].alias(FILE), meta["row_index"].alias(ROW)]


def _path_order(file: str) -> Column:
    # _metadata has the path as a URI; files are ordered by their plain names
    return F.url_decode(F.replace(F.col(file), F.lit("+"), F.lit("%2B")))


def _file_sizes(df: DataFrame) -> DataFrame:
    return df.select(*_place(df)).groupBy(FILE).agg(F.count(F.lit(1)).alias("size"))


def _offsets(sizes: DataFrame) -> DataFrame:
    """The rows in files that come before each file, from one count per file; written."""
    ordered = sizes.select(FILE, "size", _path_order(FILE).alias(ORDER))
    return materialize(
        ordered.select(FILE, ORDER, rows_before("size", ORDER).alias(SKIP)), "files"
    )


def _with_ids(located: DataFrame, offsets: DataFrame, columns: list[str]) -> DataFrame:
    # One row per file. The rows themselves are neither sorted nor shuffled while that fits.
    found = lookup(located, offsets.select(FILE, SKIP), [FILE], broadcast=fits_broadcast(offsets))
    number = (F.col(SKIP) + F.col(ROW)).alias("seg_id")
    return found.select(number, *[F.col(f"`{c}`") for c in columns])


def seg_ids(df: DataFrame) -> DataFrame:
    """Add ``seg_id``, the row number from 0 over the files in path order; a column of that name
    is replaced.

    ``df`` must come straight from a Parquet read.
    """
    columns = [c for c in df.columns if c != "seg_id"]
    located = df.select(*[F.col(f"`{c}`") for c in columns], *_place(df))
    return _with_ids(located, _offsets(_file_sizes(df)), columns)


def _glob(spark: SparkSession, path: str):
    """The file states that a glob matches, as an array of the JVM: asking it for its length is one
    call, however many files there are."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []


def _matching(spark: SparkSession, prefix: str) -> tuple[str | None, list]:
    """A glob of the files that Spark's reader takes, and the states of those that it passes over
    because of their names. The latter are looked for by a glob of their own, so that no other
    name comes to the driver."""
    if prefix.startswith("s3://"):
        prefix = "s3a://" + prefix.removeprefix("s3://")
    found = _glob(spark, prefix)
    is_folder = len(found) == 1 and found[0].isDirectory()
    pattern = f"{prefix.rstrip('/')}/*.parquet" if is_folder else f"{prefix}*.parquet"
    matches = len(_glob(spark, pattern))
    if not matches:
        raise FileNotFoundError(f"no Parquet files at {prefix}")
    folder, slash, start = pattern.rpartition("/")
    start = start.removesuffix("*.parquet")
    odd = f"{start}*.parquet" if start.startswith(("_", ".")) else "[_.]*.parquet" if not start else None
    states = [(f, f.getPath().getName()) for f in _glob(spark, f"{folder}{slash}{odd}")] if odd else []
    odd_files = [f for f, n in states if n.startswith(".") or (n.startswith("_") and "=" not in n)]
    return (pattern if matches > len(odd_files) else None), odd_files


@dataclass(frozen=True)
class Corpus:
    """A corpus in files: all ``pairs``, and ``first(n)``, the first n of them, for which only the
    files that hold them are read."""

    pairs: DataFrame
    first: Callable[[int], DataFrame]


def open_corpus(spark: SparkSession, prefix: str, src_col: str, tgt_col: str) -> Corpus:
    """Parquet files as pair frames: those directly in the folder ``prefix``, or else those whose
    path starts with ``prefix``. No match is an error. Files whose names Spark passes over
    (``_x.parquet``, ``.x.parquet``) are read by row groups."""
    pattern, odd_files = _matching(spark, prefix)
    scans, counts = [], []
    if pattern:
        files = spark.read.parquet(pattern)
        texts = [c.alias(name) for c, name in zip(_texts(files, src_col, tgt_col), ("src", "tgt"))]
        located = files.select(*texts, *_place(files))
        scans.append(lambda head: located.filter(head))
        counts.append(_file_sizes(files))
    if odd_files:
        groups = row_groups(spark, odd_files)
        scans.append(lambda head: read_row_groups(groups.filter(head), src_col, tgt_col))
        counts.append(groups.groupBy(FILE).agg(F.sum("size").alias("size")))
    offsets = _offsets(reduce(DataFrame.unionByName, counts))

    def numbered(head: Column) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [scan(head) for scan in scans])
        return _with_ids(rows, offsets, ["src", "tgt"])

    def first(n: int) -> DataFrame:
        last = offsets.filter(F.col(SKIP) < n).agg(F.max(ORDER)).first()[0]
        # The files up to one in path order; their rows keep their numbers.
        return numbered(_path_order(FILE) <= F.lit(last or "")).filter(F.col("seg_id") < n)

    return Corpus(numbered(F.lit(True)), first)


def read_corpus(spark: SparkSession, prefix: str, src_col: str, tgt_col: str) -> DataFrame:
    """All pairs of ``open_corpus``."""
    return open_corpus(spark, prefix, src_col, tgt_col).pairs


def read_corpus_head(
    spark: SparkSession, prefix: str, src_col: str, tgt_col: str, n: int
) -> DataFrame:
    """The first ``n`` pairs of ``open_corpus``."""
    return open_corpus(spark, prefix, src_col, tgt_col).first(n)


def _numbered(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("mark"),
        F.col("value").alias("text"),
    )
    # Written once: sizes and numbers then come from the same cut of the files into splits.
    lines = materialize(lines, "lines")
    splits = materialize(
        lines.groupBy("file", "start").agg(
            F.min("mark").alias("first"), F.count(F.lit(1)).alias("size")
        ),
        "splits",
    )
    total = splits.agg(F.sum("size")).first()[0] or 0
    skip = rows_before("size", _path_order("file"), F.col("start")).alias("skip")
    offsets = splits.select("file", "start", "first", skip)
    number = (F.col("skip") + F.col("mark") - F.col("first")).alias("seg_id")
    numbered = lookup(lines, offsets, ["file", "start"], broadcast=fits_broadcast(splits))
    return numbered.select(number, "text"), total


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files as ``seg_id, text``, numbered from 0 in file order.

    A line's number is the count of lines in earlier splits of the files plus its place in
    its own split. Within a split the generated ids are consecutive, and splits are told
    apart by file and start offset. The files are read once, however they are split.
    """
    return _numbered(spark, path)[0]


def read_parallel_text(spark: SparkSession, prefix: str, src_lang: str, tgt_lang: str) -> DataFrame:
    """Two line-aligned texts ``prefix.<lang>`` as a pair frame; unequal lengths are an error."""
    (src, n), (tgt, m) = (_numbered(spark, f"{prefix}.{lang}") for lang in (src_lang, tgt_lang))
    if n != m:
        raise ValueError(f"{prefix}: {n} {src_lang} lines, {m} {tgt_lang} lines")
    return src.withColumnRenamed("text", "src").join(tgt.withColumnRenamed("text", "tgt"), "seg_id")
