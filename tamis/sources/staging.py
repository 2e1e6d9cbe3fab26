"""Tables written between steps, and the size check that guards every broadcast.

A step whose result several later steps read is written once, as Parquet, below the
shared folder the cluster names in ``spark.checkpoint.dir``. That cuts the lineage and
survives the loss of any executor. Tables written inside ``scratch`` are removed at its end.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# In-memory size up to which the smaller side of a join is broadcast. The driver builds every
# broadcast and holds several of them at once, so this is a small part of its memory.
BROADCAST_BYTES = 32 * 1024 * 1024
# Size up to which a corpus is dealt out to all cores, per core.
SPLIT_BYTES = 32 * 1024 * 1024
# Values that a frequency sketch returns, and those it keeps track of.
FREQUENT = 1024
TRACKED = 16384
# What a hashed row costs beside its strings: key and value headers, pointers, doubles.
ROW_BYTES = 120


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables.

    ``spark.checkpoint.dir`` if the session has it, else the context's checkpoint folder.
    Only a local session without either gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tamis-"))
    return context.getCheckpointDir().rstrip("/")


_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_RUN.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder of its own, below the shared one, for all tables written inside the block. It is
    deleted at the end, so results must have been written elsewhere by then."""
    folder = new_path(spark, "run")
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write an intermediate table, which is read again soon: fewer bytes rather than less work."""
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and return the frame that reads it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    write_table(df, path, partition_by)
    read = spark.read.schema(df.schema).parquet(path)
    return read.select(*["`" + c.replace("`", "``") + "`" for c in df.columns])


# Rows that a task hands to Python at once where these are short.
BATCH_ROWS = 1000
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    # Sizes are not asked for: Spark does so for every row, which takes longer than handing it over.
    "spark.sql.execution.arrow.maxBytesPerBatch": str((1 << 31) - 1),
}


@contextmanager
def short_rows(spark: SparkSession) -> Iterator[None]:
    """Inside, rows go to Python in batches of ``BATCH_ROWS``, whatever their size. Only for steps whose
    rows are numbers or parts of texts, and which are worked out inside."""
    before = {name: spark.conf.get(name, None) for name in BATCHES}
    for name, value in BATCHES.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def localize(df: DataFrame) -> DataFrame:
    """Work out a frame of a few rows once. Only for one row per model, or per model and
    order."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def row_bytes(df: DataFrame) -> Column:
    """The size of a row in a broadcast table."""
    size = F.lit(ROW_BYTES)
    for field in df.schema.fields:
        if field.dataType.typeName() == "string":
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
    return size


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a small corpus to all cores.

    A file of one row group is read by one task however many cores there are. The size is what
    the scans below expect to read; it decides on the plan only, never on a result.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return df.repartition(cores) if size <= cores * SPLIT_BYTES else df


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a written table fit the broadcast limit, by counting them."""
    total = df.agg(F.sum(row_bytes(df))).first()[0]
    return (total or 0) <= limit


def checksums(*columns: str) -> list[Column]:
    """Order-free checksums of rows as aggregates ``check_low``, ``check_high``: the sums of the
    halves of their hashes, which lost, doubled or swapped rows change."""
    value = F.xxhash64(*columns)
    halves = (value.bitwiseAND((1 << 31) - 1), F.shiftrightunsigned(value, 33))
    return [F.sum(half).alias(name) for half, name in zip(halves, ("check_low", "check_high"))]


def lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner", *, broadcast: bool
) -> DataFrame:
    """Join many rows to a table that has each key once.

    ``broadcast`` says that the table's counted size allows a broadcast. Otherwise both sides
    are shuffled; where a single key may hold a large part of the rows, see ``frequent_lookup``.
    """
    return rows.join(F.broadcast(table) if broadcast else table, list(on), how)


def frequent_lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], key: str) -> DataFrame:
    """Inner join of many rows to a large table that has each key once, where single values of
    ``key`` (one of ``on``, a string) may hold any share of the rows.

    A frequency sketch finds the most frequent values: any value beyond a thousandth of the rows
    is among them. Their rows of the table, few by construction, are broadcast and their
    occurrences stay where they are; only the rest is shuffled, in which no value is frequent.
    The rows are worked out for each of the three steps.
    """
    top = F.expr(f"approx_top_k({key}, {FREQUENT}, {TRACKED})")
    most = rows.agg(top.alias("top")).select(F.inline("top")).select(F.col("item").alias(key))
    most = materialize(most, "frequent")
    hot = materialize(table.join(F.broadcast(most), key, "left_semi"), "frequent-rows")
    rest = rows.join(F.broadcast(most), key, "left_anti")
    found = lookup(rows, hot, on, broadcast=True)
    return found.unionByName(lookup(rest, table, on, broadcast=False))


def bounded(spark: SparkSession, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a table of a row per shuffle partition may be broadcast."""
    return int(spark.conf.get("spark.sql.shuffle.partitions")) * ROW_BYTES <= limit


def rows_before(size: str, *order: str | Column) -> Column:
    """Running total of ``size`` over the rows before this one.

    Only for frames with one row per partition, file or file split: they pass one task.
    """
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(before), F.lit(0))
