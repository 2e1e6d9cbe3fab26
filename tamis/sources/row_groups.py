"""Reading Parquet files that Spark's own reader passes over because of their names.

The files are cut into row groups, which tasks read in batches. Spark knows the files by name and
never lists them, so nothing has to be renamed or copied.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import materialize

FILE, ROW = "__file", "__row"
BATCH_ROWS = 1024


def _opened(path: str):
    """The Parquet file of a Hadoop path, in whatever store it is."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        store, name = fs.LocalFileSystem(), (rest if colon else path)
        return pq.ParquetFile("/" + name.lstrip("/"), filesystem=store)
    authority, _, name = rest.removeprefix("//").partition("/")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return pq.ParquetFile(f"{base.rstrip('/')}/{name}", filesystem=store)


def row_groups(spark: SparkSession, states: list) -> DataFrame:
    """One row for each row group: ``__file`` as Spark's scans name it, ``path``, the number of the
    ``group``, the rows that come ``before`` it in the file, and its ``size``; written. Each file's
    footer is read by a task."""
    named = [(f.getPath().toUri().toString(), f.getPath().toString()) for f in states]
    files = spark.createDataFrame(named, f"{FILE} string, path string").repartition(len(named))

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, path in zip(*[column.to_pylist() for column in batch.columns]):
                meta, before = _opened(path).metadata, 0
                for group in range(meta.num_row_groups):
                    size = meta.row_group(group).num_rows
                    row = {FILE: file, "path": path, "group": group, "before": before, "size": size}
                    yield pa.RecordBatch.from_pylist([row], schema=_GROUP)
                    before += size

    return materialize(
        files.mapInArrow(footers, f"{FILE} string, path string, group int, before long, size long"), "groups"
    )


_GROUP = pa.schema(
    [(FILE, pa.string()), ("path", pa.string()), ("group", pa.int32()), ("before", pa.int64()), ("size", pa.int64())]
)


def _text(column: pa.Array, name: str) -> list[str]:
    """Strings as they are, token lists joined by one space, null as the empty string."""
    kind = column.type
    if pa.types.is_dictionary(kind):
        kind = kind.value_type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return [value or "" for value in column.to_pylist()]
    if (pa.types.is_list(kind) or pa.types.is_large_list(kind)) and (
        pa.types.is_string(kind.value_type) or pa.types.is_large_string(kind.value_type)
    ):
        return [" ".join(t for t in value or () if t is not None) for value in column.to_pylist()]
    raise TypeError(f"column {name!r} is {kind}, not string or list of strings")


def read_row_groups(groups: DataFrame, src_col: str, tgt_col: str) -> DataFrame:
    """``src``, ``tgt``, ``__file`` and ``__row`` of all rows; every row group is a task's work, of
    which it holds one batch of rows at a time."""
    tasks = max(groups.count(), 1)
    kind = pa.schema([("src", pa.string()), ("tgt", pa.string()), (FILE, pa.string()), (ROW, pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.to_pylist():
                file, row = _opened(group["path"]), group["before"]
                have = file.schema_arrow.names
                for name in (src_col, tgt_col):
                    if name not in have:
                        raise ValueError(f"no column {name!r}; {group['path']} has {have}")
                wanted = sorted({src_col, tgt_col})
                for part in file.iter_batches(BATCH_ROWS, row_groups=[group["group"]], columns=wanted):
                    n = part.num_rows
                    texts = [_text(part.column(name), name) for name in (src_col, tgt_col)]
                    rows = [*texts, [group[FILE]] * n, range(row, row + n)]
                    arrays = [pa.array(values, field.type) for values, field in zip(rows, kind)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=kind)
                    row += n

    spec = f"src string, tgt string, {FILE} string, {ROW} long"
    dealt = groups.select(FILE, "path", "group", "before").repartition(tasks, F.col("path"), F.col("group"))
    return dealt.mapInArrow(read, spec)
