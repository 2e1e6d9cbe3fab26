"""Compare a Spark result with a DuckDB result, whatever the row order."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else repr(value))
    return (1, repr(value))


def rows_of(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(tuple(key(v) for v in row) for row in zip(*columns))


def difference(df, sql: str, connection) -> str | None:
    """What differs, or None."""
    ours = df.toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    names, rows = rows_of(ours)
    other_names, other_rows = rows_of(theirs)
    if names != other_names:
        return f"columns {names} / {other_names}"
    kinds = [(n, str(ours.schema.field(n).type), str(theirs.schema.field(n).type)) for n in names]
    kinds = [k for k in kinds if k[1] != k[2] and {k[1], k[2]} != {"string", "large_string"}]
    if kinds:
        return f"types {kinds}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows / {len(other_rows)}"
    unequal = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    return f"{len(unequal)} of {len(rows)} rows, first {unequal[0]}" if unequal else None
