"""Run a query on Spark and its SQL on DuckDB, and compare schema and values."""

from __future__ import annotations

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str, pattern: str = "") -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet{pattern}')")
    return con


def canonical(arrow) -> list[str]:
    names = sorted(arrow.column_names)
    data = [arrow.column(n).to_pylist() for n in names]
    return sorted(repr(tuple(_plain(v) for v in row)) for row in zip(*data))


def _plain(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return v


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results agree; otherwise a short account of the first difference."""
    left = spark_df.toArrow()
    right = con.sql(sql).to_arrow_table()
    if sorted(left.column_names) != sorted(right.column_names):
        return f"columns {sorted(left.column_names)} vs {sorted(right.column_names)}"
    if left.num_rows != right.num_rows:
        return f"rows {left.num_rows} vs {right.num_rows}"
    types = [
        (n, str(left.schema.field(n).type), str(right.schema.field(n).type))
        for n in sorted(left.column_names)
        if str(left.schema.field(n).type).replace("large_", "") != str(right.schema.field(n).type).replace("large_", "")
    ]
    if types:
        return f"types {types}"
    a, b = canonical(left), canonical(right)
    odd = [(x, y) for x, y in zip(a, b) if x != y]
    if odd:
        return f"{len(odd)} rows differ, first: {odd[0]}"
    return None
