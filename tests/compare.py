"""Compare a Spark result with its DuckDB check: rows, column names and types, values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def compare(spark_df, con, text: str) -> list[str]:
    """Differences found, empty when both sides agree exactly."""
    rel = con.execute(text)
    duck_cols = [(d[0], str(d[1])) for d in rel.description]
    duck_rows = rel.fetchall()
    spark_cols = spark_df.dtypes
    problems = []
    if sorted(n for n, _ in spark_cols) != sorted(n for n, _ in duck_cols):
        return [f"columns {sorted(n for n, _ in spark_cols)} / {sorted(n for n, _ in duck_cols)}"]
    duck_type = dict(duck_cols)
    for name, kind in spark_cols:
        if KINDS.get(kind) != duck_type[name]:
            problems.append(f"type of {name}: {kind} / {duck_type[name]}")
    names = sorted(n for n, _ in spark_cols)
    index = {n: i for i, (n, _) in enumerate(duck_cols)}
    left = Counter(tuple(_plain(r[n]) for n in names) for r in spark_df.collect())
    right = Counter(tuple(_plain(r[index[n]]) for n in names) for r in duck_rows)
    if sum(left.values()) != sum(right.values()):
        problems.append(f"rows {sum(left.values())} / {sum(right.values())}")
    if left != right:
        only_l, only_r = sorted((left - right).elements(), key=str), sorted((right - left).elements(), key=str)
        problems.append(f"{len(only_l)} rows differ; columns {names}")
        problems += [f"  spark  {str(r)[:420]}" for r in only_l[:3]] + [f"  duckdb {str(r)[:420]}" for r in only_r[:3]]
    return problems
