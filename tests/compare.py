"""Spark rows against DuckDB rows over the same parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if hasattr(value, "to_pydatetime"):
        return None if value != value else value.to_pydatetime()
    return value


def rows(table) -> list[tuple]:
    """Arrow rows with columns in order of name, sorted."""
    names = sorted(table.column_names)
    out = [tuple(plain(x) for x in r) for r in zip(*(table.column(n).to_pylist() for n in names), strict=True)]
    return sorted(out, key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    got, want = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} and {sorted(want.column_names)}"]
    kinds = [f"{n}: {got.schema.field(n).type} and {want.schema.field(n).type}" for n in sorted(got.column_names) if str(got.schema.field(n).type) != str(want.schema.field(n).type)]
    a, b = rows(got), rows(want)
    found = [f"{len(a)} and {len(b)} rows"] if len(a) != len(b) else []
    found += [f"{x} and {y}" for x, y in zip(a, b, strict=False) if x != y][:3]
    return found + (["types " + "; ".join(kinds)] if kinds else [])
