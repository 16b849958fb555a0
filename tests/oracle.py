"""Compare registered queries with their SQL in DuckDB: names, row counts and values, order aside."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return db


def rows_of(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=lambda k: names[k])
    norm = lambda v: 0.0 if isinstance(v, float) and v == 0 else (v.date() if hasattr(v, "date") and hasattr(v, "hour") and (v.hour, v.minute) == (0, 0) else v)
    return sorted([tuple(norm(r[k]) for k in order) for r in rows], key=repr)


def difference(spark, db, name: str, query, sql: str, sf_dir: str) -> str | None:
    """What differs, or None."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = db.execute(sql)
    names = [d[0] for d in rel.description]
    want = rows_of(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"{name}: columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows, SQL has {len(want)}"
    bad = [(a, b) for a, b in zip(got, want, strict=True) if repr(a) != repr(b)]
    return f"{name}: {len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None
