"""Comparison of Spark rows with DuckDB rows over the shared tables."""

from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FOLDER = "/root/testdata/sf0.001"


def available():
    return Path(FOLDER, "documents.parquet").exists()


def rows(frame, columns):
    def plain(v):
        return None if pd.isna(v) else v.item() if hasattr(v, "item") else v

    return sorted(repr(tuple(plain(v) for v in r)) for r in frame[columns].itertuples(index=False))


def same(spark, query, sql, folder=FOLDER):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    mine, theirs = query(spark, folder).toPandas(), db.sql(sql).df()
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    assert rows(mine, columns) == rows(theirs, columns)
