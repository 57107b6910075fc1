"""Order-free comparison of a Spark result with DuckDB's."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str, sql: str) -> pd.DataFrame:
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return c.execute(sql).fetchdf()


def cell(v):
    if v is None or v is pd.NA or isinstance(v, float) and v != v:
        return None
    if isinstance(v, bool) or type(v).__name__ in ("bool_", "bool"):
        return bool(v)
    try:
        f = float(v)
        return int(f) if f.is_integer() else round(f, 6)
    except (TypeError, ValueError):
        return str(v)


def rows(df: pd.DataFrame) -> list:
    return sorted(repr(tuple(cell(v) for v in r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


def assert_same(got: pd.DataFrame, expected: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)
