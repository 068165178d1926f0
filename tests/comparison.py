"""Compare a query with its SQL, as sorted rows with doubles rounded."""

import glob
import os

import duckdb
import pandas as pd


def connection(sf_dir: str):
    c = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(float).round(9)
        df[c] = df[c].astype(str).replace({"None": "-", "nan": "-", "<NA>": "-", "NaT": "-"})
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def assert_same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    a, b = canonical(got), canonical(want)
    assert list(a.columns) == list(b.columns)
    assert len(a) == len(b)
    pd.testing.assert_frame_equal(a, b)
