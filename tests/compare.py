"""Row-for-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        frame[c] = frame[c].map(lambda v: "" if pd.isna(v) else f"={v!r}" if isinstance(v, str)
                                else repr(float(v)))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def assert_same(actual: pd.DataFrame, expected: pd.DataFrame) -> None:
    """Same rows, in any order, to the last digit."""
    assert sorted(actual.columns) == sorted(expected.columns)
    assert len(actual) == len(expected), f"{len(actual)} rows, expected {len(expected)}"
    left, right = canonical(actual), canonical(expected)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        row = unequal.idxmax()
        cells = {c: (left[c][row], right[c][row]) for c in left if left[c][row] != right[c][row]}
        raise AssertionError(f"{int(unequal.sum())} rows differ, first: {cells}")


def assert_close(actual: pd.DataFrame, expected: pd.DataFrame, keys: list[str],
                 tolerance: float = 1e-8) -> None:
    """Same rows by key, numbers within a tolerance."""
    assert sorted(actual.columns) == sorted(expected.columns)
    left, right = (f.set_index(keys).sort_index() for f in (actual, expected))
    pd.testing.assert_frame_equal(left[sorted(left)], right[sorted(right)], check_dtype=False,
                                  rtol=0, atol=tolerance)
