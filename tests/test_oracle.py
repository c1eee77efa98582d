"""Spark queries vs their DuckDB SQL on the smallest tables (the driver does it at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from spendlens.sources.tables import TABLES

from conftest import SF_SMALL

FAST = ["clean_expenses", "split_random", "split_group", "baseline_accuracy", "dataset_profile",
        "split_balanced_unseen", "oversample_minority", "classification_report", "tfidf_word",
        "amount_bins", "vendor_fallback", "repeated_baseline_stats"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    out = E.entry(spark).collect()
    assert len(out) == 1 and 0.0 <= out[0]["accuracy"] <= 1.0
