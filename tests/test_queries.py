"""Every registered query against its DuckDB oracle (sf0.001), plus entry()."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from small_tables import SF_SMALL
from stratum.plans.deltas import DELTA_QUERIES
from stratum.plans.queries import QUERIES
from stratum.streaming.queries import STREAM_QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# the optional training-data queries are tested by themselves
OWN = {*QUERIES, *STREAM_QUERIES, *DELTA_QUERIES}
# These run the same jobs for minutes as others that stay, with another mart or feed; ALL_QUERIES=1 runs them too
# (tools/oracle_check.py runs every query).
ALIKE = {"kept_qc_trend", "kept_qc_batch_quality", "kept_qc_analyst", "kept_lb_per_subject", "kept_vs_per_subject", "kept_gold_subject",
         "kept_order_summary", "refresh_lb", "refresh_equipment"}


def _norm(v):
    import datetime as dt

    import numpy as np
    import pandas as pd
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)):
        f = float(v)
        return None if math.isnan(f) else round(f, 9)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        if (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0):
            return v.date().isoformat()
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["test_name", "total_tests", "pass_count", "fail_count", "pass_pct", "fail_pct"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert OWN <= set(queries()) and OWN <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(OWN if os.environ.get("ALL_QUERIES") else OWN - ALIKE))
def test_query_matches_oracle(spark, duck, name):
    got = _canon(queries()[name](spark, SF_SMALL).toPandas())
    want = _canon(duck.execute(oracle_sql()[name]).fetchdf())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
