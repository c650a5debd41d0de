"""Every registered query against its DuckDB twin on sf0.001, once as is and
once with every key forced through the hot-key split path."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from eventide import catalog
from data_dirs import SF_SMALL

TABLES = ["orders", "lineitem", "events"]
NAMES = sorted(catalog.ORACLES)
# queries whose plans go through plans.ordered (key splitting matters there)
ORDERED = [n for n in NAMES if n.startswith(("rolling", "most_active", "count_window", "nth_event",
                                              "buffered", "cep_"))]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


def _compare(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = _rows(tuple(r) for r in df.collect())
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    perm = [ocols.index(c) for c in cols]
    exp = _rows(tuple(r[i] for i in perm) for r in res.fetchall())
    assert len(got) == len(exp)
    assert got == exp


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    _compare(spark, con, name)


@pytest.mark.parametrize("name", ORDERED)
def test_query_matches_oracle_with_hot_keys(spark, con, name):
    spark.conf.set("eventide.ordered.slices", "50")
    try:
        _compare(spark, con, name)
    finally:
        spark.conf.unset("eventide.ordered.slices")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "event_type", "cnt", "rank"]
    assert df.count() > 0


ZONE_SENSITIVE = ["tumbling_count", "sliding_pv_per_uv", "window_join", "reconcile_payments", "periodic_pv",
                  "source_events"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_query_independent_of_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        _compare(spark, con, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
