"""Every registered query against its DuckDB oracle at sf0.001 (the driver does the same at sf0.01)."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns == ["layer", "partition_key", "row_count", "amount_minor_sum",
                                             "distinct_event_ids"]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, cur.fetchall())


ZONE_SENSITIVE = ("land_batch", "silver_valid", "totals_silver", "validate_json", "dead_letter",
                  "dim_account")


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_the_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    cur = con.execute(oracle_sql()[name])
    assert _canon(cols, rows) == _canon([d[0] for d in cur.description], cur.fetchall())
