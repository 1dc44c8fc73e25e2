"""Property tests: the Spark checks against a plain-Python model of the rules on random totals."""

from __future__ import annotations

from datetime import UTC, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerproof.operators import checks as C
from ledgerproof.sources.landing import land_batch

from .conftest import totals

KEYS = ["2026-09-01", "2026-09-02", "2026-09-03", "None"]
side = st.dictionaries(
    st.sampled_from(KEYS),
    st.tuples(st.integers(0, 50), st.integers(-10**6, 10**6)).map(lambda t: (t[0], t[1], t[0])),
    max_size=4,
)


def _frame(spark, layer, d):
    return totals(spark, [(layer, k, rows, amount, distinct) for k, (rows, amount, distinct) in d.items()])


def _model_rows(src, tgt):
    out = {}
    for k in sorted(set(src) | set(tgt)):
        e = src[k][0] if k in src else 0
        a = tgt[k][0] if k in tgt else 0
        if e != a:
            out[k] = (e, a)
    return out


def _model_amount(src, tgt, tol, rel):
    out = {}
    for k in sorted(set(src) | set(tgt)):
        e = src[k][1] if k in src else 0
        a = tgt[k][1] if k in tgt else 0
        if abs(a - e) > max(tol, int(abs(e) * rel)):
            out[k] = (e, a)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(src=side, tgt=side)
def test_row_count_check_matches_model(spark, src, tgt):
    got = {r["partition_key"]: (r["expected"], r["actual"])
           for r in C.row_count_check(_frame(spark, "bronze", src), _frame(spark, "silver", tgt)).breaks.collect()}
    assert got == _model_rows(src, tgt)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(src=side, tgt=side, tol=st.integers(0, 1000), rel=st.sampled_from([0.0, 0.0005, 0.001, 0.01]))
def test_amount_check_matches_model(spark, src, tgt, tol, rel):
    check = C.amount_sum_check(_frame(spark, "silver", src), _frame(spark, "gold", tgt),
                               tolerance_minor=tol, relative_tolerance=rel)
    got = {r["partition_key"]: (r["expected"], r["actual"]) for r in check.breaks.collect()}
    assert got == _model_amount(src, tgt, tol, rel)


def test_landing_zone_aware_timestamps_become_utc_wall_clock(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [("EVT-00000001", "A1", 100, "GBP", "credit", "fee", datetime(2026, 9, 2, 3, 30, tzinfo=UTC), "s")],
            "event_id string, account_id string, amount_minor bigint, currency string, direction string, "
            "transaction_type string, occurred_at timestamp, source_system string",
        )
        row = land_batch(df, batch_id="b").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["occurred_at"] == datetime(2026, 9, 2, 3, 30)
    assert str(row["event_date"]) == "2026-09-02"


delivery = st.tuples(
    st.sampled_from(["E1", "E2", "E3", None]),      # event id (NULL ids must never merge)
    st.integers(0, 3),                               # ingested minute (ties are common)
    st.sampled_from(["b1", "b2", "b3"]),             # batch
    st.integers(0, 5),                               # source sequence
)


def _model_first_arrival(rows):
    kept, best = [], {}
    for r in rows:
        if r[0] is None:
            kept.append(r)
        elif r[0] not in best or r[1:] < best[r[0]][1:]:
            best[r[0]] = r
    return sorted(kept + list(best.values()), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(delivery, max_size=12, unique=True))
def test_first_arrival_matches_model(spark, rows):
    from ledgerproof.operators.dedup import dedup_bronze

    df = spark.createDataFrame(
        [(k, datetime(2026, 9, 1, 10, m), b, s) for k, m, b, s in rows],
        "event_id string, ingested_at timestamp_ntz, batch_id string, _src bigint",
    )
    got = sorted(((r[0], r[1].minute, r[2], r[3]) for r in dedup_bronze(df).collect()), key=repr)
    assert got == _model_first_arrival(rows)
