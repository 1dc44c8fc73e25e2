"""JSON line validation (B9, A6, R8) and the incremental file stream (A4, I1-I5, R5)."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerproof.schemas import BRONZE_COLUMNS
from ledgerproof.sources.json_lines import LONE_HALF, parse_event_lines, split_event_lines
from ledgerproof.streaming.autoload import autoload_stream, read_dead_letter, read_stream_bronze

GOOD = {
    "event_id": "LDG-73310042", "account_id": "K-7", "amount_minor": 100, "currency": "GBP",
    "direction": "credit", "transaction_type": "refund", "occurred_at": "2026-09-01T00:00:00Z", "source_system": "till",
}


def _parse(spark, *payloads):
    lines = [(str(i), p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return {r["line_id"]: r for r in parse_event_lines(spark.createDataFrame(lines, "line_id string, raw string")).collect()}


def test_valid_line_parses(spark):
    r = _parse(spark, GOOD)["0"]
    assert r["failed_rules"] == [] and r["event_id"] == GOOD["event_id"] and r["amount_minor"] == 100
    assert r["occurred_at"] == datetime(2026, 9, 1)


def test_malformed_array_and_null_are_not_objects(spark):
    out = _parse(spark, "{not json", "[1, 2, 3]", "null")
    assert all(r["failed_rules"] == ["json_object"] for r in out.values())


def test_currency_normalised_and_checked(spark):
    out = _parse(spark, {**GOOD, "currency": "\tgbp "}, {**GOOD, "currency": "POUNDS"}, {**GOOD, "currency": "gb"})
    assert out["0"]["currency"] == "GBP" and out["0"]["failed_rules"] == []
    assert out["1"]["failed_rules"] == ["currency"] and out["2"]["failed_rules"] == ["currency"]


def test_lax_integer_amounts(spark):
    out = _parse(spark, {**GOOD, "amount_minor": "100"}, {**GOOD, "amount_minor": 100.0},
                 {**GOOD, "amount_minor": 100.5}, {**GOOD, "amount_minor": 0}, {**GOOD, "amount_minor": "abc"})
    assert out["0"]["amount_minor"] == 100 and out["1"]["amount_minor"] == 100
    assert [out[k]["failed_rules"] for k in "234"] == [["amount_minor"]] * 3


def test_ids_must_be_long_enough_strings(spark):
    out = _parse(spark, {**GOOD, "event_id": 12345678}, {**GOOD, "event_id": "EVT-123"}, {**GOOD, "account_id": ""})
    assert out["0"]["failed_rules"] == ["event_id"] and out["1"]["failed_rules"] == ["event_id"]
    assert out["2"]["failed_rules"] == ["account_id"]


def test_enums_and_missing_fields(spark):
    missing = {k: v for k, v in GOOD.items() if k != "source_system"}
    out = _parse(spark, {**GOOD, "direction": "DEBIT"}, {**GOOD, "transaction_type": "gift"}, missing,
                 {**GOOD, "extra": 1})
    assert out["0"]["failed_rules"] == ["direction"] and out["1"]["failed_rules"] == ["transaction_type"]
    assert out["2"]["failed_rules"] == ["source_system"] and out["3"]["failed_rules"] == []


def test_timestamps_no_zone_is_utc_offset_converted(spark):
    out = _parse(spark, {**GOOD, "occurred_at": "2026-09-01T12:00:00"},
                 {**GOOD, "occurred_at": "2026-09-01T23:30:00-05:00"}, {**GOOD, "occurred_at": "yesterday"})
    assert out["0"]["occurred_at"] == datetime(2026, 9, 1, 12)
    assert out["1"]["occurred_at"] == datetime(2026, 9, 2, 4, 30)
    assert out["2"]["failed_rules"] == ["occurred_at"]


def _told(text):
    """An independent reading of a timestamp: by hand, piece by piece; None where it is none."""
    if len(text) < 10 or not all(c.isdigit() if i not in (4, 7) else c == "-" for i, c in enumerate(text[:10])):
        return None
    try:
        day = datetime(int(text[:4]), int(text[5:7]), int(text[8:10]))
        rest = text[10:]
        if not rest:
            return day
        if rest[0] not in "Tt _" or rest[3] != ":" or not (rest[1:3] + rest[4:6]).isdigit() or len(rest[4:6]) < 2:
            return None
        out, rest = day.replace(hour=int(rest[1:3]), minute=int(rest[4:6])), rest[6:]
        if rest[:1] == ":":
            if not rest[1:3].isdigit() or len(rest[1:3]) < 2:
                return None
            out, rest = out.replace(second=int(rest[1:3])), rest[3:]
            if rest[:1] in (".", ","):
                n = 1
                while rest[n:n + 1].isdigit():
                    n += 1
                if n == 1:
                    return None
                out, rest = out.replace(microsecond=int(rest[1:n][:6].ljust(6, "0"))), rest[n:]
        if rest in ("", "Z", "z"):
            return out
        hours, minutes = rest[1:3], rest[4:] if rest[3:4] == ":" else rest[3:]
        if rest[0] not in "+-\u2212" or len(hours + minutes) != 4 or not (hours + minutes).isdigit() or hours > "23" or minutes > "59":
            return None
        shift = timedelta(hours=int(hours), minutes=int(minutes))
        return out - shift if rest[0] == "+" else out + shift
    except (ValueError, IndexError):
        return None


def test_timestamps_equal_a_reading_by_hand(spark):
    times = ["T12:00Z", "_12:00:00Z", " 12:00:00,5", "t12:00:00.1234567z", "T12:00:00+02", "T12:00:00+0230", "T12:00:00-02:30", "T24:00:00",
             "T23:59:60", "T12:00:00.", "T12:00:00+24:00", "T12:00:00\u221201:00", "T12", "T12:0", "T12:00:0", "T1:00:00", "x12:00", "Z", "T12:00:00 Z",
             "T12:00:00+02:60", "T12:00+01:00", "T12:00:00Z\n", ""]
    texts = [f"2026-09-01{t}" for t in times] + ["2026-02-29", "2024-02-29T23:59:59.999999+00:01", "0000-01-01", "9999-12-31T23:59:59Z", "2026-9-1"]
    out = _parse(spark, *[{**GOOD, "occurred_at": t} for t in texts])
    for i, t in enumerate(texts):
        assert out[str(i)]["occurred_at"] == _told(t), t
        assert out[str(i)]["failed_rules"] == ([] if _told(t) else ["occurred_at"]), t


def test_lines_are_read_as_a_strict_json_reader_reads_them(spark):
    def line(**k):
        return json.dumps({**GOOD, **k})

    open_, whole = line()[:-1], line(x={"a": [1, "}"]})
    lines = [open_ + ', "event_id": "LAST-0001"}', open_ + ', "x": NaN}', open_ + ', "x": -Infinity}', line(event_id="HALF-\ud800-01"),
             line(event_id="LOW-\udc00-0001"), line(x="\ud800"), line(event_id="PAIR-\U0001f600-01"), line(event_id="BACK-\\ud800-01"), whole, whole + "]",
             whole + "}", whole + whole, whole + ", {}", whole + ', "b": 1', "\ufeff" + line(), line() + " \t\r", "[" + whole + "]", "{}", "", "NaN", '"x"',
             open_ + ",}", line().replace('"', "'"), open_ + ', "x": 01}', open_ + ', "x": "\t"}', open_ + ', "x": "\\q"}', line(account_id="tab\there"),
             open_ + ', "amount_minor": 5, "amount_minor": 7}', line(currency="\u00a0e\u00fcr\u2003"), line(currency="\x1cusd\x85"), line(currency="us\u00a0"),
             line(amount_minor="\u00a012 "), line(amount_minor=None), line(x=[[[{}]]])]
    out = _parse(spark, *lines)
    for i, raw in enumerate(lines):
        try:
            doc = json.loads(raw)
        except ValueError:
            doc = None
        got = out[str(i)]
        if not isinstance(doc, dict):
            assert got["failed_rules"] == ["json_object"], raw
            continue
        assert "json_object" not in got["failed_rules"], raw
        sound = isinstance(doc.get("event_id"), str) and not any("\ud800" <= c <= "\udfff" for c in doc["event_id"])
        assert got["event_id"] == (doc["event_id"] if sound else None), raw
        currency = doc.get("currency", "").strip().upper()
        assert ("currency" in got["failed_rules"]) == (len(currency) != 3 or not currency.isalpha()), raw
        if "amount_minor" not in got["failed_rules"]:
            assert got["amount_minor"] == int(doc["amount_minor"]), raw
        else:
            assert doc.get("amount_minor") is None, raw


def test_a_line_is_searched_and_parsed_once(spark):
    lines = spark.createDataFrame([("0", json.dumps(GOOD))], "line_id string, raw string")
    plan = parse_event_lines(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(LONE_HALF) == 2  # found, and replaced where found
    assert plan.count("from_json(") == 3  # a line as it is, and a line with braces inside in either frame


def test_lines_with_and_without_escapes_are_read_alike(spark):
    events = [{**GOOD, "source_system": s, "amount_minor": a} for s in ("till", "tïll", "\U0001f600", "a\\ud800", "\ud800", "x\udc00") for a in (5, 0)]
    plain = [json.dumps(e, ensure_ascii="\ud800" <= e["source_system"] < "\ue000" or "\udc00" in e["source_system"]) for e in events]
    escaped = [json.dumps(e) for e in events]
    nested = [json.dumps({**e, "more": {"deep": [1]}}) for e in events]
    out = _parse(spark, *plain, *escaped, *nested)
    for i, e in enumerate(events):
        sound = not any("\ud800" <= c <= "\udfff" for c in e["source_system"])
        for k in (i, i + len(events), i + 2 * len(events)):
            r = out[str(k)]
            assert r["source_system"] == (e["source_system"] if sound else None)
            assert r["failed_rules"] == ["amount_minor"] * (not e["amount_minor"]) + ["source_system"] * (not sound)


def test_several_failures_are_all_reported(spark):
    r = _parse(spark, {**GOOD, "amount_minor": 0, "currency": None, "direction": "up"})["0"]
    assert r["failed_rules"] == ["amount_minor", "currency", "direction"]


def test_split_keeps_every_line(spark):
    lines = spark.createDataFrame([("a", json.dumps(GOOD)), ("b", "{not json")], "line_id string, raw string")
    valid, dead = split_event_lines(lines, keep=("line_id",))
    assert [r["line_id"] for r in valid.collect()] == ["a"]
    assert [(r["line_id"], r["failed_rules"]) for r in dead.collect()] == [("b", ["json_object"])]


def test_stream_ingests_each_file_once_and_is_replay_safe(spark, tmp_path):
    root = str(tmp_path)
    landing, bronze, dead, ckpt = (f"{root}/{d}" for d in ("landing", "bronze", "dead", "ckpt"))

    def drop(rows):
        spark.createDataFrame([(r,) for r in rows], "raw string").coalesce(1).write.mode("append").text(landing)

    def run():
        autoload_stream(spark, landing, bronze, dead, ckpt).awaitTermination()

    drop([json.dumps(GOOD), json.dumps({**GOOD, "event_id": "EVT-00000100", "direction": "debit"}), "{bad"])
    run()
    assert read_stream_bronze(spark, bronze).count() == 2
    run()  # nothing new: still 2
    assert read_stream_bronze(spark, bronze).count() == 2
    drop([json.dumps({**GOOD, "event_id": "EVT-00000101"})])
    run()
    out = read_stream_bronze(spark, bronze)
    assert out.count() == 3
    assert tuple(out.columns[:12]) == BRONZE_COLUMNS
    assert out.filter("event_id = 'EVT-00000100'").first()["signed_amount_minor"] == -100
    assert set(r["batch_id"] for r in out.collect()) == {"autoloader"}
    assert read_dead_letter(spark, dead).select(F.array_join("failed_rules", ",")).collect()[0][0] == "json_object"


def test_replayed_epoch_replaces_its_own_output(spark, tmp_path):
    from ledgerproof.streaming.autoload import _epoch_writer

    bronze, dead = str(tmp_path / "bronze"), str(tmp_path / "dead")
    batch = spark.createDataFrame(
        [(json.dumps(GOOD), "f1"), ("{bad", "f1")], "raw string, source_file string"
    )
    write = _epoch_writer(bronze, dead, "autoloader")
    write(batch, 7)
    write(batch, 7)  # the same micro-batch again, as after a failure before the checkpoint commit
    assert read_stream_bronze(spark, bronze).count() == 1
    assert read_dead_letter(spark, dead).count() == 1
    write(batch, 8)
    assert read_stream_bronze(spark, bronze).count() == 2


def test_typed_json_read_with_declared_schema(spark, tmp_path):
    from ledgerproof.sources.json_lines import read_events_json

    path = str(tmp_path / "events")
    spark.createDataFrame([(json.dumps(GOOD),), (json.dumps({**GOOD, "amount_minor": "x"}),)], "v string") \
        .coalesce(1).write.text(path)
    rows = read_events_json(spark, path).collect()
    assert len(rows) == 2 and sorted(str(r["amount_minor"]) for r in rows) == ["100", "None"]


def test_sizing_conf_scales_with_input():
    from ledgerproof.session import sizing_conf

    small = sizing_conf(10 * 1024**2, 8)
    big = sizing_conf(100 * 1024**4, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
