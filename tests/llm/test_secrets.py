"""Candidates and features against plain Python, false positives removed, odd rows, no Python in the plan."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerproof.llm import secrets

from ..conftest import SF_SMALL

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def corpus(n=160):
    rng = random.Random(8)
    hexa, caps = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

    def of(letters, k):
        return "".join(rng.choice(letters) for _ in range(k))

    rows, truth = [], {}
    for k in range(n):
        value, text, secret = [
            lambda: (v := of(hexa, 40), f'some words then token = "{v}" and the rest é', True),
            lambda: (v := "AKIA" + of(caps, 15) + "7", f"the key {v} was left here", True),
            lambda: (v := of("0123456789", 16), f"order number {v} was sent", False),
            lambda: (v := f"{of(hexa, 6)}.12@mail.example.com", f"write to {v} today", False),
        ][k % 4]()
        rows.append((k, text, "src/app" if secret else "docs/readme"))
        truth[k] = (value, secret)
    return rows, truth


def test_candidates_have_their_places(spark):
    rows, _ = corpus(40)
    rows += [(900, None, "p"), (901, "", None), (902, "abcdefghijklmnop only letters", "p"),
             (903, "é1234567890123 x\n" * 300, None), (903, "é1234567890123 x\n" * 300, None), (None, "key 123456789012", "p")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, value string")
    got = sorted(((r.doc_id, r.start, r.end, r.value) for r in secrets.candidates(docs).collect()), key=repr)
    want = sorted(((d, *m.span(), m.group()) for d, t, _ in rows for m in re.finditer(secrets.CANDIDATE, t or "")
                   if re.search("[0-9]", m.group())), key=repr)
    assert got == want
    near = secrets.candidates(docs).where("doc_id = 0").first()
    assert (near.before, near.after, near.assigned, near.quoted, near.path) == ("token", "and", True, True, "src/app")


def test_features(spark):
    docs = spark.createDataFrame([(k, "common word aB1+cD22common", "p") for k in range(6)], "doc_id long, text string, source string")
    row = secrets.measured(secrets.candidates(docs), secrets.dictionary(docs)).first()
    assert row.value == "aB1+cD22common" and row.chars == 14
    changes = sum(a != b for a, b in zip(*[[0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3
                                            for c in x] for x in (row.value, row.value[1:])]))
    assert row.changes == pytest.approx(changes / 14) and row.digits == pytest.approx(3 / 14)
    assert row.capitals == pytest.approx(2 / 14) and row.distinct == pytest.approx(len(set(row.value)) / 14)
    assert row.coverage == pytest.approx(6 / 10) and row.hexadecimal == 0.0


def test_labelled_findings_remove_false_positives(spark):
    rows, truth = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    learn = spark.createDataFrame([(d, int(s)) for d, (_, s) in truth.items() if d < 100], "_d long, label int")
    got = secrets.scan(docs, lambda found: found.join(learn, found["doc_id"] == learn["_d"]).drop("_d")).collect()
    held = [r for r in got if r.doc_id >= 100]
    assert len(held) == 60 and all(r.value == truth[r.doc_id][0] for r in held)
    assert sum(r.is_secret == truth[r.doc_id][1] for r in held) >= 59


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = secrets.scan(docs)
    held = got.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 0).collect()
    sure = [(r.is_secret, bool(re.search(secrets.FORMATS, r.value))) for r in held
            if re.search(secrets.FORMATS, r.value) or re.search(secrets.OTHER.replace("(?i)", ""), r.value)]
    assert len(sure) > 10 and sum(a == b for a, b in sure) / len(sure) > 0.95
    assert not re.search("Python|Pandas|Arrow", secrets.digest(docs)._jdf.queryExecution().toString())


def test_odd_rows(spark):
    none = spark.createDataFrame([(1, None, None), (2, "", "p")], "doc_id long, text string, source string")
    assert secrets.digest(none).count() == 0 == secrets.digest(none.limit(0)).count()
    one = spark.createDataFrame([(1, "number 123456789012345", None)] * 2, "doc_id long, text string, source string")
    assert [r.score for r in secrets.digest(one).collect()] == [0.0, 0.0]


def test_context_holds_neighbouring_runs(spark):
    texts = ['aws_secret_access_key = "abcd1234EFGH5678" internationalization', "database_password: s3cr3tValue99",
             "GITHUB_TOKEN=abcdef123456 /usr/local/lib/python3 x", "é 1234567890123 " * 30]
    docs = spark.createDataFrame([(k, t, "p") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {(r.doc_id, r.value): r for r in secrets.candidates(docs).collect()}
    first = got[0, "abcd1234EFGH5678"]
    assert (first.before, first.after, first.assigned, first.quoted) == ("aws_secret_access_key", "internationalization", True, True)
    assert got[1, "s3cr3tValue99"].before == "database_password" and got[1, "s3cr3tValue99"].assigned
    assert got[2, "abcdef123456"].before == "github_token" and got[2, "abcdef123456"].after == "usr"
    measured = secrets.measured(secrets.candidates(docs), secrets.dictionary(docs))
    assert {r.value for r in secrets.presumed(measured).where("label = 1").collect()} == {
        "abcd1234EFGH5678", "s3cr3tValue99", "abcdef123456"}


def test_assigned_values_of_any_form_are_candidates(spark):
    values = ["hunter2x", "correct-horse-battery", "P@ssw0rd!2024#x", "abc", "ünïcode", "x"]
    texts = [f"é config pwd: {v}, next" if k % 2 else f'DB_PASSWORD = "{v}" and so on' for k, v in enumerate(values)]
    texts += ["the password is secret: no", "token of thanks = given", "apikey=k1 secret='two' pwd=3;" * 30, "passwords: ", "author: me"]
    docs = spark.createDataFrame([(k, t, "p") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {}
    for r in secrets.candidates(docs).collect():
        assert texts[r.doc_id][r.start:r.end] == r.value
        got.setdefault(r.doc_id, []).append(r)
    for k, v in enumerate(values):
        assert [r.value for r in got[k]] == [v] and got[k][0].assigned and got[k][0].before in ("pwd", "db_password")
    assert [r.value for r in got[6]] == ["no"] and 7 not in got and 9 not in got and 10 not in got
    assert len(got[8]) == 90 and {r.value for r in got[8]} == {"k1", "two", "3"}
    middle = sorted(got[8], key=lambda r: r.start)[45]
    assert (middle.before, middle.after) == ("apikey", "secret")


def test_short_and_digitless_secrets_are_found(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows = []
    for k in range(400):
        if k % 2:
            rows.append((k, f"setup password = {'-'.join(rng.sample(words, 3)) if k % 4 == 1 else words[k][:5] + '!x'} done", "app"))
        else:
            rows.append((k, f"order number {rng.randrange(10**14, 10**15)} was sent", "shop"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    learn = spark.createDataFrame([(k, k % 2) for k in range(200)], "_d long, label int")
    got = secrets.scan(docs, lambda found: found.join(learn, found["doc_id"] == learn["_d"]).drop("_d")).where("doc_id >= 200").collect()
    assert len(got) == 200 and sum(r.is_secret == bool(r.doc_id % 2) for r in got) >= 196


def test_odds_out_of_fold_equal_a_twin(spark):
    import math

    rng = random.Random(6)
    rows = [(f"v{rng.randrange(40)}", rng.choice("abc"), rng.choice(["x", "y", f"only{k}"]), "p", rng.randrange(2)) for k in range(150)]
    frame = spark.createDataFrame(rows, "value string, before string, after string, path string, label int")
    folds = {r.value: r.f for r in frame.select("value", F.pmod(F.xxhash64("value"), F.lit(secrets.ODDS_FOLDS)).alias("f")).distinct().collect()}
    got = secrets.out_of_fold(frame, -9.0).collect()
    assert len(got) == len(rows)
    for r in got:
        for c in secrets.SIDES:
            other = [x for x in rows if x[("value", "before", "after", "path").index(c)] == r[c] and folds[x[0]] != folds[r.value]]
            ones = sum(x[4] for x in other)
            assert r[f"{c}_odds"] == pytest.approx(math.log((ones + 0.5) / (len(other) - ones + 0.5)) if other else -9.0)
