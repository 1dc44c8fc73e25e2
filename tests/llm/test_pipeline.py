"""The five stages, each against a plain version of its decision on the rows that it was given."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from ledgerproof.llm import langid, mixing, packing, pii, simhash

from ..conftest import SF_SMALL
from .test_mixing import plain_targets
from .test_simhash import plain_components, plain_fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language", "near_duplicates", "personal_data", "mixture", "packing"]
    first = docs.collect()

    told = stage["language"](spark, docs, SF_SMALL).cache()
    verdict = {r.doc_id: r for r in langid.digest(docs).collect()}
    one = told.collect()
    least = langid.least_score(len({r.lang_pred for r in verdict.values()} - {"und"}))
    assert {r.doc_id for r in one} == {d for d, r in verdict.items() if r.lang_pred != "und" and r.score > least}
    assert len(one) > 0.9 * len(first) and told.columns == docs.columns

    single = stage["near_duplicates"](spark, told, SF_SMALL).cache()
    two = single.collect()
    one.sort(key=lambda r: r.doc_id)
    group = plain_components([plain_fingerprint(r.text) for r in one], simhash.RADIUS)
    assert sorted(r.doc_id for r in two) == sorted({one[k].doc_id for k in group})
    assert {tuple(r) for r in two} <= {tuple(r) for r in one}

    safe = stage["personal_data"](spark, single, SF_SMALL).cache()
    three = {r.doc_id: r for r in safe.collect()}
    spans = {r.doc_id: r.spans for r in pii.digest(single).collect()}
    for r in two:
        marks = [x.split(":") for x in spans[r.doc_id].split(",") if x]
        assert three[r.doc_id].text == pii.redact(r.text, [(k, int(a), int(b)) for k, a, b in marks])
        assert not marks or not [s for s in pii.base_spans(three[r.doc_id].text) if s[0] == "email"]

    mixed = stage["mixture"](spark, safe, SF_SMALL).cache()
    taken, size = Counter(), Counter()
    for r in three.values():
        size[r.source] += len(WORD.findall(r.text))
    for r in mixed.collect():
        taken[r.source] += len(WORD.findall(r.text))
    want = plain_targets(dict(size), mixing.WEIGHTS, mixing.SHARE, mixing.EPOCHS)
    assert all(abs(taken[s] - t) <= 1 for s, t in want.items()) and mixed.columns == docs.columns

    packed = stage["packing"](spark, mixed, SF_SMALL).collect()
    fill = Counter()
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= packing.CAPACITY
    assert sum(r.piece == 0 for r in packed) == mixed.count()
    assert len(fill) <= 1.02 * sum(fill.values()) / packing.CAPACITY + 1


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 100


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns


def test_stages_with_odd_rows_and_every_inner_name(spark):
    """NULLs, repeats, a very long text and columns named as the stages' own ones come through all stages."""
    import pytest

    from ledgerproof.llm import quality

    inner = ["_lang_pred", "_LANG_SCORE", "_simhash_bits", "_simhash_row", "_simhash_flag", "_pii_key", "_pii_terms", "_pii_flag", "_key", "_copy",
             "_cut", "key", "held", "copies", "fingerprint", "lang_pred", "score", "kept", "bits", "_bit", "_place", "_bucket", "_bits"]
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60").collect()
    long = " ".join(r.text or "" for r in base if r.lang == "en")[:150_000] * 8
    rows = [(*r[:5], *[f"{n}{r.doc_id}" for n in inner]) for r in base]
    rows += [rows[3]] * 5 + [(None, rows[4][1], None, None, None, *[None] * len(inner)), (901, None, "en", "src0", None, *[None] * len(inner)),
             (902, "", None, None, 0, *[None] * len(inner)), (903, long, "en", None, len(long), *[n + "903" for n in inner])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in inner)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() > 0, name
        for r in out.collect():
            assert r[5:] in [(None,) * len(inner), tuple(f"{n}{r.doc_id}" for n in inner)], name
        assert stage(spark, docs.limit(0), "").count() == 0, name
        docs = spark.createDataFrame(out.collect(), schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()
    with pytest.raises(ValueError, match="exists already: score"):
        langid.predict(docs.drop("lang_pred"), (["en"], None))
    with pytest.raises(ValueError, match="kept"):
        quality.cascade(docs)
    with pytest.raises(ValueError, match="fingerprint"):
        simhash.fingerprints(docs)
