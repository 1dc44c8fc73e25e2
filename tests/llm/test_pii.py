"""Base spans against plain regular expressions, disclosure against plain counting, odd rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerproof.llm import pii


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


@given(st.text(alphabet=st.sampled_from("ab@.-+ 01255é_%()\n"), max_size=80))
@settings(max_examples=800, deadline=None)
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_known_values():
    text = "x@y.zz 4111 1111 1111 1111, 4111111111111112 256.1.1.1 10.0.0.255 +1 (988) 555-2485 é a.b@c-d.e.f@g.hh"
    assert pii.base_spans(text) == plain_spans(text)
    assert [k for k, _, _ in pii.base_spans(text)] == ["email", "email", "ip", "card", "phone"]
    assert pii.base_spans("9" * 300_000 + "." + "a" * 300_000 + "@") == []


def plain_disclosing(texts):
    n_te, n_t, n_e = defaultdict(set), defaultdict(int), defaultdict(int)
    for text in texts:
        for t in set(re.findall(r"[^\W\d_]{3,}", (text or "").lower())):
            n_t[pii._hash(t)] += 1
        near = pii.windows(text or "", pii.base_spans(text or ""))
        for w in near:
            n_te[w["entity"], w["term"]].add(w["window"])
        for e in {w["entity"] for w in near}:
            n_e[e] += 1
    return {(e, t) for (e, t), ws in n_te.items() if len(ws) >= 3 and len(ws) / max(n_t[t], len(ws)) >= 0.5
            and math.log2(len(ws) / max(n_t[t], len(ws)) / (n_e[e] / len(texts))) >= 3}


def corpus():
    texts = [f"the report {w} of Zorblatt {k} reached ann@x.example.com before {v} noon" for k, (w, v) in enumerate(
        [("alpha", "late"), ("beta", "early"), ("gamma", "high"), ("delta", "after")])]
    return texts + [f"the report number {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}tail says nothing" for k in range(60)] + [
        None, "", "Zorblatt alone", "mail bob@y.example.com 10.1.2.3 now"]


def test_disclosing_terms_equal_plain_counting(spark):
    texts = corpus()
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, key string")
    rows = pii.found(docs)
    got = {(r.entity, r.term) for r in pii.disclosing(rows, docs).collect()}
    assert got == plain_disclosing(texts) and pii._hash("zorblatt") in {t for _, t in got}
    out = {r.doc_id: r for r in pii.digest(docs).collect()}
    assert len(out) == len(texts)
    for k, t in enumerate(texts):
        base = ",".join(f"{a}:{b}:{c}" for a, b, c in plain_spans(t or ""))
        assert out[k].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert out[k].spans.startswith(base)
    a = texts[0].index("Zorblatt")
    assert f"term:{a}:{a + 8}" in out[0].spans and "term" not in out[len(texts) - 2].spans


def test_sanitised_rows(spark):
    docs = spark.createDataFrame([(k, t, len(t or ""), "k") for k, t in enumerate(corpus())] + [(None, "a@b.cc", 6, None)] * 2,
                                 "doc_id long, text string, n_chars long, key string")
    out = pii.sanitised(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == docs.count()
    assert "[EMAIL]" in rows[0].text and "[TERM]" in rows[0].text and "Zorblatt" not in rows[0].text
    assert rows[0].n_chars == len(rows[0].text) and rows[None].text == "[EMAIL]"
    assert rows[64].text is None and rows[66].text == "Zorblatt alone" and rows[10].text == corpus()[10]
    assert pii.digest(docs.limit(0)).count() == 0 == pii.sanitised(docs.limit(0)).count()


def test_copies_do_not_weigh_against_a_pair(spark):
    texts = corpus()
    copied = texts[:3] + [texts[0]] * 100 + texts[4:]
    docs = spark.createDataFrame(list(enumerate(copied)), "doc_id long, text string")
    pairs = {r.term for r in pii.disclosing(pii.found(docs), docs).collect()}
    assert pii._hash("zorblatt") in pairs and pii._hash("reached") in pairs
    assert {r.term: r.documents for r in pii.term_counts(docs).collect()}[pii._hash("zorblatt")] == 4


def test_disclosing_terms_go_everywhere(spark):
    far = "Zorblatt " + "and so on " * 60 + "ann@x.example.com"
    texts = corpus() + [far, "ZORBLATT@y.zz is no place, Zorblatt is"]
    texts += [f"filler {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}word" for k in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.sanitised(docs, everywhere=True).collect()}
    assert not [t for t in out.values() if "Zorblatt" in (t or "")]
    assert out[66] == "[TERM] alone" and out[68].startswith("[TERM] and so on") and out[69] == "[EMAIL] is no place, [TERM] is"
    spans = {r.doc_id: r.spans for r in pii.digest(docs, everywhere=True).collect()}
    assert spans[66] == "term:0:8" and spans[69].count("term") == 1 and len(spans) == len(texts)


def test_query_and_pipeline_mark_everywhere(spark, tmp_path):
    import corpus_pipeline
    from ledgerproof.llm.registry import QUERIES

    docs = spark.createDataFrame([(k, t, len(t or "")) for k, t in enumerate(corpus())], "doc_id long, text string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.spans for r in QUERIES["op5_pii_disclosure"](spark, str(tmp_path)).collect()}[66] == "term:0:8"
    assert {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, "").collect()}[66] == "[TERM] alone"


def test_words_beside_an_identifier_have_no_reach():
    long = "é" * 5000
    text = f"{long} one two three four five six seven 10.0.0.1 a b7 {long} cd"
    near = pii.windows(text, pii.base_spans(text))
    assert [text[w["start"]:w["end"]] for w in near] == [long, "one", "two", "three", "four", "five", "six", "seven", "b7", long, "cd"]


def rare_corpus():
    """An address in two texts beside a handle, one in one text beside its owner's name, one that shares a common word."""
    filler = [f"plain {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k // 100]}q text goes by here" for k in range(600)]
    return filler + ["early note by staff77x to quill@rare.example.com about it", "late memo from staff77x and quill@rare.example.com again",
                     "Ms Vandermeer wrote: vandermeer.12@one.example.com thanks", "see plain.5@two.example.com for plain facts"]


def test_rare_entities_are_served(spark):
    texts = rare_corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.found(docs)
    significant = {r.term for r in pii.significant(rows, docs).collect()}
    assert significant == {pii._hash("staff77x")} and not pii.disclosing(rows, docs).count()
    assert {r.term for r in pii.named(rows, docs).collect()} == {pii._hash("vandermeer")}  # "plain" is everybody's
    out = {r.doc_id: r for r in pii.digest(docs, everywhere=True).collect()}
    marked = {k for k, r in out.items() if "term:" in r.spans}
    assert marked == {600, 601, 602}
    assert out[602].spans.endswith("term:3:13") and out[600].spans.count("term") == 1
    texts += ["VANDERMEER and staff77x were seen"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.sanitised(docs, everywhere=True).collect()}[604] == "[TERM] and [TERM] were seen"


def plain_named(texts):
    """(entity, term) pairs by counting over distinct texts, identifiers blanked out."""
    texts = {t for t in texts if t}
    held, own, having = defaultdict(int), defaultdict(int), defaultdict(int)
    for text in texts:
        spans, bare = pii.base_spans(text), text
        for _, a, b in spans:
            bare = bare[:a] + " " * (b - a) + bare[b:]
        words = {w.lower() for w in re.findall(r"[^\W_]{2,}", bare)}
        for w in {w.lower() for w in re.findall(r"[^\W_]{2,}", text)}:
            held[w] += 1
        for mail in {text[a:b].lower() for k, a, b in spans if k == "email"}:
            having[mail] += 1
            for part in set(re.findall(r"[^\W\d_]{3,}", mail.split("@")[0])) & words:
                own[mail, part] += 1
    return {(pii._hash(f"email:{e}"), pii._hash(t)) for (e, t), n in own.items()
            if (n + 1) / (max(held[t], n) + 2) >= 0.5 and math.log2((n + 1) / (max(held[t], n) + 2) / (having[e] / (len(texts) + 1))) >= 3}


def test_names_on_the_given_table_equal_plain_counting(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = pii.found(docs)
    got = {(r.entity, r.term) for r in pii.named(rows, docs).collect()}
    assert got == plain_named([r.text for r in docs.select("text").collect()])
    print(len(got))
