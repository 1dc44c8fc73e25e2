"""Features, held-out quality, odd rows and labels."""

from __future__ import annotations

import math
import random

import pytest

from ledgerproof.llm import toxicity

from ..conftest import SF_SMALL

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def of(text, **lexicon):
    return dict(zip(toxicity.NAMES, toxicity.Features(lexicon)(text)))


def test_features():
    f = of("You are a complete 1d1ot, RUBBISH!! grumpf grumpfen idiot", grumpf=3.0, **{"grum-": 2.5})
    assert f["list_density"] == pytest.approx(1 / 9) and f["word_density"] == pytest.approx(1 / 9)
    assert f["stem_density"] == pytest.approx(2 / 9) and f["word_weight"] == pytest.approx(3 / 9) and f["best_weight"] == 3.0
    assert f["read_as_lexicon"] == pytest.approx(1 / 9) and f["obfuscated"] == pytest.approx(1 / 9)
    assert f["second_person"] == pytest.approx(1 / 9) and f["exclamations"] == pytest.approx(2 / 9)
    assert f["near_second_person"] == pytest.approx(1 / 9)  # of four lexicon words only 1d1ot is within five words of "You"
    assert set(of("").values()) == {0.0} == set(of(None).values())
    assert of("HELLO THERE")["capital_words"] == 1.0


def test_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.digest(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    ranked = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert ranked > 0.85 and all(0 <= s <= 1 for s, _ in held)
    assert all(r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_do_not_matter(spark):
    docs, labels = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "quality", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0 "
                                "then 1 - toxic else toxic end as toxic")
    a, b = ({r.doc_id: r.score for r in toxicity.digest(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark):
    rows = [(1, "a text", "x"), (2, None, "x"), (None, "", None), (1, "a text", "x"), (3, "word " * 50000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.digest(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1), (1, None), (None, 0), (2, 1), (3, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.digest(docs, one).collect()} == {1.0}
    assert toxicity.digest(docs, one).count() == len(rows) and toxicity.digest(docs.limit(0), one).count() == 0


def area(got, labels):
    held = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_without_the_fixed_list(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    assert area({r.doc_id: r for r in toxicity.digest(docs, labels, listed=frozenset()).collect()}, labels) > 0.85


def twin(text, lexicon, listed):
    """All features by hand, token by token."""
    tokens = (text or "").split()
    if not tokens:
        return [0.0] * 19
    n, words = len(tokens), [t.lower().strip(toxicity._ENDS) for t in tokens]
    weight = [lexicon.get(w, 0.0) for w in words]
    stem = [max([lexicon.get(w[:k] + "-", 0.0) for k in (4, 5, 6) if len(w) > k], default=0.0) for w in words]
    hidden, read = [], []
    for w in words:
        letters = [c.isalpha() for c in w]
        inner = any(letters[i] and not letters[i + 1] and any(letters[j] and all(not x or c == "_" for x, c in zip(letters[i + 1:j], w[i + 1:j]))
                    for j in range(i + 2, len(w))) for i in range(len(w) - 2))
        swap = "".join({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}.get(c, c) for c in w)
        told = "".join(c for c in swap if c.isalpha())
        disguised = inner or (any(c in "013457@$!|" for c in w) and any(letters))
        hidden.append(inner)
        read.append(disguised and told != w and told != "" and (told in listed or told in lexicon))
    insult, person = [w in listed for w in words], [w in toxicity.SECOND_PERSON for w in words]
    marked = [i for i in range(n) if insult[i] or weight[i] or stem[i] or read[i]]
    near = sum(any(person[j] for j in range(max(0, i - 5), min(n, i + 6))) for i in marked)
    upper, lower = (sum(a <= c <= z for c in text) for a, z in (("A", "Z"), ("a", "z")))
    runs = before = 0
    for c in text + " ":
        if c not in "!?.":
            runs, before = runs + (before > 1), 0
        else:
            before += 1
    shouted = sum(t.isupper() for t in tokens) if upper > lower / 8 else 0
    found, stems = sum(x > 0 for x in weight), sum(x > 0 for x in stem)
    return [math.log1p(n), sum(insult) / n, math.log1p(sum(insult)), found / n, math.log1p(found), sum(weight) / n, stems / n, math.log1p(stems),
            sum(stem) / n, max(weight + stem), near / n, sum(person) / n, upper / max(1, upper + lower), shouted / n, text.count("!") / n,
            text.count("?") / n, runs / n, sum(hidden) / n, sum(read) / n]


def test_features_equal_a_twin():
    rng = random.Random(4)
    pool = ["you", "You!", "idiot", "1d1ot", "i.d.i.o.t", "grumpf", "grumpfen", "GRUMPF!!", "fine", "a", "é", "s1lly", "U", "...", "?!", "w0rd", "tú", "TEST",
            "x_y", "b@d", "--", "dich,", "12", "g-r-u-m-p-f", "Straße"]
    lexicon = {"grumpf": 3.0, "grum-": 2.5, "silly": 1.5, "bad": 2.0, "straße": 0.5}
    for _ in range(300):
        text = "".join(rng.choice(pool) + rng.choice([" ", " ", "\n", "  "]) for _ in range(rng.randrange(30)))
        assert toxicity.Features(lexicon)(text) == pytest.approx(twin(text, lexicon, toxicity.INSULTS)), text
