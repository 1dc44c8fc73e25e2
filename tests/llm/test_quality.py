"""Measures against plain counting, cascade against all rules at once, odd rows."""

from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerproof.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(runs)
    covered = {p for i, w in enumerate(runs) if n[w] > 1 for p in range(i, i + 8)}
    dup, seen = 0, set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


@given(st.lists(st.sampled_from(["a", "b", "é#", "\n", " ", "\t", "x y", "\x1c", "|", "a b a b a b a b"]), max_size=60))
@settings(max_examples=400, deadline=None)
def test_measures_equal_plain_counting(parts):
    text = " ".join(parts) if len(parts) % 2 else "".join(parts)
    m = quality.Measures(text.encode())
    assert tuple(getattr(m, n) for n in quality.BASE) == plain(text)


def test_cascade_keeps_what_no_rule_rejects(spark):
    clean = " ".join(f"word{k}" for k in range(40))
    rows = [(1, clean, "x"), (2, None, "x"), (3, "", None), (4, clean + " ### $$$ ***" * 9, "x"), (None, clean, "x"),
            (5, "say it again and again my friend please " * 12, "x"), (1, clean, "x"), (6, "same line\n" * 12 + clean, "x"),
            (7, clean * 3000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = quality.digest(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for d, t, _ in rows if d == r.doc_id) or ""
        assert tuple(r[n] for n in quality.BASE) == plain(text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        m = quality.Measures(text.encode())
        assert r.kept == (not any(rule.rejects(m) for rule in quality.RULES))
    assert {r.doc_id for r in got if r.kept} == {1, None}
    assert quality.digest(docs.limit(0)).count() == 0
    passed = quality.cascade(docs, kept="verdict")
    assert passed.columns == [*docs.columns, "verdict"]


def test_order_is_by_rejection_per_cost(spark):
    a, b, c = (quality.Rule(n, lambda m: False) for n in "abc")
    assert quality.ordered([a, b, c], {"a": (0.1, 1e-3), "b": (0.1, 1e-5), "c": (0.9, 1e-3)}) == [b, c, a]
    docs = spark.createDataFrame([(k, "few words") for k in range(50)], "doc_id long, text string")
    found = quality.estimates(docs, sample_rows=10**6)
    assert found["few_words"][0] == 1.0 and found["symbols"][0] == 0.0 and all(c >= 0 for _, c in found.values())
