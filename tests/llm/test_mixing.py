"""Targets and budgets against plain Python, repeats, odd rows."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from ledgerproof.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Share by weight, stop at the cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        each = left / sum(w[s] for s in free)
        full = [s for s in free if each * w[s] >= epochs * sizes[s]]
        if not full:
            return out | {s: each * w[s] for s in free}
        for s in full:
            out[s] = epochs * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def rows_of(counts):
    out, k = [], 0
    for source, words in counts.items():
        for n in words:
            out.append((k, " ".join(f"w{k}x{i}" for i in range(n)), source, "extra"))
            k += 1
    return out


def test_budgets(spark):
    rows = rows_of({"a": [30] * 40, "b": [7, 9, 200], None: [5] * 11, "c": [], "d": [50] * 30, "é": [3] * 500})
    rows += [(9001, None, "a", "x"), (9002, "", "e", None), (None, "one two", "b", "x"), (9003, "dup dup", "d", "x"),
             (9003, "dup dup", "d", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s, _ in rows:
        size[s] += len((t or "").split())
    want = plain_targets(dict(size))
    of = {(d, s) for d, _, s, _ in rows}
    taken = Counter()
    for r in got:
        s = next(x for d, x in of if d == r.doc_id)
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1.5  # rounding, and equal rows at a cut share evenly
    again = mixing.mix_sizes(docs.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_many_sources(spark):
    rows = [(k, "w " * (k * 7919 % 61), f"host{k * 31 % 3000:05d}" if k % 11 else None) for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(9)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    want = plain_targets(dict(size))
    got = mixing.mix_sizes(docs).collect()
    of, taken = {d: s for d, _, s in rows}, Counter()
    for r in got:
        s = of[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        taken[s] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - t) <= 0.5 + 1e-6 for s, t in want.items())


def test_mixed_rows_hold_the_taken_words(spark):
    rows = rows_of({"a": [30] * 40, "b": [7, 9, 200], None: [5] * 11})
    docs = spark.createDataFrame([(*r[:3], len(r[1])) for r in rows], "doc_id long, text string, source string, n_chars long")
    want = {r.doc_id: r.taken for r in mixing.mix_sizes(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got, texts = Counter(), {d: t for d, t, _, _ in rows}
    for r in mixed.collect():
        got[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert {d: n for d, n in want.items() if n} == dict(got)


def test_empty_and_wordless(spark):
    docs = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix_sizes(docs).collect()] == [(0.0, 0)] * 2
    assert mixing.mix_sizes(docs.limit(0)).count() == 0 == mixing.mix(docs.limit(0)).count()


def test_repeated_rows_meet_the_budget(spark):
    for words, n in (("one", 1000), ("a b c", 333)):
        docs = spark.createDataFrame([(1, words, "s", k) for k in range(n)], "doc_id long, text string, source string, n_chars long")
        size = len(words.split())
        taken = [r.taken for r in mixing.mix_sizes(docs).collect()]
        assert abs(sum(taken) - 1.5 * n * size) <= 0.5 and len(taken) == n and max(taken) <= 2 * size
        mixed = mixing.mix(docs).collect()
        assert sum(len(r.text.split()) for r in mixed) == sum(taken)


def test_names_inside_do_not_meet_the_callers(spark):
    inner = ["_key", "_copy", "_full", "_cut", "_source", "key", "cut", "full", "held", "copies", "part", "extra", "pos", "size", "row", "_at",
             "at_cut", "a.b"]
    rows = [(k, f"w{k} x y", ["s", None][k % 2], 5, *[f"{n}{k}" for n in inner]) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in inner))
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert got and all(r[4:] == tuple(f"{n}{r.doc_id}" for n in inner) for r in got)
    assert mixing.mix_sizes(docs).count() == 40
