"""The automaton against plain window search, several blocks and pieces, odd texts, removal."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from ledgerproof.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window):
    """(words, hit places, item ids) by comparing every window at every place."""
    ws, hit, found = words(text), set(), set()
    for item, it in items:
        iw = words(it)
        m = min(len(iw), window)
        for at in range(len(iw) - m + 1) if m else ():
            g = iw[at:at + m]
            for i in range(len(ws) - m + 1):
                if ws[i:i + m] == g:
                    hit.update(range(i, i + m))
                    found.add("null" if item is None else str(item))
    return len(ws), hit, found


def some(rng, n, letters="abc"):
    return " ".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("seed", range(40))
def test_automaton_equals_plain_search(seed):
    rng = random.Random(seed)
    window = rng.choice([2, 3, 5])
    items = [(k, some(rng, rng.choice([0, 1, 2, 3, 4, 8, 20]), "ab" if seed % 2 else "abcd")) for k in range(rng.randrange(1, 8))]
    built = D.Automaton([(k, [w.encode() for w in words(t)]) for k, t in items], window)
    for _ in range(20):
        text = some(rng, rng.randrange(40), "abcx" if seed % 3 else "ab")
        n, hit, found = plain(text, items, window)
        got = built.scan(text.encode())
        assert got[0] == n and {p for a, b in got[1] for p in range(a, b)} == hit
        assert {str(k) for k in got[2]} == found
        assert all(x[1] < y[0] for x, y in zip(got[1], got[1][1:]))


def test_chunks_do_not_change_the_words(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abAB é𝔘.-19 \n") for _ in range(3000)) + "x" * 100 + " a b a b"
    whole = [w for part in D.words_of(text.encode()) for w in part]
    items = [(0, [b"a", b"b", b"a"]), (1, [b"b"])]
    want = D.Automaton(items, 3).scan(text.encode())
    monkeypatch.setattr(D, "_CHUNK", 7)
    assert [w for part in D.words_of(text.encode()) for w in part] == whole == [w.encode() for w in words(text)]
    assert D.Automaton(items, 3).scan(text.encode()) == want


DOCS = "doc_id long, text string, key string, spans string, n_chars long"
ITEMS = "item_id long, text string, item string"


@pytest.mark.parametrize("pieces", [D.PIECES, 2])
def test_digest(spark, monkeypatch, pieces):
    monkeypatch.setattr(D, "PIECES", pieces)
    rng = random.Random(5)
    long = " ".join(f"L{k % 83}{k % 7}" for k in range(300))
    items = [(1, some(rng, 12, ["aa", "bb", "Cc", "é"])), (2, "only three words"), (3, None), (4, "..."), (10, long), (2, "only three words"),
             (None, "no id here at all"), (11, "three words"), (12, some(rng, 12, ["aa", "bb", "Cc", "é"]))]
    texts = [items[0][1].upper(), "x " + items[0][1] + " y. ONLY\nthree,words!", None, "", "!!", " ".join(long.split()[100:111]),
             "z " * 400_000 + long + " z" * 9, "only three", "only three words " * 3, "no id here at all",
             *[some(rng, 60, ["aa", "bb", "Cc", "é"]) for _ in range(40)]]
    rows = [(k, t, "a", "b", 1) for k, t in enumerate(texts)] + [(1, texts[1], "c", "d", 2), (None, texts[0], "", "", None)]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame([(*i, "q") for i in items], ITEMS)
    want = []
    for r in rows:
        n, hit, found = plain(r[1], items, 10) if len(r[1] or "") < 10**5 else (400_309, range(300), {"10"})
        want.append((r[0], n, len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert sorted(map(tuple, D.digest(docs, bench).collect()), key=repr) == sorted(want, key=repr)
    assert D.digest(docs.limit(0), bench).count() == 0
    assert not any(r.n_hit or r.n_items for r in D.digest(docs, bench.limit(0)).collect())


def test_removal(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    rows = [(1, "Before it. " * 10 + "One, two three four five six seven eight nine TEN eleven! After é.", "k", None, 5),
            (2, "one two three four five six seven eight nine ten", "k", "s", 9), (3, None, "k", "s", None), (3, "clean", "k", "s", 5)]
    docs = spark.createDataFrame(rows, DOCS.replace("key", "_leak_key").replace("spans", "_LEAK_SPANS"))
    out = D.decontaminated(docs, bench)
    assert out.columns == docs.columns
    got = sorted(map(tuple, out.collect()), key=repr)
    kept = "Before it. " * 10 + "! After é."
    assert got == sorted([(1, kept, "k", None, len(kept)), *rows[2:]], key=repr)
    assert len(D.decontaminated(docs, bench, coverage=1.0, min_words=11).collect()) == 4
