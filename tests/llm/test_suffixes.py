"""Marked strings against counting every string, in process and through Spark; hot grams; odd rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerproof.llm import suffixes

from ..conftest import SF_SMALL


def plain_marks(texts, length):
    n = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    return [[n[t[i:i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]


def plain_rows(texts, length=suffixes.LENGTH):
    out = []
    for t, marks in zip(texts, plain_marks(texts, length)):
        gone = np.zeros(len(t) + 1, bool)
        for i, m in enumerate(marks):
            if m:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((gone[:-1] & ~np.concatenate(([False], gone[:-2])) if len(t) else gone[:-1]).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def marks_of(texts, length, gram):
    doc, anchor, near, far, g, name = suffixes.parse(texts, length, gram)
    classes, groups, verdict = {}, {}, {}
    for k in range(len(doc)):
        classes.setdefault((g[k], name[k]), []).append(k)
    for (h, _), members in classes.items():
        groups.setdefault(h, []).append(members[0])
    rows = sorted((k for m in groups.values() if len(m) > 1 for k in m),
                  key=lambda k: (g[k], texts[doc[k]][anchor[k]:anchor[k] + length]))
    if rows:
        found = suffixes.induced(g[rows], [texts[doc[k]][anchor[k]:anchor[k] + length] for k in rows],
                                 [texts[doc[k]][anchor[k] - far[k]:anchor[k]] for k in rows], near[rows], far[rows], length)
        verdict = {(g[k], name[k]): r for k, r in zip(rows, found)}
    got = [[False] * max(0, len(t) - length + 1) for t in texts]
    for key, members in classes.items():
        for k in members:
            for a, b in [(near[k], far[k])] if len(members) > 1 else verdict.get(key, []):
                for l in range(a, b + 1):
                    got[doc[k]][anchor[k] - l] = True
    return got


def edited(rng, base, letters):
    t = bytearray(base[rng.randint(0, 10):])
    for _ in range(rng.randint(0, 6)):
        p = rng.randrange(len(t)) if t else 0
        kind = rng.random()
        if kind < 0.4 and t:
            t[p] = rng.choice(letters)
        elif kind < 0.7:
            t[p:p] = bytes(rng.choice(letters) for _ in range(rng.randint(1, 30)))
        else:
            del t[p:p + rng.randint(1, 9)]
    return bytes(t)


@pytest.mark.parametrize("seed", range(60))
def test_marks_equal_counting(seed):
    rng = random.Random(seed)
    length, gram = rng.choice([8, 12, 20]), rng.choice([2, 3, 5])
    letters = rng.choice([b"a", b"ab", b"abc", bytes(range(97, 110)), b"\x00a"])
    base = bytes(rng.choice(letters) for _ in range(rng.randint(20, 120)))
    texts = [edited(rng, base, letters) for _ in range(rng.randint(1, 8))]
    assert marks_of(texts, length, gram) == plain_marks(texts, length)


def test_long_texts_are_parsed_alike_in_chunks():
    rng = random.Random(2)
    part = bytes(rng.choice(b"abcd") for _ in range(900))
    for text in (part * 3 + b"x" + part, b"a" * 2500, part[:400]):
        for chunk in (53, 400, 1000):
            whole, cut = suffixes.parse([text], 60, 12), suffixes.parse_long(text, 60, 12, chunk)
            assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


def corpus():
    rng = random.Random(6)

    def prose(n):
        return "".join(rng.choice("abcdefg é ") for _ in range(n))

    passage, base = prose(700), prose(3000)
    texts = [prose(1500) for _ in range(12)] + [prose(rng.randint(0, 300)) + passage + prose(rng.randint(0, 300)) for _ in range(9)]
    texts += [base, base, base[:1400] + "!" + base[1400:], base[200:2000], passage + passage, "z" * 2000, "xyz" * 400, base[:150]]
    return [*texts, None, "", "short", prose(6000) + base]


@pytest.mark.parametrize("hot,chunk", [(4096, 1 << 21), (2, 1 << 21), (4096, 1000)])
def test_documents(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(suffixes, "HOT", hot)
    texts = corpus()
    rows = [(k if k != 3 else None, t, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gram string")
    if chunk < 5000:  # chunks are cut inside the workers, which import the module afresh
        parsed = [suffixes.parse_long((t or "").encode(), chunk=chunk) for t in texts if len((t or "").encode()) >= 400]
        whole = [suffixes.parse([(t or "").encode()]) for t in texts if len((t or "").encode()) >= 400]
        assert all(np.array_equal(a, b) for p, w in zip(parsed, whole) for a, b in zip(p, w))
        return
    want = plain_rows([(t or "").encode() for t in texts])
    got = {r.doc_id: r for r in suffixes.deduplicated(docs).collect()}
    assert len(got) == len(rows)
    for (d, t, _), w in zip(rows, want):
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_repeated_rows_and_empty_table(spark):
    text = "".join(chr(97 + (i * i) % 26) for i in range(500))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "abc"), (None, "abc")], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.digest(docs).collect())
    assert got == [(3, 0, 0), (3, 0, 0), (500, 500, 1), (500, 500, 1)]
    assert suffixes.digest(docs.limit(0)).count() == 0


def test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    want = dict(zip([r.doc_id for r in rows], plain_rows([(r.text or "").encode() for r in rows])))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digest(docs).collect()}
    assert got == want
