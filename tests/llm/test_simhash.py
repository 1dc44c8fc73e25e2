"""Fingerprints, bit-sliced links and components against brute force."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerproof.llm import simhash


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(bits, radius):
    bits = list(bits)
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bits))]


@given(st.text(alphabet=st.sampled_from("aAbBé \t\n\x0b\x1c  Z"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_equals_plain_rule(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def near(rng, n, radius):
    seeds = rng.integers(0, 1 << 63, n // 4, dtype=np.uint64)
    out = []
    for k in range(n):
        x = int(seeds[rng.integers(len(seeds))])
        for b in rng.integers(0, 64, rng.integers(0, radius + 3)):
            x ^= 1 << int(b)
        out.append(x)
    return np.array(out, np.uint64)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_forest_equals_all_pairs(radius):
    rng = np.random.default_rng(radius)
    bits = near(rng, 300, radius)
    groups = rng.integers(0, 4, 300)
    a, b = simhash.forest(groups, bits, radius)
    for g in range(4):
        at = np.flatnonzero(groups == g)
        plain = plain_components([int(x) for x in bits[at]], radius)
        label = {i: i for i in at}
        for x, y in zip(a, b):
            if groups[x] == g:
                label[x] = y
        got = {}
        for i in at:
            j = i
            while label[j] != j:
                j = label[j]
            got.setdefault(j, set()).add(i)
        want = {}
        for i, r in zip(at, plain):
            want.setdefault(r, set()).add(i)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("parts,tile", [(None, 4096), (5, 8), (7, 3), (8, 4096)])
def test_components_equal_all_pairs_for_any_filing(spark, parts, tile):
    rng = np.random.default_rng(5)
    bits = np.unique(near(rng, 240, 4))
    rows = spark.createDataFrame([(int(x.view(np.int64)), i) for i, x in enumerate(bits)], "bits long, doc_id long")
    found = simhash.links(rows.select("bits"), parts=parts, tile=tile)
    assert found.count() <= 70 * len(bits)
    real, simhash.TILE = simhash.TILE, tile
    try:
        got = {r.bits: r.component_id for r in simhash.components(rows, bits="bits", parts=parts).collect()}
    finally:
        simhash.TILE = real
    plain = plain_components([int(x) for x in bits], 4)
    assert [got[int(x.view(np.int64))] for x in bits] == plain


def test_digest_of_odd_rows(spark):
    text = "one two three four five six seven eight"
    rows = [(5, text, "x"), (3, text.upper(), None), (7, None, "x"), (8, "", "x"), (9, " \t\n", "x"), (None, "lone words", "x"),
            (5, text, "x"), (11, "short", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.digest(docs).collect()), key=repr)
    assert len(got) == len(rows)
    want = {d: f"{plain_fingerprint(t):016x}" for d, t, _ in rows}
    assert all(want[d] == f for d, f, _ in got)
    of = {d: c for d, _, c in got}
    assert of[5] == of[3] == 3 and of[7] == of[8] == of[9] == 7 and of[11] == 11 and of[None] is None
    kept = simhash.one_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [11, 3, 7, None]
    assert simhash.digest(docs.limit(0)).count() == 0
