"""The manifest against a plain tree, over several rounds of blocks, odd rows and proofs."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from ledgerproof.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, _at string, root string, n int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, at):
    out = []
    for level in tree[:-1]:
        run = at // 3 * 3
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + 3])))
        at //= 3
    return out


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[4])))
        trees[s] = levels([plain_leaf(r, r[4]) for r in by[s]])
    top = levels([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            way = path(trees[s], i) + path(top, k)
            node = plain_leaf(r, r[4])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                node = plain_leaf(r, r[4].replace("\n", ""))
            for left, right in way:
                node = h(left, node, right)
            out.append((r[0], plain_leaf(r, r[4]), trees[s][-1][0], root, h(*[a + b for a, b in way]), node, node == root))
    return sorted(out, key=repr)


def got(docs):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in names) for r in merkle.digest(docs).collect()), key=repr)


@pytest.mark.parametrize("depth", [1, 2])
def test_manifest_over_many_rounds(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 3**depth)
    rng = random.Random(7)
    rows = []
    for source, n in (("hot", 130), ("é", 27), ("z", 28), ("one", 1), ("two", 2), (None, 10), ("", 9), *[(f"s{k}", 1) for k in range(12)]):
        rows += [(rng.randrange(10**6), source, rng.choice(["en", None]), rng.randrange(99), "a\nb é 𝔘" * rng.randrange(3),
                  "x", "y", 1) for _ in range(n)]
    rows += [(None, "hot", None, None, None, "x", "y", 1), (5, "hot", "en", 3, "a\nb", "x", "y", 1),
             (5, "hot", "en", 3, "a\nb", "p", "q", 2), (5, "hot", "de", 3, "", "p", "q", 2), (8, None, None, None, "\n" * 9, "", "", 0)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    want = plain(rows)
    assert got(docs) == want
    assert {r[-1] for r in want} == {True, False}


def test_lone_leaf_and_empty_table(spark):
    one = spark.createDataFrame([(1, None, None, None, None, "", "", 0)], COLUMNS)
    assert got(one) == plain([(1, None, None, None, None)])
    row = got(one)[0]
    assert row[1] == row[2] == row[3] and row[-1] is True and row[4] == hashlib.sha256(b"").hexdigest()
    assert got(one.limit(0)) == []


def test_default_blocks_and_a_very_long_text(spark):
    rows = [(k, "src", "en", k, f"t{k}\n" * (k % 4), "", "", 0) for k in range(800)]
    rows.append((801, "src", "en", 1, "long é\n" * 600_000, "", "", 0))
    assert got(spark.createDataFrame(rows, COLUMNS)) == plain(rows)
