"""Lattice sums against brute force, odd rows, held-out accuracy."""

from __future__ import annotations

import numpy as np
import pytest
import sentencepiece

from ledgerproof.llm import langid

from ..conftest import SF_SMALL

PATH = langid.vocabulary_path()


def segmentations(word):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        for rest in segmentations(word[n:]):
            yield [word[:n], *rest]


def numbers():
    m = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = sorted({p for p in map(m.id_to_piece, range(m.get_piece_size())) if p == "▁" or p.removeprefix("▁").isalpha()})
    return {p: i for i, p in enumerate(pieces)}


def test_likelihood_and_expectation_sum_all_segmentations():
    v, number = langid.vocabulary(PATH), numbers()
    p = np.random.default_rng(1).random(v.size + 1) / v.size
    words = ["the", "ab", "être", "中", "sein", "e"]
    weights = np.array([[1.0, 2.0]] * len(words))
    lattice = v.lattice(words)
    got = lattice.likelihood(p.reshape(-1, 1))[:, 0]
    expected = np.zeros(v.size + 1)
    for word, mass in zip(words, got):
        ways = []
        for cut in segmentations("▁" + word):
            at = [number.get(x, v.size if len(x) == 1 else None) for x in cut]
            if None not in at:
                ways.append((np.prod(p[at]), at))
        total = sum(m for m, _ in ways)
        assert mass == pytest.approx(total, rel=1e-9)
        for m, at in ways:
            for k in at:
                expected[k] += m / total
    both = lattice.expected(p, weights)
    assert np.allclose(both[0], expected) and np.allclose(both[1], 2 * expected)


def slow_sums(word, p, number, size):
    """(log likelihood, expected uses) of one word by plain loops in logarithms."""
    marked = "▁" + word
    longest = max(map(len, number))
    edges = []
    for i in range(len(marked)):
        for n in range(1, min(longest, len(marked) - i) + 1):
            k = number.get(marked[i:i + n], size if n == 1 else None)
            if k is not None:
                edges.append((i, i + n, k))
    front, back = np.full(len(marked) + 1, -np.inf), np.full(len(marked) + 1, -np.inf)
    front[0] = back[-1] = 0.0
    for a, b, k in sorted(edges, key=lambda e: e[0]):
        front[b] = np.logaddexp(front[b], front[a] + np.log(p[k]))
    for a, b, k in sorted(edges, key=lambda e: -e[1]):
        back[a] = np.logaddexp(back[a], back[b] + np.log(p[k]))
    uses = np.zeros(len(p))
    for a, b, k in edges:
        uses[k] += np.exp(front[a] + np.log(p[k]) + back[b] - front[-1])
    return front[-1], uses


def test_runs_of_any_length_are_summed_whole():
    v, number = langid.vocabulary(PATH), numbers()
    p = np.random.default_rng(2).random((v.size + 1, 3)) / v.size * [1, 1e-3, 1e-12]
    words = ["theories" * 9, "漢字假名" * 30, "e" * 41, "straßenbahnhaltestelle" * 7, "ab", "x" * 47, "être" * 12, "q" * 39]
    want = [[slow_sums(w, p[:, c], number, v.size) for c in range(3)] for w in words]
    got = langid.log_likelihoods(v, words, p, 3)
    assert np.allclose(got, [[x[0] for x in row] for row in want], rtol=1e-9)
    assert np.allclose(langid.LongRuns(v, words).likelihood(p), got, rtol=1e-9)
    for c in (0, 2):
        uses = langid.LongRuns(v, words).expected(p[:, c])
        assert np.allclose(uses, sum(row[c][1] for row in want), rtol=1e-8, atol=1e-12)
    assert langid.log_likelihoods(v, [], p, 3).shape == (0, 3)


def test_text_without_spaces(spark):
    rows = [(k, t * 30, g) for k, (t, g) in enumerate([("thecatandthedog", "en"), ("derhundunddiekatze", "de")] * 12)]
    rows += [(100, "thedogandthecat" * 4000, None), (101, "diekatzeundderhund" * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.digest(docs).collect()}
    assert got[100].lang_pred == "en" and got[101].lang_pred == "de"
    assert all(got[k].lang_pred == g for k, _, g in rows if g) and all(r.score > 0.99 for r in got.values())


def test_words():
    assert langid.words_of("Ab-c1d ²½ Ⅷ x_y" + " " + "q" * 90) == ["ab", "c", "d", "x", "y", "q" * 90]
    assert langid.words_of(None) == [] == langid.words_of("12 !")


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", "a"), (2, "der hund und die katze", "de", None), (3, None, "en", "a"),
            (4, "12 34 !!", "de", "a"), (5, "", None, "a"), (None, "the dog", "en", "a"), (7, "und der hund", None, "a"),
            (1, "the cat and the dog", "en", "a"), (8, "hund die " * 20000, "de", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = langid.digest(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (3, 4, 5))
    kept = langid.identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    unlabelled = langid.digest(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang is null"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}
    assert langid.digest(docs.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = langid.digest(docs).alias("g").join(docs.select("doc_id", "lang").alias("d"), "doc_id").where(
        "held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(got) > 20
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95


def test_only_texts_that_fit_all_alike_are_rejected(spark):
    rows = [(k, t, g) for k, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"),
                                                  ("le chien et le chat", "fr")] * 9)] + [(100, "漢字假名", "en"), (101, "et", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in langid.identified(docs).collect()}
    assert set(range(27)) | {101} <= kept
    assert [langid.least_score(n) for n in (0, 1, 2, 4)] == [0.5, 0.5, 0.5, 0.3]
