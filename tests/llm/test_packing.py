"""Token ids against the library's encoder, cutting, gapless placement, few sequences."""

from __future__ import annotations

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from ledgerproof.llm import packing
from ledgerproof.llm.word_tokenizer import WordTokenizer


def test_ids_equal_the_whole_text_encoder():
    path = packing.vocabulary_path()
    ours, theirs = WordTokenizer.get(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    bits = ["a", "B", "É", "é", "İ", "Σ", "ς", "'s", "'LL", " ", "\n", "\x1c", "\xa0", "0", "٣", "中", "ﬁ", "😀", "$%", "_",
            "<|endoftext|>", "\x00", "ǆ", "́", "word ", "Theory"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 15)))
        assert np.frombuffer(ours.encode(text), "<u2").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_rule_never_overfills_and_opens_only_when_nothing_fits():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 101, 400)
    bins, offsets = packing.sum_of_squares(lengths, 100)
    fill, opened = {}, {}
    for i in np.argsort(-lengths, kind="stable"):
        b = bins[i]
        assert offsets[i] == fill.get(b, 0)
        if b not in fill:
            assert all(f + lengths[i] > 100 for f in fill.values())
        fill[b] = fill.get(b, 0) + lengths[i]
        opened[b] = True
    assert max(fill.values()) <= 100 and len(fill) <= 1.05 * lengths.sum() / 100 + 1


def test_rule_prefers_the_smallest_sum_of_squares():
    # gaps: two bins at 6, one at 5; the piece of 3 leaves squares smallest from one of the two
    bins, _ = packing.sum_of_squares(np.array([6, 6, 5, 3]), 10)
    assert bins[3] in (bins[0], bins[1])


def test_packed_rows(spark):
    long = "word " * 9000
    rows = [(1, "a short text", "x"), (2, None, "x"), (3, "", None), (4, long, "x"), (1, "a short text", "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    encoder = Tokenizer.from_file(packing.vocabulary_path())
    want = []
    for d, t, _ in rows:
        ids = encoder.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(d, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes()))
                 for k in range(0, len(ids), 4096)]
    for size in (16_384, 2):
        got = packing.pack(docs, group_pieces=size, with_ids=True)
        out = got.collect()
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)
        fill = {}
        for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == fill.get(r.sequence_id, 0)
            fill[r.sequence_id] = r.offset + r.length
        assert max(fill.values()) <= 4096
        whole = packing.sequences(got).collect()
        assert sum(len(r.ids) // 2 for r in whole) == sum(r.length for r in out)
        assert all(r.n_tokens * 2 == len(r.ids) for r in whole)
    assert len(fill) >= 4 and packing.digest(docs.limit(0)).count() == 0
