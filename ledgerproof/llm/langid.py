"""Language identification by segmentation-marginalised unigrams.

A language is a probability for every piece of a fixed public vocabulary. The likelihood of a word under it is
the sum over all its segmentations into pieces, by the forward algorithm; a text's is the product over its
words (maximal letter runs, lower-cased, opened by the vocabulary's word mark, which no piece crosses). Piece
probabilities come from expected counts: the posterior of each piece over all segmentations of every word of the
labelled texts, one forward-backward pass under even piece probabilities, smoothed toward the pool of languages.
Runs beyond ``SHORT`` letters (text without spaces) are summed whole, too: ``PART`` letters at a time, the mass of
the open places is carried over and scaled, so a run of any length neither leaves floating point nor is cut.

Scale: both passes stream over the texts. The lattice of a word is solved once per worker and distinct word, for
all words of a block at a time. Training gives one row per task, language and piece, summed by a shuffle; the
model, languages x pieces, is the only thing gathered, bounded by the vocabulary, and covers all labelled texts.

Defined results: NULL text and text without a letter are ``und`` with score 0; without any labelled text everything
is ``und``; ties go to the first language by code point; letter runs of any length count whole; letters outside the
vocabulary cost the same in every language; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, hold_cache, map_batches, refuse_taken

FOLDS, HELD_OUT = 4, 2
SHORT = 40  # letters of a word whose sums stay inside floating point
PART = 8  # letters summed between two scalings of a long run
TINY = 1e-290  # a short word's likelihood below this is summed again with scaling
MARK = "▁"
UNKNOWN = 1e-7  # probability of a letter no piece covers, alike in every language
SMOOTHING = 1000.0  # expected pieces of the pool added to each language
WORDS = 200_000  # distinct words counted before a training task solves them
BLOCK = 40_000  # words whose lattices are solved at a time
LONG_BLOCK = 1_000  # long runs summed side by side
CACHE = 300_000  # distinct words kept per worker when scoring

_RUNS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: str | None) -> list[str]:
    """Letter runs in lower case."""
    out = []
    for w in _RUNS.findall((text or "").lower()):
        if w.isalpha():
            out.append(w)
        else:  # numerals count as word characters for the pattern; combining marks do not reach it
            out += "".join(c if c.isalpha() else " " for c in w).split()
    return out


class Vocabulary:
    """Pieces of letters, with or without the word mark, found by the hash of their code points."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = sorted({p for p in map(model.id_to_piece, range(model.get_piece_size()))
                         if p == MARK or p.removeprefix(MARK).isalpha()})
        prefixes: dict[int, int] = {}
        with np.errstate(over="ignore"):
            for number, piece in enumerate(pieces):
                h = np.uint64(0)
                for c in piece:
                    h = self.step(h, np.uint64(ord(c)))
                    prefixes.setdefault(int(h), -1)
                prefixes[int(h)] = number
        self.size = len(pieces)
        self.longest = max(map(len, pieces))
        self.hashes = np.array(sorted(prefixes), np.uint64)
        self.numbers = np.array([prefixes[int(h)] for h in self.hashes], np.int64)

    @staticmethod
    def step(h, c):
        return (h ^ (c + np.uint64(1))) * _BASE

    def matches(self, code: np.ndarray, at: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Pieces from the places ``at`` of ``code`` that stop by ``end``: per length, (rows of ``at``, length, pieces)."""
        row, h = np.arange(len(at)), np.zeros(len(at), np.uint64)
        for n in range(1, self.longest + 1):
            with np.errstate(over="ignore"):
                h = self.step(h, code[at[row] + n - 1])
            k = np.searchsorted(self.hashes, h)
            k[k == len(self.hashes)] = 0
            known = self.hashes[k] == h
            number = np.where(known, self.numbers[k], -1)
            if n == 1:
                number[number < 0] = self.size  # a letter without a piece of its own
            is_piece = number >= 0
            yield row[is_piece], n, number[is_piece]
            go = known & (at[row] + n < end[row])
            row, h = row[go], h[go]
            if not len(row):
                break

    def lattice(self, words: list[str]) -> Lattice:
        return Lattice(self, words)


class Lattice:
    """All segmentations of a block of words: edges (from, to, piece) sorted so that those which end at the same
    place inside a word and have the same length form one run; within a run every end is another word's."""

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        marked = [MARK + w for w in words]
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        code = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
        first = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        node = np.arange(len(code)) + word  # a word of n letters has n + 1 nodes
        end = (first + lengths)[word]
        found = [(at, np.full(len(at), n), piece) for at, n, piece in vocabulary.matches(code, np.arange(len(code)), end)]
        at, n, self.piece = (np.concatenate(x) for x in zip(*found))
        inside = at + n - first[word[at]]
        order = np.argsort(inside * 64 + n, kind="stable")
        key = (inside * 64 + n)[order]
        self.source, self.piece = node[at[order]], self.piece[order]
        self.target = self.source + n[order]
        self.runs = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))).tolist() if len(key) else [0]
        self.start, self.stop = first + np.arange(len(words)), first + lengths + np.arange(len(words))
        self.nodes = len(code) + len(words)

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Mass of every node; ``p``: (pieces + 1, columns)."""
        mass = np.zeros((self.nodes, p.shape[1]))
        mass[self.start] = 1.0
        for a, b in zip(self.runs, self.runs[1:]):
            mass[self.target[a:b]] += mass[self.source[a:b]] * p[self.piece[a:b]]
        return mass

    def likelihood(self, p: np.ndarray) -> np.ndarray:
        return self.forward(p)[self.stop]

    def expected(self, p: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """(columns of ``weights``, pieces + 1): expected uses of each piece, words weighted by ``weights``."""
        one = p.reshape(-1, 1)
        front = self.forward(one)[:, 0]
        back = np.zeros(self.nodes)
        back[self.stop] = 1.0
        for a, b in zip(self.runs[-2::-1], self.runs[:0:-1]):
            # ends of a run are distinct words, so are its beginnings
            back[self.source[a:b]] += back[self.target[a:b]] * p[self.piece[a:b]]
        word = np.zeros(self.nodes, np.int64)
        word[self.start[1:]] = 1
        word = np.cumsum(word)[self.source]
        share = front[self.source] * p[self.piece] * back[self.target] / front[self.stop][word]
        return np.stack([np.bincount(self.piece, share * w[word], len(p)) for w in weights.T])


class LongRuns:
    """Sums over all segmentations of long words, side by side, ``PART`` letters at a time.

    A piece spans at most ``reach`` letters, so the masses of the next ``reach`` places are all that one part hands to
    the next. They are divided by their largest, whose logarithm is added up beside them."""

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        self.vocabulary, self.reach = vocabulary, vocabulary.longest
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.order = np.argsort(-lengths, kind="stable")  # words that go on are the first ones
        self.lengths = lengths[self.order]
        self.code = np.frombuffer("".join(MARK + words[k] for k in self.order).encode("utf-32-le"), "<u4").astype(np.uint64)
        self.first = np.cumsum(self.lengths) - self.lengths

    def _live(self, a: int) -> int:
        """Words with a place ``a``."""
        return int(np.searchsorted(-self.lengths, -a, side="right"))

    def _pieces(self, a: int, live: int) -> np.ndarray:
        """(live, PART, reach): the piece of each length from each of the part's letters; size + 1 is none."""
        none = self.vocabulary.size + 1
        out = np.full((live * PART, self.reach), none)
        inside = a + np.tile(np.arange(PART), live)
        held = np.flatnonzero(inside < np.repeat(self.lengths[:live], PART))
        word = held // PART
        at = self.first[word] + inside[held]
        for row, n, number in self.vocabulary.matches(self.code, at, (self.first + self.lengths)[word]):
            out[held[row], n - 1] = number
        return out.reshape(live, PART, self.reach)

    def forward(self, p: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """(log likelihood of each word and column of ``p``; with ``keep``, the log masses of each part's places)."""
        columns, table = p.shape[1], np.concatenate([p, np.zeros((1, p.shape[1]))])
        out, kept = np.zeros((len(self.lengths), columns)), []
        live = len(self.lengths)
        carry, scale = np.zeros((live, self.reach, columns)), np.zeros((live, columns))
        carry[:, 0] = 1.0
        for a in range(0, int(self.lengths.max(initial=-1)) + 1, PART):
            mass = np.concatenate([carry, np.zeros((live, PART, columns))], 1)
            piece = self._pieces(a, live)
            for j in range(PART):
                mass[:, j + 1:j + 1 + self.reach] += (mass[:, j, None] * table[piece[:, j]])[:, :mass.shape[1] - j - 1]
            with np.errstate(divide="ignore"):
                if keep:
                    kept.append(np.log(mass[:, :PART]) + scale[:, None])
                on = self._live(a + PART)
                ends = np.arange(on, live)
                out[ends] = np.log(mass[ends, self.lengths[ends] - a]) + scale[ends]
            live = on
            carry = mass[:live, PART:]
            top = carry.max(1)
            carry, scale = carry / top[:, None], scale[:live] + np.log(top)
        return out, kept

    def likelihood(self, p: np.ndarray) -> np.ndarray:
        """Log likelihoods in the words' own order."""
        out = np.empty((len(self.lengths), p.shape[1]))
        out[self.order] = self.forward(p)[0]
        return out

    def expected(self, p: np.ndarray) -> np.ndarray:
        """(pieces + 1): expected uses of each piece in all the words."""
        total, front = self.forward(p.reshape(-1, 1), keep=True)
        out = np.zeros(len(p) + 1)
        carry = np.zeros((0, self.reach))
        with np.errstate(divide="ignore"):
            table = np.log(np.append(p, 0.0))
        for k in range(len(front) - 1, -1, -1):  # the way back is in logarithms
            a, live = k * PART, len(front[k])
            back = np.full((live, PART + self.reach), -np.inf)
            back[:len(carry), PART:] = carry
            ends = np.arange(len(carry), live)
            back[ends, self.lengths[ends] - a] = 0.0
            piece = self._pieces(a, live)
            for j in range(PART - 1, -1, -1):
                step = back[:, j + 1:j + 1 + self.reach] + table[piece[:, j]]
                back[:, j] = np.logaddexp(back[:, j], np.logaddexp.reduce(step, axis=1))
                out += np.bincount(piece[:, j].ravel(), np.exp(front[k][:, j] + step - total[:live]).ravel(), len(out))
            carry = back[:, :self.reach]
        return out[:-1]


def by_length(words: list[str]) -> Iterator[list[int]]:
    """Places of the words in blocks of like length."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    for i in range(0, len(order), LONG_BLOCK):
        yield order[i:i + LONG_BLOCK]


def log_likelihoods(v: Vocabulary, words: list[str], p: np.ndarray, block: int) -> np.ndarray:
    """(words, columns of ``p``): logarithms of the sums over all segmentations, for words of any length."""
    out = np.empty((len(words), p.shape[1]))
    scaled = [k for k, w in enumerate(words) if len(w) > SHORT]
    short = [k for k, w in enumerate(words) if len(w) <= SHORT]
    for i in range(0, len(short), block):
        at = short[i:i + block]
        mass = v.lattice([words[k] for k in at]).likelihood(p)
        small = (mass < TINY).any(1)
        scaled += [k for k, low in zip(at, small) if low]
        out[at] = np.log(np.maximum(mass, TINY))
    for at in by_length([words[k] for k in scaled]):
        rows = [scaled[k] for k in at]
        out[rows] = LongRuns(v, [words[k] for k in rows]).likelihood(p)
    return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def learn(docs: DataFrame, *, path: str | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """Expected piece counts of the labelled ``docs``: lang, piece int, n double. Rows without a label are left out."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        hold_cache("language counts", lambda: None)
        even = np.full(v.size + 1, 1.0 / v.size)
        even[v.size] = UNKNOWN
        index: dict[str, int] = {}
        counts: dict[str, np.ndarray] = {}
        totals: dict[str, np.ndarray] = {}

        def solve() -> None:
            langs = list(counts)
            if index:
                weights = np.stack([np.pad(counts[x], (0, len(index) - len(counts[x]))) for x in langs], 1)
                words = list(index)
                for i in range(0, len(words), BLOCK):
                    found = v.lattice(words[i:i + BLOCK]).expected(even, weights[i:i + BLOCK])
                    for x, n in zip(langs, found):
                        totals[x] = totals.get(x, 0) + n
            index.clear()
            counts.clear()

        for batch in batches:
            numbers: dict[str, list[int]] = {}
            long: dict[str, list[str]] = {}
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                found = [w for w in words if len(w) <= SHORT]
                if len(found) < len(words):
                    long.setdefault(label, []).extend(w for w in words if len(w) > SHORT)
                for w in found:
                    if w not in index:
                        index[w] = len(index)
                numbers.setdefault(label, []).extend(map(index.__getitem__, found))
            for label, at in numbers.items():
                now = np.bincount(np.array(at, np.int64), minlength=len(index))
                old = counts.get(label)
                if old is not None:
                    now[:len(old)] += old
                counts[label] = now
            for label, words in long.items():
                for block in by_length(words):
                    totals[label] = totals.get(label, 0) + LongRuns(v, [words[k] for k in block]).expected(even)
            if len(index) > WORDS:
                solve()
        solve()
        for label, n in totals.items():
            at = np.flatnonzero(n[:-1] > 0)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(n[at], pa.float64())], names=["lang", "piece", "n"])

    labelled = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    return map_batches(labelled, run, "lang string, piece int, n double").groupBy("lang", "piece").agg(
        F.sum("n").alias("n"))


def model_of(counts: DataFrame, *, path: str | None = None) -> tuple[list[str], np.ndarray]:
    """(languages, piece probabilities by language): gathers one row per language and piece."""
    size = vocabulary(path or vocabulary_path()).size
    rows = counts.toPandas().sort_values(["lang", "piece"])
    langs = sorted(rows["lang"].unique())
    n = np.zeros((len(langs), size))
    n[rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int), rows["piece"].to_numpy(int)] = rows["n"]
    pool = (n.sum(0) + 0.01) / (n.sum() + 0.01 * size)
    p = (n + SMOOTHING * pool) / (n.sum(1, keepdims=True) + SMOOTHING)
    return langs, np.concatenate([p, np.full((len(langs), 1), UNKNOWN)], 1)


_SCORED: dict[bytes, tuple[dict[str, int], np.ndarray]] = {}


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, path: str | None = None, text: str = "text",
            pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the likeliest language and its posterior under even priors, in columns that ``docs`` must not have."""
    refuse_taken(docs.columns, pred, score)
    path = path or vocabulary_path()
    langs, p = model
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, by_piece = vocabulary(path), np.ascontiguousarray(p.T)
        mark = hashlib.sha1(by_piece.tobytes() + repr(langs).encode()).digest()
        block = max(1000, BLOCK * 4 // max(4, len(langs)))
        hold_cache("language scores", _SCORED.clear)
        known, table = _SCORED.get(mark) or ({}, np.zeros((0, len(langs))))
        for batch in batches:
            found = [words_of(x.as_py()) for x in batch.column(at)]
            if len(known) > CACHE:
                known, table = {}, np.zeros((0, len(langs)))
            long = [[w for w in words if len(w) > SHORT] for words in found]  # scored as they come, not kept
            found = [[w for w in words if len(w) <= SHORT] if n else words for words, n in zip(found, long)]
            new = list(dict.fromkeys([w for words in found for w in words if w not in known])) if langs else []
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new))))
                table = np.concatenate([table, log_likelihoods(v, new, by_piece, block)])
                _SCORED.clear()
                _SCORED[mark] = known, table
            runs = list(dict.fromkeys(w for words in long for w in words)) if langs else []
            place = dict(zip(runs, range(len(runs))))
            own = log_likelihoods(v, runs, by_piece, block)
            best, sure = [], []
            for words, more in zip(found, long):
                if not (words or more) or not langs:
                    best.append("und")
                    sure.append(0.0)
                    continue
                total = table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(0)
                if more:
                    total = total + own[[place[w] for w in more]].sum(0)
                k = int(total.argmax())
                best.append(langs[k])
                sure.append(float(1.0 / np.exp(np.maximum(total - total[k], -700)).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(sure, pa.float64())],
                                             names=[*batch.schema.names, pred, score])

    return map_batches(docs, run, schema)


def fold(doc_id="doc_id"):
    """crc32 of the id as text, modulo ``FOLDS``; NULL for a NULL id, which is neither held out nor learned from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def learned_from(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    return model_of(learn(docs.where(fold() != HELD_OUT)))


def digest(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return predict(rows, learned_from(docs)).select(
        "doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def least_score(languages: int) -> float:
    """Below this a text tells next to nothing apart: a little above the score of a text that fits all alike."""
    return min(0.5, 1 / max(1, languages) + 0.05)


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` whose language could be told: not ``und`` and likelier than ``least_score``."""
    names = docs.columns
    pred, score = free_names(names, "_lang_pred", "_lang_score")
    model = learned_from(docs)
    return predict(docs, model, pred=pred, score=score).where(
        (F.col(pred) != "und") & (F.col(score) > least_score(len(model[0])))).select(*names)
