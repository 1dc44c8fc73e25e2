"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are lexicon densities (a short fixed list, words learned from labelled texts, and learned
word beginnings, for languages that inflect), lexicon words near a second-person word, capitals, punctuation and
obfuscation (letters mixed with digits or symbols, and lexicon words that appear once these are read as letters).
Spark ML's boosted trees learn on those, and an isotonic regression fitted on texts that the trees have not seen
turns their output into a probability. The trees never see a text through a lexicon that knows its label: each fold of
the learning texts is measured with a lexicon learned on the other folds.

Scale: one pass over the texts computes features and another the labelled texts' vocabulary; trees and calibration
are fitted on at most ``FIT_ROWS`` labelled texts, exact copies once, chosen by a hash of the id (the bound is what
makes the id list safe to broadcast). The lexicon holds at most ``LEXICON`` entries of either kind. Scoring streams.

Defined results: NULL text scores like empty text; without labelled texts of both kinds every score is the share of
label 1 (0 without labels); rows whose id or label is NULL are not learned from; an id with several labels counts
as toxic if any is; repeated rows score alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
FIT_ROWS = 20_000
LEXICON = 300
SUPPORT = 3
NEAR = 5
TREES, DEPTH = 20, 4
_CACHE = 200_000

INSULTS = frozenset("clown creep disgusting dumb fool garbage hate idiot idiots jerk kill loser losers moron morons pathetic "
                    "pig scum shut stupid trash ugly useless vermin worthless".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos "
                          "tú ti tuyo vosotros usted ustedes".split())
#: Characters read as letters inside a word.
_LETTERS = str.maketrans("013457@$!|", "oieastasil")
_ENDS = "\"'`.,;:!?()[]{}<>«»“”„…-–—*_"
_INNER = re.compile(r"[^\W\d_][\W\d_]+[^\W\d_]")
_RUNS = re.compile(rb"[!?.]{2,}")
STEMS = (4, 5, 6)


def plain(token: str) -> str:
    return token.lower().strip(_ENDS)


def terms_of(token: str) -> list[str]:
    """The word itself and, marked by a final dash, its beginnings."""
    word = plain(token)
    return [word, *[word[:n] + "-" for n in STEMS if len(word) > n]] if word else []


def vocabulary(fit: DataFrame) -> dict[str, float]:
    """The learned lexicon: terms with the highest log odds of label 1 among those that speak for it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], int] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                for term in {t for token in set((text.as_py() or "").split()) for t in terms_of(token)}:
                    counts[term, toxic] = counts.get((term, toxic), 0) + 1
            if len(counts) > _CACHE:
                yield passed_on(counts)
        yield passed_on(counts)

    def passed_on(counts: dict) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in counts], pa.string()), pa.array([y for _, y in counts], pa.int32()),
             pa.array(counts.values(), pa.int64())], names=["term", "toxic", "n"])
        counts.clear()
        return out

    size = {r.toxic: r.n for r in fit.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    a = F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0))
    b = F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0))
    odds = F.log((F.col("a") + 0.5) / (size.get(1, 0) + 1.0)) - F.log((F.col("b") + 0.5) / (size.get(0, 0) + 1.0))
    counted = map_batches(fit.select("text", "toxic"), run, "term string, toxic int, n long").groupBy("term").agg(
        a.alias("a"), b.alias("b")).where(F.col("a") >= SUPPORT).withColumn("odds", odds).where("odds > 2")
    lists = [counted.where(F.col("term").endswith("-") == stem).orderBy(
        (F.col("odds") * F.sqrt("a")).desc(), "term").limit(LEXICON).collect() for stem in (False, True)]
    return {r.term: float(r.odds) for found in lists for r in found}


NAMES = ("log_words", "list_density", "log_list", "word_density", "log_word", "word_weight", "stem_density", "log_stem",
         "stem_weight", "best_weight", "near_second_person", "second_person", "capitals", "capital_words", "exclamations",
         "questions", "punctuation_runs", "obfuscated", "read_as_lexicon")


class Features:
    """Dense features of a text under a lexicon; what a token contributes is remembered per task."""

    def __init__(self, lexicon: dict[str, float], listed: frozenset[str] = INSULTS):
        self.lexicon, self.listed = lexicon, listed
        self.known: dict[str, tuple | None] = {}

    def _token(self, token: str) -> tuple | None:
        """(list, word weight, stem weight, second person, obfuscated, read as lexicon) or None for nothing."""
        word, at = plain(token), self.lexicon.get
        stem = max((at(word[:n] + "-", 0.0) for n in STEMS if len(word) > n), default=0.0)
        hidden = bool(_INNER.search(word))
        read = ""
        if hidden or any(c in "013457@$!|" for c in word) and any(c.isalpha() for c in word):
            read = re.sub(r"[\W\d_]+", "", word.translate(_LETTERS))
            read = read if read != word else ""
        got = (word in self.listed, at(word, 0.0), stem, word in SECOND_PERSON, hidden,
               bool(read) and (read in self.listed or read in self.lexicon))
        return got if any(got) else None

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        tokens = text.split()
        n = len(tokens)
        if not n:
            return [0.0] * len(NAMES)
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        for token in set(tokens).difference(known):
            known[token] = self._token(token)
        hits = [(i, got) for i, got in enumerate(map(known.__getitem__, tokens)) if got is not None]
        listed = words = stems = second = hidden = read = near = 0
        word_weight = stem_weight = best = 0.0
        marked, persons = [], []
        for i, (in_list, w, s, person, obfuscated, reads) in hits:
            listed += in_list
            words += w > 0
            stems += s > 0
            word_weight += w
            stem_weight += s
            best = max(best, w, s)
            hidden += obfuscated
            read += reads
            if person:
                second += 1
                persons.append(i)
            if in_list or w or s or reads:
                marked.append(i)
        if persons and marked:
            where = np.searchsorted(persons, marked)
            p = np.array([-10**9, *persons, 10**9])
            m = np.array(marked)
            near = int((np.minimum(m - p[where], p[where + 1] - m) <= NEAR).sum())
        data = text.encode("utf-8")
        raw = np.frombuffer(data, np.uint8)
        upper = int(((raw >= 65) & (raw <= 90)).sum())
        lower = int(((raw >= 97) & (raw <= 122)).sum())
        shouted = sum(map(str.isupper, tokens)) if upper > lower / 8 else 0
        return [math.log1p(n), listed / n, math.log1p(listed), words / n, math.log1p(words), word_weight / n, stems / n,
                math.log1p(stems), stem_weight / n, best, near / n, second / n, upper / max(1, upper + lower), shouted / n,
                data.count(b"!") / n, data.count(b"?") / n, len(_RUNS.findall(data)) / n, hidden / n, read / n]


def features(rows: DataFrame, lexicon: dict[str, float], *carry: str, listed: frozenset[str] = INSULTS) -> DataFrame:
    """``carry`` columns and the vector ``features`` of ``text``."""
    kept = rows.select(*carry, F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features(lexicon, listed)
        for batch in batches:
            dense = pa.array([of(x.as_py()) for x in batch.column(len(carry))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], dense], names=[*carry, "dense"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + ["dense array<double>"])
    return map_batches(kept, run, schema).withColumn("features", array_to_vector("dense")).drop("dense")


def fold(column: str = "doc_id"):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(FOLDS))


def fit_rows(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """text, toxic, role: labelled texts outside the held-out fold, at most ``most`` ids, each distinct text once."""
    ids = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "_id is not null and toxic in (0, 1)").where(fold("_id") != HELD_OUT).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    ids = written(ids.orderBy(F.xxhash64("_id"), "_id").limit(most), "toxic-ids")  # at most ``most`` rows of 12 bytes
    found = docs.join(F.broadcast(ids), docs["doc_id"].cast("long") == ids["_id"]).select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "toxic", fold("_id").alias("fold"))
    # a text that occurs under several ids keeps its smallest fold, so copies never sit on both sides
    return written(found.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("fold").alias("fold")), "toxic-fit")


class Model:
    """Lexicon, trees and calibration; ``trees`` is None where the labels leave nothing to learn."""

    def __init__(self, docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, listed: frozenset[str] = INSULTS):
        self.listed = listed
        fit = fit_rows(docs, labels, most)
        learn = fit.where(F.col("fold") != CALIBRATION)
        kinds = {r.toxic: r.n for r in learn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        n = sum(kinds.values())
        self.share = kinds.get(1, 0) / n if n else 0.0
        self.trees = self.calibration = None
        self.lexicon: dict[str, float] = {}
        if len(kinds) < 2:
            return
        self.lexicon = vocabulary(learn)
        seen = [features(learn.where(F.col("fold") == k), vocabulary(learn.where(F.col("fold") != k)), "toxic", "fold", listed=listed)
                for k in range(FOLDS) if k not in (HELD_OUT, CALIBRATION)]
        unseen = features(fit.where(F.col("fold") == CALIBRATION), self.lexicon, "toxic", "fold", listed=listed)
        rows = written(reduce(DataFrame.union, seen, unseen), "toxic-features")
        self.trees = GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=5).fit(
            rows.where(F.col("fold") != CALIBRATION).select("features", "toxic"))
        unseen = self._raw(rows.where(F.col("fold") == CALIBRATION)).select("raw", F.col("toxic").cast("double").alias("toxic"))
        if unseen.agg(F.count_distinct("toxic")).first()[0] == 2:
            self.calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="score").fit(unseen)

    def _raw(self, rows: DataFrame) -> DataFrame:
        return self.trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])

    def score(self, docs: DataFrame, *carry: str) -> DataFrame:
        """``carry`` columns and ``score``, the calibrated probability of label 1."""
        if self.trees is None:
            return docs.select(*carry, F.lit(self.share).alias("score"))
        raw = self._raw(features(docs, self.lexicon, *carry, listed=self.listed))
        if self.calibration is None:
            return raw.select(*carry, F.col("raw").alias("score"))
        return self.calibration.transform(raw).select(*carry, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def digest(docs: DataFrame, labels: DataFrame, *, listed: frozenset[str] = INSULTS) -> DataFrame:
    model = Model(docs, labels, listed=listed)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return model.score(rows, "doc_id").select(
        "doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
