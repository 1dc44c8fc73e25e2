"""Secret scan: a wide candidate pattern, then a random forest that removes false positives. DataFrame operations only.

A candidate is any value assigned to a credential's name and, elsewhere, a run of at least ``SHORTEST`` key-like
characters that holds a digit. Its features are length,
changes between character classes, shares of digits and capitals, distinct characters, hexadecimal form, the share of
its letters covered by dictionary words (letter runs that occur in at least ``KNOWN`` documents of the corpus), how
it is set (assigned, quoted), and the log odds, among the labelled findings, of the word before, the word after and
the path. Spark ML's random forest learns from labelled findings, whose own odds come from the other folds, and scores
every candidate.

Findings come labelled from the caller; ``presumed`` labels candidates by published key formats and credential
names, for corpora without labels, and the registered query learns on three of four documents that way.

Scale: texts are read twice and never shuffled: once for candidates, of which 60 characters of context either side
are kept, and once for the dictionary's word counts, partly summed per task. Offsets are running sums of lengths over
a document's slim rows. Forest and odds are fitted on at most ``FIT_ROWS`` findings, chosen by a hash of their value
and place; tables joined to candidates are joined by key, and only Spark decides to broadcast them, by size.

Defined results: NULL and empty texts have no candidates; rows that repeat give their candidates again; a NULL path
is a path; without findings of both labels every score is the share of label 1 (0 without findings); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHORTEST = 12
CANDIDATE = r"[A-Za-z0-9+/_@.~-]{%d,}" % SHORTEST
CONTEXT = 60
KNOWN = 5
FIT_ROWS = 50_000
TREES, DEPTH = 40, 7
FOLDS, HELD_OUT = 4, 0

#: Published key formats and the names credentials are assigned to; fixed values.
FORMATS = (r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^AIza[0-9A-Za-z_-]{35}$"
           r"|^[sr]k_live_[0-9A-Za-z]{16,}$|^sk-[A-Za-z0-9_-]{20,}$|^glpat-[A-Za-z0-9_-]{20}$|^eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_.-]+$")
_CREDENTIAL = r"(?i:password|passwd|pwd|secret|token|api_?key|access_?key|auth|credential)s?"
NAMES = _CREDENTIAL + "$"
#: Forms that are something else: mail addresses, host names and versions, plain numbers, placeholders.
OTHER = r"@|^[0-9.+/_-]+$|(?i)example|sample|xxxx|0123456789|\.(?:com|org|net|html?|jpg|png|js|css)"

#: What stands behind a credential's name and a colon or equals sign, whatever its length or signs, up to a blank, quote,
#: bracket, comma, semicolon or ampersand; the cheap look back comes first.
_NAMED = _CREDENTIAL + r"[\"']?\s{0,3}[:=]"
_ASSIGNED = (r"(?<=[:=\s\"'])(?<=[:=]\s{0,3}[\"']?)(?<=" + _NAMED + r"\s{0,3}[\"']?)[^\s\"'<>,;&]*[^\s\"'<>=:,;&.!?()\[\]{}]")
_FEWEST = 5  # signs of the shortest assignment, ``pwd=x``

FEATURES = ("chars", "changes", "digits", "capitals", "distinct", "hexadecimal", "coverage", "assigned", "quoted",
            "before_odds", "after_odds", "path_odds")


def candidates(docs: DataFrame, *, path: str = "source") -> DataFrame:
    """doc_id, start, end (code points), value, before and after (nearest words), assigned, quoted, path; written.

    Candidates are the values assigned to a credential's name and, elsewhere, runs of SHORTEST signs or more that hold a
    digit."""
    both, has = f"{_ASSIGNED}|{CANDIDATE}", F.col("text").rlike(_NAMED)
    pieces = F.when(has, F.split("text", both, -1)).otherwise(F.split("text", CANDIDATE, -1))
    values = F.when(has, F.regexp_extract_all("text", F.lit(both), F.lit(0))).otherwise(
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col(path).cast("string").alias("path"), F.monotonically_increasing_id().alias("row"))
    found = rows.select("row", "doc_id", "path", pieces.alias("p"), values.alias("v")).where(F.size("v") > 0)
    reach = CONTEXT // _FEWEST  # so many neighbouring runs fill the context

    def part(column: str, i: Column, first: bool) -> Column:
        return F.coalesce(F.substring(F.get(column, i), 1 if first else -CONTEXT, CONTEXT), F.lit(""))

    def left(i: Column) -> Column:
        runs = [x for k in range(reach, 0, -1) for x in (part("v", i - k, False), part("p", i - k + 1, False))]
        return F.substring(F.concat(part("p", i - reach, False), *runs), -CONTEXT, CONTEXT)

    def right(i: Column) -> Column:
        runs = [x for k in range(1, reach + 1) for x in (part("v", i + k, True), part("p", i + k + 1, True))]
        return F.substring(F.concat(part("p", i + 1, True), *runs), 1, CONTEXT)

    slim = F.transform("v", lambda value, i: F.struct(
        value.alias("value"), F.length(F.get("p", i)).alias("gap"), left(i).alias("left"), right(i).alias("right")))
    each = found.select("row", "doc_id", "path", F.posexplode(slim).alias("k", "c")).select(
        "row", "doc_id", "path", "k", "c.value", "c.gap", "c.left", "c.right")
    upto = Window.partitionBy("row").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    word = r"([\p{L}\p{N}_-]+)[^\p{L}\p{N}]*$"
    named = F.col("left").rlike(_NAMED + r"\s*[\"']?$")
    out = each.withColumn("end", end.cast("long")).where(F.col("value").rlike("[0-9]") | named).select(
        "doc_id", (F.col("end") - F.length("value")).cast("long").alias("start"), "end", "value",
        F.lower(F.regexp_extract("left", word, 1)).alias("before"),
        F.lower(F.regexp_extract("right", r"^[^\p{L}\p{N}]*([\p{L}\p{N}_-]+)", 1)).alias("after"),
        F.col("left").rlike(r"[=:]\s*[\"']?$").alias("assigned"), F.col("left").rlike("[\"']$").alias("quoted"),
        F.coalesce("path", F.lit("")).alias("path"))
    return written(out, "secret-candidates")


def dictionary(docs: DataFrame) -> DataFrame:
    """word: the letter runs that at least ``KNOWN`` documents hold."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit("[a-z]{3,}"), F.lit(0)))
    return docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(
        F.col("n") >= KNOWN).select("word")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("value", pattern, "")) / F.length("value")


def measured(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the features that need no labels."""
    runs = F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))
    parts = found.select("value").distinct().select("value", F.explode(runs).alias("word"))
    covered = parts.join(words, "word", "left_semi").groupBy("value").agg(F.sum(F.length("word")).alias("_covered"))
    letters = F.greatest(F.lit(1), F.length(F.regexp_replace("value", "[^A-Za-z]", "")))
    changes = F.regexp_count("value", F.lit(
        "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"))
    return found.join(covered, "value", "left").select(
        *found.columns, F.length("value").cast("double").alias("chars"),
        (changes / F.length("value")).alias("changes"), _share("[^0-9]").alias("digits"), _share("[^A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split("value", ""))) / F.length("value")).alias("distinct"),
        F.col("value").rlike("^[0-9a-f]+$").cast("double").alias("hexadecimal"),
        (F.coalesce("_covered", F.lit(0)) / letters).alias("coverage"))


def presumed(found: DataFrame) -> DataFrame:
    """Candidates that their form or their name decides, with ``label``; undecided ones are left out."""
    named = F.col("assigned") & F.col("before").rlike(NAMES)
    form = F.col("value").rlike(FORMATS)
    other = F.col("value").rlike(OTHER)
    return found.withColumn("label", F.when(form | named & ~other, 1).when(other & ~named, 0)).where("label is not null")


SIDES = ("before", "after", "path")
ODDS_FOLDS = 4


def out_of_fold(fit: DataFrame, prior: float) -> DataFrame:
    """Labelled findings with the odds of their words and path as the findings of the other folds have them; folds are by
    value, so neither a finding's own label nor a copy's is in its odds. What no other fold knows has the prior."""
    rows = fit.withColumn("_fold", F.pmod(F.xxhash64("value"), F.lit(ODDS_FOLDS)))
    for c in SIDES:
        each = rows.groupBy(F.col(c).alias("_c"), F.col("_fold").alias("_f")).agg(
            F.sum("label").alias("_own1"), F.sum(1 - F.col("label")).alias("_own0"))
        whole = Window.partitionBy("_c")
        each = each.select("_c", "_f", (F.sum("_own1").over(whole) - F.col("_own1")).alias("_o"),
                           (F.sum("_own0").over(whole) - F.col("_own0")).alias("_z"))
        odds = F.when(F.col("_o") + F.col("_z") > 0, F.log((F.col("_o") + 0.5) / (F.col("_z") + 0.5))).otherwise(prior)
        rows = rows.join(each, (F.col(c) == F.col("_c")) & (F.col("_fold") == F.col("_f"))).withColumn(
            f"{c}_odds", odds).drop("_c", "_f", "_o", "_z")
    return rows.drop("_fold")


class Model:
    """Log odds of neighbours and paths, and the forest, from labelled ``findings`` (measured candidates and label)."""

    def __init__(self, findings: DataFrame, most: int = FIT_ROWS):
        chosen = findings.orderBy(F.xxhash64("value", "doc_id", "start"), "value", "doc_id", "start").limit(most)
        fit = written(chosen, "secret-findings")
        kinds = {r.label: r.n for r in fit.groupBy("label").agg(F.count("*").alias("n")).collect()}
        n = sum(kinds.values())
        self.share = kinds.get(1, 0) / n if n else 0.0
        self.forest = None
        if len(kinds) < 2:
            return
        self.prior = math.log((kinds[1] + 0.5) / (kinds[0] + 0.5))
        ones, zeros = F.sum("label"), F.sum(1 - F.col("label"))
        self.odds = {c: fit.groupBy(c).agg(F.log((ones + 0.5) / (zeros + 0.5)).alias(f"{c}_odds")).withColumnRenamed(c, f"_{c}")
                     for c in SIDES}
        self.forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
                                             seed=3).fit(self._assembled(out_of_fold(fit, self.prior)).select("features", "label"))

    def _with_odds(self, rows: DataFrame) -> DataFrame:
        for column, table in self.odds.items():
            rows = rows.join(table, F.col(column) == F.col(f"_{column}"), "left").drop(f"_{column}").withColumn(
                f"{column}_odds", F.coalesce(f"{column}_odds", F.lit(self.prior)))
        return rows

    def _assembled(self, rows: DataFrame) -> DataFrame:
        for flag in ("assigned", "quoted"):
            rows = rows.withColumn(flag, F.col(flag).cast("double"))
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)

    def score(self, rows: DataFrame) -> DataFrame:
        """Measured candidates with ``score``, the forest's share for label 1."""
        if self.forest is None:
            return rows.withColumn("score", F.lit(self.share))
        return self.forest.transform(self._assembled(self._with_odds(rows))).withColumn("score", vector_to_array("probability")[1])


def scan(docs: DataFrame, findings=None, *, path: str = "source", threshold: float = 0.5) -> DataFrame:
    """Every candidate of ``docs``: doc_id, start, end, value, score, is_secret.

    ``findings``: a function from measured candidates to labelled ones (``presumed`` on the learning fold if None)."""
    found = written(measured(candidates(docs, path=path), dictionary(docs)), "secret-measured")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    labelled = findings(found) if findings else presumed(found.where(fold != HELD_OUT))
    return Model(labelled).score(found).select("doc_id", "start", "end", "value", "score",
                                               (F.col("score") >= threshold).alias("is_secret"))


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs).select("doc_id", "start", "end", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
                             "score", "is_secret")
