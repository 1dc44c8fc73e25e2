"""Quality rules as a short-circuit cascade.

A rule rejects a text by a few of its measures; measures are computed when first asked for and kept, so a text that
an early rule rejects never pays for the later ones. On a bounded sample every rule is run by itself; the cascade
runs rules in falling order of (share rejected) / (processor time). The order changes the cost only: a text is kept
if no rule rejects it.

Scale: one pass over the texts without a shuffle; the sample is taken and measured by the executors, and one row per
rule reaches the driver.

Defined results: NULL text measures like empty text (no words, so the word-count rule rejects it); repeated rows are
judged alike; an empty table gives no rows and the rules keep the order given; other columns pass through.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, refuse_taken

#: Most texts on which costs and selectivities are estimated.
SAMPLE_ROWS = 2_000
WINDOW = 8

_BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_SYMBOLS = tuple(bytes([c]) for c in b"#*$%&|<>")


class Measures:
    """A text's measures, each computed at its first use."""

    def __init__(self, text: bytes | None):
        self.text = text or b""

    def __getattr__(self, name: str) -> int | list:
        value = getattr(type(self), "_" + name)(self)
        setattr(self, name, value)
        return value

    def _words(self) -> list[bytes]:
        return self.text.split()

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        """Code points outside blanks: bytes that do not continue a code point, less the blanks."""
        starts = len(self.text) - int((np.frombuffer(self.text, np.uint8) & 0xC0 == 0x80).sum())
        return starts - sum(map(self.text.count, _BLANKS))

    def _n_symbols(self) -> int:
        return sum(map(self.text.count, _SYMBOLS))

    def _lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x.strip()]

    def _n_lines(self) -> int:
        return len(self.lines)

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self) -> int:
        """Words inside windows of ``WINDOW`` words that occur twice or more."""
        n = len(self.words) - WINDOW + 1
        if n < 2:
            return 0
        h = np.fromiter(map(hash, self.words), np.int64, len(self.words)).view(np.uint64)
        rolled = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            rolled = (rolled * np.uint64(0x9E3779B97F4A7C15)) ^ (h[k:k + n] + np.uint64(k))
        order = np.argsort(rolled)
        same = rolled[order][1:] == rolled[order][:-1]
        if not same.any():
            return 0
        maybe = np.zeros(n, bool)
        maybe[order[1:][same]] = maybe[order[:-1][same]] = True
        seen: dict[tuple, list[int]] = {}
        for i in np.flatnonzero(maybe).tolist():  # equal hashes are confirmed on the words
            seen.setdefault(tuple(self.words[i:i + WINDOW]), []).append(i)
        change = np.zeros(len(self.words) + 1, np.int64)
        for places in seen.values():
            if len(places) > 1:
                change[places] += 1
                change[np.array(places) + WINDOW] -= 1
        return int((np.cumsum(change) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


#: The two base rules, then word length, symbols per word and repeated lines.
RULES = (
    Rule("few_words", lambda m: m.n_words < 20),
    Rule("repeated_passages", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
    Rule("word_length", lambda m: m.word_chars < 2 * m.n_words or m.word_chars > 20 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > 3 * m.n_words),
    Rule("repeated_lines", lambda m: m.n_dup_lines > 1 and 10 * m.n_dup_lines > 3 * m.n_lines),
)


def _binary(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).cast("string").cast("binary").alias("text"))


def estimates(docs: DataFrame, rules=RULES, *, text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7):
    """{rule name: (share rejected, seconds a text)} on about ``sample_rows`` texts, each rule from scratch."""
    n = docs.count()
    if not n:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rejected, cost = [], []
            for rule in rules:
                began = time.thread_time()
                rejected.append(sum(rule.rejects(Measures(x)) for x in texts))
                cost.append(time.thread_time() - began)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.name for r in rules]), pa.array([len(texts)] * len(rules), pa.int64()),
                 pa.array(rejected, pa.int64()), pa.array(cost, pa.float64())], names=["rule", "n", "rejected", "cost"])

    sample = _binary(docs.sample(fraction=min(1.0, sample_rows / n), seed=seed), text)
    rows = map_batches(sample, run, "rule string, n long, rejected long, cost double").groupBy("rule").agg(
        F.sum("n").alias("n"), F.sum("rejected").alias("rejected"), F.sum("cost").alias("cost")).collect()
    return {r.rule: (r.rejected / r.n, r.cost / r.n) for r in rows if r.n}


def ordered(rules, found) -> list[Rule]:
    """Rules by falling rejection per cost; rules without an estimate keep their place behind."""
    def gain(rule):
        share, cost = found.get(rule.name, (0.0, 1.0))
        return -share / max(cost, 1e-9)

    return sorted(rules, key=gain)


def cascade(docs: DataFrame, rules=RULES, *, text: str = "text", kept: str = "kept", measures: tuple[str, ...] = (),
            **how) -> DataFrame:
    """``docs`` with the verdict ``kept`` and, where asked for, ``measures`` (long) of every text, in columns that ``docs``
    must not have."""
    refuse_taken(docs.columns, kept, *measures)
    order = ordered(rules, estimates(docs, rules, text=text, **how))
    schema = T.StructType([*docs.schema.fields, *[T.StructField(m, T.LongType()) for m in measures],
                           T.StructField(kept, T.BooleanType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdict, asked = [], [[] for _ in measures]
            for x in batch.column(at).cast(pa.binary()):
                m = Measures(x.as_py())
                verdict.append(not any(rule.rejects(m) for rule in order))
                for name, values in zip(measures, asked):
                    values.append(getattr(m, name))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(v, pa.int64()) for v in asked], pa.array(verdict, pa.bool_())],
                names=[*batch.schema.names, *measures, kept])

    return map_batches(docs, run, schema)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def digest(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return cascade(rows, measures=BASE).select("doc_id", *BASE, failed.alias("base_failed"), "kept")


ORACLE = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
windows as (
  select r, i, array_to_string(words[i:i + 7], ' ') as win
  from (select r, words, unnest(range(1, len(words) - 6)) as i from w where len(words) >= 8)),
again as (select r, i, count(*) over (partition by r, win) as n from windows),
covered as (
  select r, count(distinct p) as n from (select r, unnest(range(i, i + 8)) as p from again where n > 1) group by r),
m as (
  select doc_id, cast(len(words) as bigint) as n_words,
         cast(length(array_to_string(words, '')) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         cast(coalesce(c.n, 0) as bigint) as n_repeat_words, len(lines) as n_lines
  from w left join covered c on c.r = w.r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or word_chars < 2 * n_words
            or word_chars > 20 * n_words or 10 * n_symbols > 3 * n_words or n_dup_lines > 1 and 10 * n_dup_lines > 3 * n_lines) as kept
from m
"""
