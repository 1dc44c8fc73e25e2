"""Benchmark decontamination by a generalised suffix automaton of the test items.

Texts are normalised to words: A-Z lower-cased, then runs of digits, a-z and anything beyond ASCII. A window is
``window`` consecutive words of an item; an item of fewer words, but not none, is one window. A document word inside
any occurrence of a window is hit.

Method: the items' words go into one suffix automaton, every item from the initial state. A document's words are
streamed through it; the automaton's state and the longest matching length tell, word by word, the longest run ending
here that some item holds. Where that length reaches ``window``, the last ``window`` words are hit; whole short items
are found on the state's suffix links. A word that no item holds resets the state, so only runs of known words as long
as the shortest window are walked at all.

Scale: documents are read once, where they lie, and only hits leave a task; nothing is shuffled. Items are the stated
query set. They are cut into pieces of ``PIECE`` words that overlap by window - 1 (every window stays whole), and
``PIECES`` of them at most make one automaton, built in an executor and broadcast: some 256,000 words by
construction, whatever the items' number. More items mean more passes, whose hits are joined by document.

Defined results: NULL text has no words; texts may have any length; NULL item ids are listed as ``null``; rows of
``benchmark`` equal in id and text are one item, and an id counts once; repeated documents get equal rows; without
items or documents nothing is hit; other columns are ignored (``digest``, ``hits``) or passed on (``decontaminated``).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_names, map_batches, positions, written

WINDOW = 10
PIECE = 64
PIECES = 4000
MIN_WORDS = 10  # a removed span has this many words at least
COVERAGE = 0.5  # a document hit beyond this share goes as a whole
_CHUNK = 1 << 22  # bytes of a text split into words at a time

_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
#: Byte by byte: capitals lower-cased, everything else that is not part of a word a space.
_NORMAL = bytes(b if b in _WORD_BYTES else b | 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, a chunk at a time; a chunk ends between words."""
    at = 0
    while at < len(text):
        part = text[at:at + _CHUNK].translate(_NORMAL)
        if at + _CHUNK < len(text):
            cut = part.rfind(b" ") + 1
            while not cut:  # one word longer than a chunk
                part = text[at:at + 2 * len(part)].translate(_NORMAL)
                cut = part.rfind(b" ") + 1 if at + len(part) < len(text) else len(part)
            part = part[:cut]
        yield part.split()
        at += len(part)


class Automaton:
    """Suffix automaton of several word sequences, with what a window's or a whole short item's end needs to know."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        """``items``: (number, words); a number may come again with another piece."""
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(n, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for n, words in items if words]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # items by state: of every window, and of whole items shorter than one
        self.found: dict[int, list[int]] = {}
        self.shortest = min((min(len(words), window) for _, words in coded), default=0)
        for n, words in coded:
            least, state = min(len(words), window), 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= least:
                    state = self._cut(state, least)
                    held = self.found.setdefault(state, [])
                    if n not in held[-1:]:
                        held.append(n)
        # nearest state on the suffix links, the state itself included, that is a whole short item
        short = {s for s in self.found if self.length[s] < window}
        self.whole = [-1] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__) if short else ():
            self.whole[s] = s if s in short else self.whole[self.link[s]]

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        there = nxt[last].get(w)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._clone(last, w, there)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _cut(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of any text that ends in ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def walk(self, words: list[int], first: int, spans: list[list[int]], states: set[int]) -> None:
        """Adds the hit spans (first word, behind the last) and the window states of a run of known words."""
        nxt, link, length, window, whole = self.next, self.link, self.length, self.window, self.whole
        state = matched = 0
        for i, w in enumerate(words, first + 1):
            there = nxt[state].get(w)
            while there is None:
                state = link[state]
                if state < 0:
                    break
                matched = length[state]
                there = nxt[state].get(w)
            if there is None:
                state = matched = 0
                continue
            state, matched = there, matched + 1
            size = 0
            if matched >= window:
                states.add(self._cut(state, window))
                size = window
            # the state's own text is matched as a whole, or only a part of it and links are asked
            s = whole[state] if matched == length[state] else whole[link[state]]
            while s > 0:
                states.add(s)
                size = max(size, length[s])
                s = whole[link[s]]
            if size:
                begin = i - size
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append([begin, i])

    def scan(self, text: bytes) -> tuple[int, list[list[int]], set[int]]:
        """Words, disjoint hit spans and the numbers of the items with a window in ``text``."""
        get, n, shortest = self.vocabulary.get, 0, self.shortest
        spans: list[list[int]] = []
        states: set[int] = set()
        held: list[int] = []  # a run of known words that may go on in the next chunk
        for words in words_of(text):
            if not shortest:
                n += len(words)
                continue
            codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
            edges = np.flatnonzero(codes < 0)
            begins = np.concatenate(([0], edges + 1))
            ends = np.concatenate((edges, [len(codes)]))
            long = ends - begins >= shortest
            long[0] = long[-1] = True
            for b, e in zip(begins[long].tolist(), ends[long].tolist()):
                run = codes[b:e].tolist()
                if b == 0 and held:
                    run = held + run
                    held = []
                if e == len(codes):
                    held = run
                elif len(run) >= shortest:
                    self.walk(run, n + e - len(run), spans, states)
            n += len(words)
        if held and len(held) >= shortest:
            self.walk(held, n - len(held), spans, states)
        return n, spans, {k for s in states for k in self.found[s]}


def pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """item, words: items normalised and cut into overlapping pieces of at most PIECE words, or ``window``. Written."""
    size = max(PIECE, 2 * window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = [w for part in words_of(text.as_py()) for w in part]
                for at in range(0, max(1, len(words) - window + 1), size - window + 1):
                    if words:
                        out.append((item, b" ".join(words[at:at + size])))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()),
                                              pa.array([o[1] for o in out], pa.binary())], names=["item", "words"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return written(map_batches(items, run, "item string, words binary").distinct(), "leak-pieces")


def automata(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """block, built: a pickled automaton of at most PIECES pieces and the ids of its items, a row per block. Written."""
    bounded_batches(benchmark.sparkSession)
    placed = positions(pieces(benchmark, window), [], ["item", "words"], "leak-order").withColumn(
        "block", F.floor(F.col("pos") / PIECES))

    def build(table: pa.Table) -> pa.Table:
        ids = sorted(set(table.column("item").to_pylist()))
        number = {x: i for i, x in enumerate(ids)}
        built = Automaton([(number[i], w.split()) for i, w in zip(
            table.column("item").to_pylist(), table.column("words").to_pylist())], window)
        return pa.table({"block": table.column("block")[:1], "built": pa.array([pickle.dumps((built, ids))], pa.binary())})

    return written(placed.select("block", "item", "words").groupBy("block").applyInArrow(
        build, "block long, built binary"), "leak-automata")


def _key() -> Column:
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|"),
                          F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary"))


_SPANS = "array<struct<start:long,end:long>>"


def hits(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """doc_id, key (of id and text), n_words, spans (hit words: first, behind the last; disjoint, ascending) and items
    (ids of the items with an occurring window), a row per document."""
    spark = docs.sparkSession
    built = automata(benchmark, window)
    blocks = sorted(r[0] for r in built.select("block").collect()) or [None]  # one number per PIECES pieces
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scanned(block: int | None) -> DataFrame:
        load = pickle.dumps((Automaton([], window), [])) if block is None else bytes(
            built.where(F.col("block") == block).first()["built"])
        sent = spark.sparkContext.broadcast(load)
        first = block in (None, blocks[0])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton, ids = pickle.loads(sent.value)
            for batch in batches:
                rows = [automaton.scan(t.as_py()) for t in batch.column(2)]
                kept = [i for i, r in enumerate(rows) if first or r[1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(kept, pa.int64())), batch.column(1).take(pa.array(kept, pa.int64())),
                     pa.array([rows[i][0] for i in kept], pa.int64()),
                     pa.array([[{"start": a, "end": b} for a, b in rows[i][1]] for i in kept], kind),
                     pa.array([[ids[k] for k in rows[i][2]] for i in kept], pa.list_(pa.string()))],
                    names=["doc_id", "key", "n_words", "spans", "items"])

        return map_batches(texts, run, f"doc_id long, key string, n_words long, spans {_SPANS}, items array<string>")

    first = scanned(blocks[0])
    if len(blocks) == 1:
        return first
    more = None
    for block in blocks[1:]:  # each pass is written, so one automaton at a time is in memory
        part = written(scanned(block).select("key", "spans", "items").dropDuplicates(["key"]), "leak-hits")
        more = part if more is None else more.union(part)
    more = more.groupBy(F.col("key").alias("_k")).agg(F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(
        F.collect_list("items")).alias("_items"))
    whole = first.join(more, F.col("key") == F.col("_k"), "left")
    spans = F.concat("spans", F.coalesce("_spans", F.array().cast(_SPANS)))
    return whole.select("doc_id", "key", "n_words", _united(spans).alias("spans"), F.array_distinct(
        F.concat("items", F.coalesce("_items", F.array().cast("array<string>")))).alias("items"))


def _united(spans: Column) -> Column:
    """Spans sorted and joined where they touch."""
    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (last["end"] >= x["start"])
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS), add)


def _n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    rows = hits(docs, benchmark)
    ids = F.array_join(F.array_sort(F.array_distinct("items")), ",")
    return rows.select("doc_id", "n_words", _n_hit(F.col("spans")).alias("n_hit"), F.size(F.array_distinct("items")).cast(
        "long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them; lengths are those of the UTF-8 text."""
    data = text.encode("utf-8")
    flat, out, at, seen, k = data.translate(_NORMAL), [], 0, 0, 0
    pos = 0
    while k < len(spans) and pos < len(flat):
        while pos < len(flat) and flat[pos] == 32:
            pos += 1
        end = flat.find(b" ", pos)
        end = len(flat) if end < 0 else end
        if seen == spans[k][0]:
            out.append(data[at:pos])
        if seen == spans[k][1] - 1:
            at, k = end, k + 1
        seen, pos = seen + 1, end
    return b"".join([*out, data[at:]]).decode("utf-8")


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, min_words: int = MIN_WORDS,
                   coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without hit spans of ``min_words`` or more, and without documents hit beyond ``coverage`` of their words.

    ``text`` and ``n_chars``, where there is one, are renewed; all other columns are passed on."""
    names = docs.columns
    k, s, n, key = free_names(names, "_leak_key", "_leak_spans", "_leak_words", "_leak_key2")
    found = written(hits(docs, benchmark, window=window).where(F.size("spans") > 0).dropDuplicates(["key"]), "leak-found")
    found = found.select(F.col("key").alias(k), F.col("n_words").alias(n), F.col("spans").alias(s))
    both = docs.withColumn(key, _key()).join(found, F.col(key) == F.col(k), "left")
    share = _n_hit(F.col(s)) / F.col(n)
    both = both.where(F.coalesce(share <= F.lit(coverage), F.lit(True))).select(*names, F.filter(
        s, lambda x: x["end"] - x["start"] >= min_words).alias(s))
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:-1]
            cuts = batch.column(len(names)).to_pylist()
            texts = [t if not c else without(t, [(x["start"], x["end"]) for x in c]) for t, c in zip(
                columns[at].to_pylist(), cuts)]
            columns[at] = pa.array(texts, columns[at].type)
            if chars is not None:
                columns[chars] = pa.array([len(t) if c else o for t, c, o in zip(
                    texts, cuts, columns[chars].to_pylist())], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(both, run, docs.schema)


ORACLE = r"""
with norm as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct coalesce(item_id::varchar, 'null') as item, least(len(w), 10) as m,
         array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as g
  from items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as t(i) where len(w) > 0),
sizes as (select distinct m from windows),
grams as (
  select r, i, m, array_to_string(list_slice(w, i, i + m - 1), ' ') as g
  from norm, sizes, unnest(range(1, len(w) - m + 2)) as t(i) where len(w) >= m),
found as (select distinct r, i, m, item from grams join windows using (m, g)),
words as (select r, count(*) as n_hit from (select distinct r, unnest(range(i, i + m)) as p from found) group by r),
ids as (select r, count(*) as n_items, string_agg(item, ',' order by item) as listed
        from (select distinct r, item from found) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from norm left join words using (r) left join ids using (r)
"""
