"""Personal data: direct identifiers by pattern, then terms that give them away by information.

Base kinds (email, ip, card, phone) are found leftmost and non-overlapping per kind and then checked (parts at
most 255, Luhn, digit counts). Information-theoretic sanitisation follows: each found identifier is a protected
entity and the ``WINDOW`` words on either side, however long, are its terms. Over the whole corpus

    n(t, e) = texts with a window of e that holds t,  n(t) = texts that hold t,  n(e) = texts that hold e,

all over distinct texts. P(e | t) = n(t, e) / n(t), and a term's information about an entity is log2(P(e | t) / P(e)).
A term discloses an entity if it exceeds ``SHARE`` and ``BITS``, and one of these backs the estimate:

* support: it was seen with the entity in at least ``SUPPORT`` distinct windows;
* significance, for entities named in few texts: two distinct windows, and n(t) KL(P(e | t) || P(e)) of at least
  ln(pairs / ``CHANCE``), a bound on such a meeting among all pairs of the corpus by chance;
* the entity's own name: a part of an address's local part that stands as a word in a text of that address, outside of
  identifiers. A name needs no support: its estimate is smoothed, (n(t, e) + 1) / (n(t) + 2).

Such a term's places beside that entity become spans of kind ``term``, or with ``everywhere`` (as the registered query
and the pipeline ask) all its places in all texts, with or without the entity; ``sanitised`` generalises base spans to
their kind and removes disclosing terms behind a neutral mark. Copies of a passage are one window and copies of a
text count once, so a text copied a thousand times is neither evidence nor weighs against it.

Scale: one pass finds identifiers, windows and names (slim rows), one pass counts, in each task, the words that any
window or name holds; only texts that may have a copy (a broadcast bitmap of 1 MB tells) are brought together first, by
hash. Everything else is joins and sums of slim rows. A frequent entity or term is a sum that partial aggregation
shrinks first. ``everywhere`` reads the texts once more: words whose hash meets a bitmap of the disclosing terms, of
``_SLOTS`` bits whatever their number, are joined to them exactly. ``sanitised`` joins places only to documents that may
have some. Matching is linear in the text's length.

Defined results: NULL text is empty text without spans; repeated rows get the same spans; an empty table gives no
rows; other columns are ignored (``digest``) or passed on (``sanitised``).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, map_batches, maybe_in, written

KINDS = ("email", "ip", "card", "phone")
WINDOW = 8
SUPPORT = 3
CHANCE = 0.01
SHARE = 0.5
BITS = 3.0
_SLOTS = 1 << 20
_FLUSH = 400_000  # distinct words a task counts before it passes them on

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits is entered at its first digit: a match from inside would also match from there.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]{2,}")
_NAME = re.compile(r"[^\W\d_]{3,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            yield begin, free
        else:
            free = at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points, end exclusive."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def _hash(value: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(value.encode("utf-8")) - (1 << 63)


def _words_before(text: str, at: int) -> list[tuple[int, int]]:
    """Places of the last ``WINDOW`` words before ``at``, looked for in ever larger stretches."""
    reach = 64
    while True:
        low = max(0, at - reach)
        found = [m.span() for m in _TERM.finditer(text, low, at)]
        if low and found and found[0][0] == low:  # perhaps the end of a word that begins before
            found = found[1:]
        if len(found) >= WINDOW or not low:
            return found[-WINDOW:]
        reach *= 4


def _entity(kind: str, value: str) -> int:
    name = value.lower() if kind == "email" else "".join(c for c in value if c.isdigit() or c == "." and kind == "ip")
    return _hash(f"{kind}:{name}")


def windows(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """The words beside each entity: entity, term and window as hashes, and the term's place."""
    out = []
    ordered = sorted((a, b) for _, a, b in spans)
    starts, ends = [a for a, _ in ordered], []
    for _, b in ordered:  # the farthest end of all spans up to each start
        ends.append(max(b, ends[-1]) if ends else b)
    for kind, a, b in spans:
        entity = _entity(kind, text[a:b])
        right = [m.span() for m in islice(_TERM.finditer(text, b), WINDOW)]
        near = []
        for p in _words_before(text, a) + right:
            k = bisect_left(starts, p[1])  # spans that begin before the word ends
            if not (k and ends[k - 1] > p[0]):
                near.append(p)
        terms = [text[s:e].lower() for s, e in near]
        window = _hash(" ".join(terms))
        out += [{"entity": entity, "term": _hash(t), "window": window, "start": s, "end": e}
                for t, (s, e) in zip(terms, near)]
    return out


def own_names(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Name parts of the text's addresses that also stand as words outside of identifiers: entity, term and place."""
    names = {}
    for kind, a, b in spans:
        if kind == "email":
            for part in _NAME.findall(text[a:b].partition("@")[0].lower()):
                names.setdefault(part, set()).add(_entity(kind, text[a:b]))
    if not names:
        return []
    told = [(text[a:b].lower(), a, b) for a, b in _free_words(text, spans) if text[a:b].lower() in names]
    return [{"entity": e, "term": _hash(t), "start": a, "end": b} for t, a, b in told for e in sorted(names[t])]


def _free_words(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Words outside of ``spans``, one pass over both."""
    ordered, at, end = sorted((a, b) for _, a, b in spans), 0, 0
    for m in _TERM.finditer(text):
        while at < len(ordered) and ordered[at][0] < m.end():
            end, at = max(end, ordered[at][1]), at + 1
        if end <= m.start():
            yield m.span()


def _key() -> Column:
    """Names a row by what decides its spans: id and text."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|"),
                          F.coalesce(F.col("text"), F.lit(""))).cast("binary"))


def _text_key(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))


def found(docs: DataFrame) -> DataFrame:
    """One slim row per document, written: key, text_key (equal for copies), doc_id, counts, base spans, the entities'
    windows and names."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    near = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("window", pa.int64()),
                               ("start", pa.int64()), ("end", pa.int64())]))
    names = pa.list_(pa.struct([(c, pa.int64()) for c in ("entity", "term", "start", "end")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, around, named = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                spans.append(base_spans(text))
                around.append(windows(text, spans[-1]))
                named.append(own_names(text, spans[-1]))
            listed = [",".join([f"{k}:{a}:{b}" for k, a, b in s]) for s in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3),
                 *[pa.array([sum(k == kind for k, _, _ in s) for s in spans], pa.int64()) for kind in KINDS],
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]), pa.array(listed),
                 pa.array(around, near), pa.array(named, names)],
                names=["doc_id", "key", "text_key", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "near", "names"])

    schema = ("doc_id long, key string, text_key string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
              "base string, near array<struct<entity:long,term:long,window:long,start:long,end:long>>, "
              "names array<struct<entity:long,term:long,start:long,end:long>>")
    return written(map_batches(slim.withColumn("key", _key()).withColumn("text_key", _text_key("text")), run, schema), "pii-found")


def _slots(terms: DataFrame) -> np.ndarray:
    """A bitmap of the terms' hashes, _SLOTS entries whatever their number."""
    slots = np.zeros(_SLOTS, bool)
    taken = terms.select(F.pmod("term", F.lit(_SLOTS)).alias("slot")).distinct().toArrow().column(0)  # _SLOTS at most
    slots[taken.to_numpy()] = True
    return slots


def term_counts(docs: DataFrame, needed: DataFrame | None = None) -> DataFrame:
    """term (hash), documents: in how many distinct texts each word occurs; every word of every text counts, or those in
    ``needed`` (term) and some others.

    Copies are told by their hash. Texts that certainly have none stay where they are; the rest are brought together, one
    each."""
    slots = None if needed is None else _slots(needed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        counts: dict[str, int] = {}
        skipped: set[str] = set()

        def asked(term: str) -> bool:
            if term in counts:
                return True
            if term in skipped:
                return False
            if slots is None or slots[_hash(term) % _SLOTS]:
                return True
            if len(skipped) > _FLUSH:
                skipped.clear()
            skipped.add(term)
            return False

        def passed_on() -> pa.RecordBatch:
            terms = np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8")) for t in counts), np.uint64, len(counts))
            signed = (terms ^ np.uint64(1 << 63)).view(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array(signed), pa.array(counts.values(), pa.int64())], names=["term", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                for term in set(_TERM.findall((text.as_py() or "").lower())):
                    if asked(term):
                        counts[term] = counts.get(term, 0) + 1
            if len(counts) > _FLUSH:
                yield passed_on()
        yield passed_on()

    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    keys = texts.select(_text_key("text").alias("text_key"))
    copied = written(keys.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1").select("text_key"), "pii-copied")
    told = maybe_in(texts.withColumn("text_key", _text_key("text")), F.col("text_key"), copied, "copied")
    one_each = told.where("copied").groupBy("text_key").agg(F.first("text").alias("text"))
    texts = told.where("not copied").select("text").union(one_each.select("text"))
    return map_batches(texts, run, "term long, n long").groupBy("term").agg(F.sum("n").alias("documents"))


def disclosing(rows: DataFrame, docs: DataFrame, *, support: int = SUPPORT, share: float = SHARE, bits: float = BITS,
               counts: DataFrame | None = None) -> DataFrame:
    """(entity, term) pairs in which the term gives the entity away, backed by ``support`` windows."""
    rated = _rated(rows, docs, counts)
    return rated.where((F.col("windows") >= support) & _exceeds(rated["p"], rated["prior"], share, bits)).select("entity", "term")


def _exceeds(p: Column, prior: Column, share: float, bits: float) -> Column:
    return (p >= share) & (F.log2(p / prior) >= bits)


def _rated(rows: DataFrame, docs: DataFrame, counts: DataFrame | None) -> DataFrame:
    """entity, term, windows, n_t, p = P(e | t) and prior = P(e) of all pairs with two windows or more."""
    seen = rows.select("text_key", F.explode("near").alias("w")).select("text_key", "w.entity", "w.term", "w.window")
    backed = seen.select("entity", "term", "window").distinct().groupBy("entity", "term").agg(
        F.count("*").alias("windows")).where(F.col("windows") >= 2)
    pairs = seen.select("entity", "term", "text_key").distinct().groupBy("entity", "term").agg(
        F.count("*").alias("n")).join(backed, ["entity", "term"])
    entities = seen.select("entity", "text_key").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    total = max(1, rows.select("text_key").distinct().count())
    counts = term_counts(docs, backed.select("term")) if counts is None else counts
    return pairs.join(counts, "term").join(entities, "entity").select(
        "entity", "term", "windows", F.greatest("documents", "n").alias("n_t"),
        (F.col("n") / F.greatest("documents", "n")).alias("p"), (F.col("n_e") / F.lit(total)).alias("prior"))


def significant(rows: DataFrame, docs: DataFrame, *, share: float = SHARE, bits: float = BITS, chance: float = CHANCE,
                counts: DataFrame | None = None) -> DataFrame:
    """(entity, term) pairs of any support from two windows on that chance would hardly bring about among all pairs."""
    rated = _rated(rows, docs, counts)
    tried = max(1, rows.select(F.explode("near").alias("w")).select("w.entity", "w.term").distinct().count())
    p, q = rated["p"], rated["prior"]
    rest = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - q))).otherwise(0.0)
    nats = rated["n_t"] * (p * F.log(p / q) + rest)
    return rated.where(_exceeds(p, q, share, bits) & (q < 1) & (nats >= math.log(tried / chance))).select("entity", "term")


def named(rows: DataFrame, docs: DataFrame, *, share: float = SHARE, bits: float = BITS,
          counts: DataFrame | None = None) -> DataFrame:
    """(entity, term) pairs in which the term is part of the entity's name and stands in its texts as a word."""
    own = rows.select("text_key", F.explode("names").alias("w")).select("text_key", "w.entity", "w.term").distinct()
    pairs = own.groupBy("entity", "term").agg(F.count("*").alias("n"))
    entities = rows.select("text_key", F.explode("near.entity").alias("entity")).union(own.select("text_key", "entity"))
    entities = entities.distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    total = max(1, rows.select("text_key").distinct().count())
    counts = term_counts(docs, pairs.select("term")) if counts is None else counts
    rated = pairs.join(counts, "term").join(entities, "entity")
    p = (F.col("n") + 1) / (F.greatest("documents", "n") + 2)
    return rated.where(_exceeds(p, F.col("n_e") / F.lit(total), share, bits)).select("entity", "term")


def all_disclosing(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs of ``disclosing``, ``significant`` and ``named``, from one count of the words any of them needs."""
    terms = rows.select(F.explode(F.concat("near.term", "names.term")).alias("term")).distinct()
    counts = written(term_counts(docs, terms), "pii-counts")
    return disclosing(rows, docs, counts=counts).union(significant(rows, docs, counts=counts)).union(
        named(rows, docs, counts=counts)).distinct()


def term_spans(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """key, terms: the places of disclosing terms beside their entity, and of its names in its texts, sorted; only for
    documents that have any."""
    held = F.concat(F.transform("near", lambda w: F.struct(*[w[c].alias(c) for c in ("entity", "term", "start", "end")])), "names")
    near = rows.where(F.size(held) > 0).select("key", F.explode(held).alias("w")).select("key", "w.*")
    places = near.join(pairs, ["entity", "term"], "left_semi").select("key", "start", "end").distinct()
    return places.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("terms"))


def all_places(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """key, terms: every place of a disclosing term in any text, but for places inside base spans, sorted; only for
    documents that have any."""
    terms = written(pairs.select("term").distinct(), "pii-terms")
    slots = _slots(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int | None] = {}

        def term_of(word: str) -> int | None:
            if word not in known:
                if len(known) > _FLUSH:
                    known.clear()
                term = _hash(word.lower())
                known[word] = term if slots[term % _SLOTS] else None
            return known[word]

        for batch in batches:
            out: dict[tuple[str, int], list[dict]] = {}
            room = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                hits = {w: t for w in set(_TERM.findall(text)) if (t := term_of(w)) is not None}
                if not hits:
                    continue
                here: dict[int, list[dict]] = {}
                for a, b in _free_words(text, base_spans(text)):
                    if text[a:b] in hits:
                        here.setdefault(hits[text[a:b]], []).append({"start": a, "end": b})
                out |= {(key, t): places for t, places in here.items()}  # a repeated row has the same places
                room += sum(map(len, here.values()))
                if room > _FLUSH:
                    yield placed(out)
                    out, room = {}, 0
            yield placed(out)

    def placed(out: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in out], pa.string()), pa.array([t for _, t in out], pa.int64()),
             pa.array(list(out.values()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["key", "term", "places"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    places = map_batches(texts.where("text is not null").select(_key().alias("key"), "text"), run,
                         "key string, term long, places array<struct<start:long,end:long>>")
    places = places.join(terms, "term", "left_semi").groupBy("key", "term").agg(F.first("places").alias("places"))
    return places.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("terms"))


def _marked(docs: DataFrame, rows: DataFrame, everywhere: bool) -> DataFrame:
    pairs = written(all_disclosing(rows, docs), "pii-pairs")
    return all_places(docs, pairs) if everywhere else term_spans(rows, pairs)


def digest(docs: DataFrame, *, everywhere: bool = False) -> DataFrame:
    rows = found(docs)
    terms = _marked(docs, rows, everywhere).withColumnRenamed("key", "_k")
    extra = F.transform("terms", lambda t: F.concat(F.lit("term:"), t["start"], F.lit(":"), t["end"]))
    spans = F.array_join(F.filter(F.concat(F.array("base"), F.coalesce(extra, F.array().cast("array<string>"))),
                                  lambda x: x != ""), ",")
    return rows.join(terms, rows["key"] == terms["_k"], "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("spans"))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Spans replaced by their kind in capitals; overlapping spans become one mark, the first's."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, kind) for kind, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, *, everywhere: bool = False) -> DataFrame:
    """``docs`` with identifiers and disclosing terms replaced in ``text`` (and ``n_chars``, where there is one, renewed)."""
    names = docs.columns
    rows = found(docs)
    key, k, t, flag = free_names(names, "_pii_key", "_pii_key_", "_pii_terms", "_pii_flag")
    terms = written(_marked(docs, rows, everywhere), "pii-marked").select(F.col("key").alias(k), F.col("terms").alias(t))
    keyed = maybe_in(docs.withColumn(key, _key()), F.col(key), terms.select(k), flag)
    marked = keyed.where(F.col(flag)).join(terms, F.col(key) == F.col(k), "left").select(*names, t)
    keyed = keyed.where(~F.col(flag)).select(*names, F.lit(None).cast(terms.schema[t].dataType).alias(t)).union(marked)
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lengths = [], []
            for text, places in zip(batch.column(at), batch.column(len(names)).to_pylist()):
                text = text.as_py()
                spans = base_spans(text or "") + [("term", p["start"], p["end"]) for p in places or ()]
                texts.append(redact(text, spans) if spans else text)
                lengths.append(len(texts[-1]) if spans else None)
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if chars is not None:
                old = columns[chars].to_pylist()
                columns[chars] = pa.array([o if n is None else n for o, n in zip(old, lengths)], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(keyed, run, docs.schema)
