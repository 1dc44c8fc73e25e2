"""Exact removal of repeated byte strings by sampled induced suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere is removed, in whatever document. The
strings are suffixes compared to LENGTH bytes, and the order is built as induced sorting builds it: sample suffixes
are named and sorted first, and the suffixes in front of them are induced from those by one preceding byte at a
time, tuples (byte, rank) carrying the common-prefix (LCP) values along.

* Sampling. Of the grams of ``GRAM`` bytes inside a string the one with the smallest hash (rightmost of equals) is
  its anchor. Equal strings have equal anchors at equal offsets, so only starts with the same gram can match. The
  starts with one anchor form a range; anchors are some 137 bytes apart.
* Naming. An anchor's stretch (all bytes its starts can see) is named by a hash. Stretches of the same name are
  duplicates as a whole, and one of them stands for all. Grams with one stretch are done; neither needs text.
* Sorting and induction. What is left is grams with several stretches. Spark sorts their suffixes from the anchor
  (an external sort that spills), then a task takes the groups in blocks: neighbours' LCPs are measured once and
  induced ``RANGE`` steps to the left, dropping suffixes that can no longer reach LENGTH common bytes.
* A gram with more than ``HOT`` distinct stretches is not put into one task: its strings are compared by their
  hashes in a distributed count, one row per start.

The published form of the method (disk-backed queues that pop one suffix at a time) cannot meet the limits in
Python; the README has the figures. Here Spark's sort and shuffle files are the external memory, and recursion has
one level, since stretches are short. Names are 64-bit hashes that only need to differ within a gram's group.

Defined results: NULL text is empty; texts below LENGTH bytes lose nothing; repeated rows are copies of each other;
matches overlap freely, also inside one document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches, written

LENGTH = 400
GRAM = 128
HOT = 4096
CHUNK = 1 << 20  # bytes parsed at a time
_PLACE = 24  # low bits of a gram's key that hold its place

_ROOT = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=4)
def _powers(n: int, root: int) -> tuple[np.ndarray, np.ndarray]:
    """root^k and its inverse modulo 2^64 for k < n."""
    out = []
    for r in (root, pow(root, -1, 1 << 64)):
        steps = np.full(n, r, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Hashes:
    """Hashes of any substring of ``data``: sums of spread bytes times powers, shifted back to the start."""

    def __init__(self, data: np.ndarray, root: int = int(_ROOT)):
        size = 4096 if len(data) < 4096 else max(2 * CHUNK, 1 << int(len(data)).bit_length())  # few sizes, kept
        power, self.inverse = _powers(size, root)
        with np.errstate(over="ignore"):
            self.upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SPREAD[data] * power[:len(data)], dtype=np.uint64)))

    def of(self, start, stop) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.upto[stop] - self.upto[start]) * self.inverse[start])


def _smallest(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks to both sides."""
    n = len(key) - width + 1
    full = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:len(key)] = key
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def parse(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchors of a few texts: (text number, anchor, nearest, farthest, gram hash, stretch hash).

    Starts of the anchor's strings lie ``nearest`` to ``farthest`` bytes before it."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < length:
        return none
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    begin = np.flatnonzero(np.arange(len(data)) + length <= ends[doc])  # strings never cross texts
    if not len(begin):
        return none
    hashes = Hashes(data)
    at = np.arange(len(data) - gram + 1)
    names = hashes.of(at, at + gram)
    low = np.uint64((1 << _PLACE) - 1)
    key = (names & ~low) | (low - at.astype(np.uint64))  # the later of equals is smaller
    least = _smallest(key, length - gram + 1)[begin]
    anchor = (low - (least & low)).astype(np.int64)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[begin[1:]] != doc[begin[:-1]])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(begin)])) - 1
    i0, i1, a = begin[first], begin[last], anchor[first]
    stretch = hashes.of(i0, i1 + length)
    shift = ends - sizes
    return (doc[i0], a - shift[doc[i0]], a - i1, a - i0, names[a].view(np.int64), _named(stretch, a - i1, a - i0))


def _named(stretch: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(stretch + (nearest * 1024 + farthest).astype(np.uint64) * _ROOT).view(np.int64)


def parse_long(text: bytes, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK) -> tuple[np.ndarray, ...]:
    """``parse`` of one text a chunk at a time; ranges that a chunk's border cuts are joined again."""
    parts = []
    for at in range(0, max(1, len(text) - length + 1), chunk):
        _, a, near, far, g, name = parse([text[at:at + chunk + length - 1]], length, gram)
        a = a + at
        if parts and len(a) and len(parts[-1][0]) and parts[-1][0][-1] == a[0]:
            before = parts[-1]
            far[0] = before[2][-1]
            parts[-1] = tuple(x[:-1] for x in before)
            whole = np.frombuffer(text[a[0] - far[0]:a[0] - near[0] + length], np.uint8)
            name[:1] = _named(Hashes(whole).of(np.array([0]), np.array([len(whole)])), near[:1], far[:1])
        parts.append((a, near, far, g, name))
    a, near, far, g, name = (np.concatenate(x) for x in zip(*parts))
    return np.zeros(len(a), np.int64), a, near, far, g, name


# ---- induction inside a block of groups


def induced(group: np.ndarray, right: list[bytes], left: list[bytes], nearest: np.ndarray, farthest: np.ndarray,
            length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For every suffix the distances l (as closed ranges) at which the ``length`` bytes from l before its anchor occur
    with another suffix of its group.

    ``right``: up to ``length`` bytes from the anchor on; ``left``: bytes before it, nearest last. Rows come sorted
    by (group, right)."""
    n = len(group)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n < 2:
        return out
    size = np.array([len(r) for r in right])
    text = np.zeros((n, length), np.int16)  # bytes from 1, 0 after the end
    for i, r in enumerate(right):
        text[i, :len(r)] = np.frombuffer(r, np.uint8)[:length].astype(np.int16) + 1
    differ = text[1:] != text[:-1]
    common = np.where(differ.any(1), differ.argmax(1), length)
    common = np.minimum(common, np.minimum(size[1:], size[:-1]))
    # lcp[k]: common bytes of the suffixes at ranks k - 1 and k; -1 between groups
    lcp = np.concatenate(([-1], np.where(group[1:] == group[:-1], common, -1))).astype(np.int32)
    steps = int(farthest.max()) + 1
    before = np.zeros((n, steps), np.int16)
    for i, x in enumerate(left):
        x = np.frombuffer(x, np.uint8)[::-1][:steps].astype(np.int16) + 1
        before[i, :len(x)] = x
    row = np.arange(n)  # suffix at each rank
    hits = np.zeros((n, steps), bool)
    for l in range(steps):
        if l:  # induce: order by (group, byte in front, rank); a stable sort keeps the ranks
            front = before[row, l - 1]
            order = np.lexsort((front, group[row]))
            moved = row[order]
            same = np.concatenate(([False], (group[moved[1:]] == group[moved[:-1]]) & (front[order[1:]] == front[order[:-1]])))
            low, high = order[:-1] + 1, order[1:] + 1
            pairs = np.flatnonzero(same[1:])
            fresh = np.full(len(order), -1, np.int32)
            if len(pairs):
                ranges = np.stack([low[pairs], high[pairs]], 1).ravel()
                fresh[pairs + 1] = np.minimum.reduceat(np.concatenate((lcp, [length + 1])), ranges)[::2] + 1
            row, lcp = moved, fresh
        found = lcp >= length
        if found.any():
            hits[row[found], l] = True
            hits[row[np.flatnonzero(found) - 1], l] = True
        # a suffix stays while some neighbour can still reach the length by the last step either may take
        nearby = np.maximum(lcp, np.concatenate((lcp[1:], [-1])))
        stay = (nearby >= 0) & (nearby + farthest[row] - l >= length) & (farthest[row] > l)
        if not stay.all():
            kept = np.flatnonzero(stay)
            if len(kept) < 2:
                break
            low, high = kept[:-1] + 1, kept[1:] + 1
            least = np.minimum.reduceat(np.concatenate((lcp, [length + 1])), np.stack([low, high], 1).ravel())[::2]
            row, lcp = row[kept], np.concatenate(([-1], least)).astype(np.int32)
    for i in np.flatnonzero(hits.any(1)).tolist():
        at = np.flatnonzero(hits[i])
        at = at[(at >= nearest[i]) & (at <= farthest[i])]
        cut = np.flatnonzero(np.diff(at) > 1)
        for s, e in zip(np.concatenate(([0], cut + 1)).tolist(), np.concatenate((cut, [len(at) - 1])).tolist()):
            if len(at):
                out[i].append((int(at[s]), int(at[e])))
    return out


# ---- the distributed part

_CLASS = ["gram", "name"]
#: Bits of the filter that keeps texts nothing is wanted from out of a shuffle (1 MB at any size; where it fills up,
#: more texts are shuffled and the result is the same).
FILTER_BITS = 1 << 23


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, mark, text: the mark (31 bits of the text's hash) tells texts under one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.pmod(F.xxhash64("text"), F.lit(1 << 31)).cast("int").alias("mark"), "text")


def _slot() -> Column:
    return F.pmod(F.xxhash64("doc_id", "mark"), F.lit(FILTER_BITS)) + 1


def _flagged(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``keyed`` with ``flag``, false only where (doc_id, mark) is not in ``wanted``; the filter is broadcast."""
    bits = wanted.select(_slot().alias("b")).groupBy(F.bitmap_bucket_number("b").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("_bits"))
    at = F.bitmap_bit_position(_slot())
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 + 1 as int), 1)")), 16, 10).cast("int")
    found = keyed.withColumn("_at", at).join(F.broadcast(bits), F.bitmap_bucket_number(_slot()) == F.col("_bucket"), "left")
    flag = F.coalesce(F.getbit(byte, F.pmod("_at", F.lit(8)).cast("int")) == 1, F.lit(False))
    return found.select(*keyed.columns, flag.alias("flag"))


def _part(shift: int, width: int) -> Column:
    """A field of ``place``."""
    return F.shiftrightunsigned("place", shift).bitwiseAND(F.lit((1 << width) - 1))


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, mark, gram, name, place (anchor, nearest and farthest in one number): a row per anchor, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column(2)]
            jobs: list[list[int]] = [[]]
            room = 0
            for i, t in enumerate(texts):
                if len(t) < LENGTH:
                    continue
                if len(t) > CHUNK:
                    jobs.insert(0, [i])
                    continue
                if room + len(t) > CHUNK:
                    jobs.append([])
                    room = 0
                jobs[-1].append(i)
                room += len(t)
            for job in jobs:
                if not job:
                    continue
                long = len(texts[job[0]]) > CHUNK
                doc, a, near, far, g, name = parse_long(texts[job[0]]) if long else parse([texts[i] for i in job])
                of = pa.array(np.array(job)[doc])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of), pa.array(g), pa.array(name),
                     pa.array(a << 20 | near << 10 | far)], names=["doc_id", "mark", "gram", "name", "place"])

    rows = written(map_batches(_keyed(docs), run, "doc_id long, mark int, gram long, name long, place long"), "suffix-anchors")
    # a gram that occurs once matches nothing; most are dropped here, before anything else is shuffled
    # (written, so that the join shuffles both sides itself and Spark may split a gram that many rows share)
    often = written(rows.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "suffix-often")
    kept = written(rows.join(often, "gram", "left_semi"), "suffix-shared")
    return kept.select("doc_id", "mark", *_CLASS, _part(20, 43).alias("anchor"), _part(10, 10).cast("int").alias("nearest"),
                       _part(0, 10).cast("int").alias("farthest"))


def _fetched(docs: DataFrame, wanted: DataFrame, hot: DataFrame) -> DataFrame:
    """The bytes of ``wanted`` stretches (gram, name, nearest, farthest, left, right) and, for grams in ``hot``, a row
    per start (distance, string: hash) instead; written."""
    parts = wanted.join(hot.select("gram", F.lit(True).alias("hot")), "gram", "left").groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("gram", "name", "anchor", "nearest", "farthest", F.coalesce("hot", F.lit(False)).alias(
            "hot"))).alias("parts")).withColumnsRenamed({"doc_id": "_d", "mark": "_m"})
    keyed = _flagged(_keyed(docs), wanted.select("doc_id", "mark")).where("flag")
    both = keyed.join(parts, keyed["doc_id"].eqNullSafe(F.col("_d")) & (keyed["mark"] == F.col("_m"))).select("text", "parts")
    names = ["gram", "name", "nearest", "farthest", "left", "right", "distance", "string"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, found in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                for p in found.as_py():
                    a, near, far = p["anchor"], p["nearest"], p["farthest"]
                    if not p["hot"]:
                        out.append((p["gram"], p["name"], near, far, text[a - far:a], text[a:a + LENGTH], None, None))
                    else:
                        part = np.frombuffer(text[a - far:a - near + LENGTH], np.uint8)
                        s = np.arange(far - near + 1)
                        out += [(p["gram"], p["name"], None, None, None, None, far - int(k), int(h)) for k, h in
                                zip(s, Hashes(part, 0xD6E8FEB86659FD93).of(s, s + LENGTH).view(np.int64))]
                if len(out) > 8192:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    schema = ("gram long, name long, nearest int, farthest int, left binary, right binary, distance int, string long")
    return written(map_batches(both, run, schema), "suffix-stretches")


def _partly(docs: DataFrame, wanted: DataFrame, hot: DataFrame) -> DataFrame:
    """gram, name, ranges: the distances at which a stretch's strings occur under another name of its gram."""
    fetched = _fetched(docs, wanted, hot)
    kind = pa.list_(pa.struct([("near", pa.int32()), ("far", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def solved(t: pa.Table) -> pa.RecordBatch:
            g, near, far = (t.column(c).to_numpy() for c in ("gram", "nearest", "farthest"))
            found = induced(g, t.column("right").to_pylist(), t.column("left").to_pylist(), near, far)
            some = [i for i, r in enumerate(found) if r]
            return pa.RecordBatch.from_arrays(
                [pa.array(g[some], pa.int64()), pa.array(t.column("name").to_numpy()[some], pa.int64()),
                 pa.array([[{"near": a, "far": b} for a, b in found[i]] for i in some], kind)], names=["gram", "name", "ranges"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            if t.num_rows < HOT:
                rest = t
                continue
            g = t.column("gram").to_numpy()
            whole = int(np.searchsorted(g, g[-1]))  # the last gram may go on in the next batch
            if whole:
                yield solved(t.slice(0, whole))
            rest = t.slice(whole)
        if rest is not None and rest.num_rows:
            yield solved(rest)

    bounded_batches(docs.sparkSession)
    ordinary = fetched.where("string is null").select(
        "gram", "name", "nearest", "farthest", "left", "right").dropDuplicates(_CLASS)
    sorted_ = ordinary.repartition("gram").sortWithinPartitions("gram", "right", "name")
    schema = "gram long, name long, ranges array<struct<near:int,far:int>>"
    cool = sorted_.mapInArrow(run, schema)
    each = fetched.where("string is not null").select(*_CLASS, "distance", "string").distinct()
    again = each.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    warm = each.join(again, "string", "left_semi").groupBy(*_CLASS).agg(F.collect_list(F.struct(
        F.col("distance").alias("near"), F.col("distance").alias("far"))).alias("ranges"))
    return cool.union(warm)


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, mark, spans: the byte ranges of strings to remove, overlaps included; only for documents that have any."""
    rows = anchors(docs)
    named = written(rows.groupBy(*_CLASS).agg(F.count("*").alias("n"), F.min(F.struct(
        "doc_id", "mark", "anchor", "nearest", "farthest")).alias("one")), "suffix-names")
    several = written(named.groupBy("gram").agg(F.count("*").alias("names")).where("names > 1"), "suffix-several")
    wanted = named.join(several, "gram", "left_semi").select(*_CLASS, "one.*")
    partly = _partly(docs, wanted, several.where(F.col("names") > HOT))
    whole = named.where("n > 1").select(*_CLASS, F.lit(None).cast("array<struct<near:int,far:int>>").alias("ranges"))
    verdicts = whole.union(partly.join(whole.select(*_CLASS), _CLASS, "left_anti"))
    every = F.array(F.struct(F.col("nearest").alias("near"), F.col("farthest").alias("far")))
    spans = F.transform(F.coalesce("ranges", every), lambda r: F.struct(
        (F.col("anchor") - r["far"]).alias("start"), (F.col("anchor") - r["near"] + LENGTH).alias("end")))
    return rows.join(verdicts, _CLASS).select("doc_id", "mark", F.explode(spans).alias("s")).groupBy("doc_id", "mark").agg(
        F.collect_list("s").alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted, disjoint, not touching."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def deduplicated(docs: DataFrame, *, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, ``with_bytes``, the remaining bytes ``kept``."""
    cut = written(removed(docs), "suffix-spans")
    keyed = _flagged(_keyed(docs), cut)
    named = cut.withColumnsRenamed({"doc_id": "_d", "mark": "_m"})
    concerned = keyed.where("flag").join(
        named, keyed["doc_id"].eqNullSafe(F.col("_d")) & (keyed["mark"] == F.col("_m")), "left")
    whole = keyed.where("not flag").select("doc_id", "text", F.lit(None).cast(cut.schema["spans"].dataType).alias("spans"))
    both = concerned.select("doc_id", "text", "spans").union(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                text, spans = text.as_py(), merged(spans.as_py() or [])
                at, parts = 0, []
                for s, e in spans:
                    parts.append(text[at:s])
                    at = e
                kept = b"".join([*parts, text[at:]])
                rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                             kept if with_bytes else None))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(),
                                                                                   pa.string(), pa.binary()))]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = map_batches(both, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_bytes else out.drop("kept")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns and ``repeated``: whether anything was removed (``n_bytes`` is the input's length)."""
    return deduplicated(docs, with_bytes=False).withColumn("repeated", F.col("n_removed") > 0)
