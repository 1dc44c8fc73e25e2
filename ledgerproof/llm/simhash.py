"""SimHash near-duplicate groups by bit-sliced comparison.

A text's fingerprint has one bit per majority over the XXH64 values of its word shingles. Fingerprints within
``radius`` differing bits are linked, exactly:

* Equal fingerprints collapse first, so copies cost one row. The 64 bits are split into p parts; two
  fingerprints within the radius agree in at least p - radius of them, so each is filed under every choice of
  p - radius parts. p grows with the number of fingerprints and keeps buckets near ``BUCKET`` whatever the size;
  any p gives the same links.
* Rows come sorted by bucket, their fingerprints stored as 64 vertical bit planes. Comparing every row with the
  one d places on is a shifted XOR of planes; carry-save counters add the differences of 64 pairs at once, and a
  block of 64 pairs is abandoned as soon as all of them exceed the radius.
* A bucket above ``TILE`` rows is cut into tiles and every pair of tiles is a task's group of its own.
* Each group gives a spanning forest of its links, never all pairs; groups meet in distributed components.

Defined results: NULL text and text without a word have fingerprint 0 and are linked like others; fewer words
than a shingle count as one shingle; repeated ids keep a row each; a group whose ids are all NULL has a NULL
component; an empty table gives no rows; other columns are ignored (``fingerprints``) or passed on (``one_each``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, free_names, map_batches, maybe_in, refuse_taken, written
from .components import stars

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET = 64
TILE = 4096
_SLICE = 100_000  # shingles whose bits are spread at a time
_FLUSH = 1 << 20  # links held before they are merged into the forest


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, bit b set if over half of the shingles' XXH64 values have it; without words 0."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and the ASCII blanks only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    of, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        h = np.array([of(line[a:b], SEED) for a, b in zip(starts[at:min(n, at + _SLICE)].tolist(),
                                                          last[at:at + _SLICE].tolist())], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and a new column with the fingerprint's 64 bits as a long."""
    refuse_taken(docs.columns, name)
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = np.array([fingerprint(x.as_py(), shingle) for x in b.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bits, pa.int64())], names=[*b.schema.names, name])

    return map_batches(docs, run, schema)


# ---- bit-sliced comparison of sorted rows


def _planes(bits: np.ndarray) -> np.ndarray:
    """(64, words) of the rows' bits stored vertically, with one spare word for shifts."""
    n = len(bits)
    words = -(-n // 64) + 1
    spread = np.zeros((64, words * 64), np.uint8)
    spread[:, :n] = np.unpackbits(bits.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    return np.packbits(spread, axis=1, bitorder="little").view(np.uint64)


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three bit vectors."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def _beyond(ones, twos, fours, over, radius: int) -> np.ndarray:
    """Bits of the pairs whose counter exceeds ``radius`` (0 to 7)."""
    more, same = over.copy(), ~over
    for plane, bit in ((fours, radius >> 2 & 1), (twos, radius >> 1 & 1), (ones, radius & 1)):
        if bit:
            same &= plane
        else:
            more |= same & plane
            same &= ~plane
    return more


def _within(planes: np.ndarray, shift: int, valid: np.ndarray, radius: int) -> np.ndarray:
    """Rows i, as positions, for which row i + shift is within the radius; ``valid`` marks the pairs to compare."""
    words = np.flatnonzero(valid)
    left = valid[words]
    skip, s = divmod(shift, 64)
    zero = np.zeros(len(words), np.uint64)
    ones, twos, fours, over = zero, zero, zero, zero
    s, back = np.uint64(s), np.uint64(64 - s)
    last = planes.shape[1] - 1

    def differ(plane: np.ndarray) -> np.ndarray:
        far = plane[np.minimum(words + skip, last)]
        if s:
            far = (far >> s) | (plane[np.minimum(words + skip + 1, last)] << back)
        return plane[words] ^ far

    for at in range(0, 64, 8):
        x = [differ(p) for p in planes[at:at + 8]]
        ones, a = _add(ones, x[0], x[1])
        ones, b = _add(ones, x[2], x[3])
        twos, c = _add(twos, a, b)
        ones, a = _add(ones, x[4], x[5])
        ones, b = _add(ones, x[6], x[7])
        twos, d = _add(twos, a, b)
        fours, e = _add(fours, c, d)
        over = over | e
        left = left & ~_beyond(ones, twos, fours, over, radius)
        alive = left != 0
        if not alive.all():  # abandon the blocks in which every pair is beyond the radius
            words, left, ones, twos, fours, over = (y[alive] for y in (words, left, ones, twos, fours, over))
            if not len(words):
                break
    hit = np.unpackbits(left.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, bit = np.nonzero(hit)
    return words[w] * 64 + bit


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest position reached) after the links (a, b)."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]


def forest(group: np.ndarray, bits: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (row, row) of all pairs within the radius that share a group number."""
    order = np.argsort(group, kind="stable")
    _, index, size = np.unique(group[order], return_inverse=True, return_counts=True)
    order = order[np.lexsort((index, -size[index]))]  # largest groups first: a shift then concerns a leading part
    g, f = group[order], np.ascontiguousarray(bits[order])
    sizes = np.sort(size)[::-1]
    upto = np.cumsum(sizes)
    label = np.arange(len(f))
    planes, held, n_held = _planes(f), [], 0
    for shift in range(1, int(sizes[0]) if len(sizes) else 0):
        n = int(upto[np.searchsorted(-sizes, -shift, side="left") - 1])
        same = np.zeros(-(-n // 64) * 64, np.uint8)
        same[: n - shift] = g[: n - shift] == g[shift:n]
        i = _within(planes, shift, np.packbits(same, bitorder="little").view(np.uint64), radius)
        held.append(i)
        held.append(i + shift)
        n_held += len(i)
        if n_held > _FLUSH:
            label, held, n_held = _merge(label, np.concatenate(held[::2]), np.concatenate(held[1::2])), [], 0
    if held:
        label = _merge(label, np.concatenate(held[::2]), np.concatenate(held[1::2]))
    moved = np.flatnonzero(label != np.arange(len(f)))
    return order[moved], order[label[moved]]


# ---- the distributed part


def parts_for(n: int, radius: int) -> int:
    """Parts of the 64 bits such that n even fingerprints fill a bucket with at most ``BUCKET`` rows."""
    p = radius + 1
    while p < 2 * radius + 4 and n / 2 ** (64 * (p - radius) / p) > BUCKET:
        p += 1
    return p


def _masks(parts: int, radius: int) -> list[int]:
    edges = [round(64 * k / parts) for k in range(parts + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    signed = [sum(c) for c in combinations(part, parts - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in signed]


def links(prints: DataFrame, *, radius: int = RADIUS, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """``prints`` (bits: distinct fingerprints) -> links (u, v) that connect exactly what the radius connects."""
    parts = parts or parts_for(prints.count(), radius)
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("bits").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                     for k, m in enumerate(_masks(parts, radius))])
    filed = prints.select("bits", F.explode(keys).alias("at")).select("bits", "at.k", "at.key")
    sizes = filed.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("k").alias("_k"), F.col("key").alias("_key"), F.ceil(F.col("n") / F.lit(tile)).cast("int").alias("tiles"))
    shared = filed.join(sizes, (F.col("k") == F.col("_k")) & (F.col("key") == F.col("_key")))
    own = F.pmod(F.xxhash64("bits"), F.col("tiles")).cast("int")
    other = F.explode(F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("tiles") - 1), F.col("own"))))
    tiled = shared.withColumn("own", own).withColumn("other", other)
    grouped = tiled.select("bits", F.xxhash64("k", "key", F.least("own", "other"), F.greatest("own", "other")).alias("g"))
    bounded_batches(prints.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g_rest, b_rest = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def solved(g: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            x, y = forest(g, b, radius)
            s = b.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(s[x], pa.int64()), pa.array(s[y], pa.int64())], names=["u", "v"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append((batch.column(1).to_numpy(), batch.column(0).to_numpy().view(np.uint64)))
            rows += batch.num_rows
            if rows < 65_536:
                continue
            g, b = (np.concatenate(x) for x in zip((g_rest, b_rest), *held))
            whole = int(np.searchsorted(g, g[-1], side="left"))  # the last group may go on in the next batch
            if whole:
                yield solved(g[:whole], b[:whole])
            g_rest, b_rest, held, rows = g[whole:], b[whole:], [], 0
        g, b = (np.concatenate(x) for x in zip((g_rest, b_rest), *held))
        if len(g):
            yield solved(g, b)

    return grouped.repartition("g").sortWithinPartitions("g").mapInArrow(run, "u long, v long")


def components(rows: DataFrame, *, bits: str, id: str = "doc_id", radius: int = RADIUS,
               parts: int | None = None) -> DataFrame:
    """(bits, root, component_id): each distinct fingerprint, the smallest fingerprint and the smallest id it reaches."""
    prints = written(rows.groupBy(F.col(bits).alias("bits")).agg(F.min(id).alias("least")), "prints")
    star = stars(links(prints.select("bits"), radius=radius, parts=parts))
    rooted = prints.join(star, prints["bits"] == star["u"], "left").select(
        "bits", "least", F.coalesce("v", "bits").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("bits", "root").join(of_root, "root").select("bits", "root", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    rows = written(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast(
        "string").alias("text")), name="bits").drop("text"), "fingerprints")
    found = components(rows, bits="bits").withColumnRenamed("bits", "_b")
    return rows.join(found, rows["bits"] == found["_b"]).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def one_each(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one of smallest id (NULL last), then as first read."""
    names = docs.columns
    bits, row, flag = free_names(names, "_simhash_bits", "_simhash_row", "_simhash_flag")
    rows = written(fingerprints(docs, name=bits, shingle=shingle).withColumn(
        row, F.monotonically_increasing_id()), "fingerprinted")  # the row number is fixed by the write
    slim = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(bits).alias("_b"), F.col(row).alias("_r"))
    found = components(slim, bits="_b", radius=radius)
    prints = slim.groupBy("_b").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_r")).alias("first"))
    firsts = prints.join(found, F.col("_b") == F.col("bits")).groupBy("root").agg(F.min("first").alias("first"))
    gone = written(slim.select("_r").join(firsts.select(F.col("first._r").alias("_r")), "_r", "left_anti"), "simhash-gone")
    gone = gone.withColumnRenamed("_r", f"{row}_")
    told = maybe_in(rows, F.col(row), gone, flag)  # rows that certainly stay do not move
    doubtful = told.where(F.col(flag)).join(gone, F.col(row) == F.col(f"{row}_"), "left_anti")
    return told.where(~F.col(flag)).select(*names).union(doubtful.select(*names))
