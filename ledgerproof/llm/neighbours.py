"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact reranking.

Vectors are dealt into ranges of norm, each a factor of at most 2**RANGE wide; each range is scaled by its own largest
norm and lifted to the unit sphere, so the largest inner product is the smallest distance. A range of at most
``WHOLE`` classes is one bucket that every query visits; others are hashed by their own number of projections. Each of ``TABLES`` tables cuts K random projections (Gaussian, 2-stable) into cells of ``WIDTH`` standard
deviations; K cells name a bucket. A query visits its own bucket and those reached by moving some projections one
cell up or down, in the order of estimated success: the smaller the sum of squared distances from the query to the
crossed cell borders, the earlier, up to ``probes_for(K)`` per table. What the visited buckets hold, from all tables,
is ranked by the exact inner product in double precision. A query with fewer than ``best`` + 1 classes ranked asks
again with ``MORE`` times the probes, and is then scored against every row, in blocks.

Scale: K grows with the logarithm of a range's rows. Equal vectors collapse to one class that keeps its ``best`` + 1
smallest ids (enough for every query, ties go to smaller ids), found with a group limit before the shuffle; so a
vector that a third of the rows share costs one class. Buckets are dealt into groups of a bounded number of rows,
larger buckets are cut into several groups; a task buffers one group's rows and streams the queries past them in
blocks, and passes on ``best`` + 1 classes per query and group. The table of larger buckets is broadcast while its
bound, rows x tables / room, is under ``BROADCAST_ROWS``; only counts
and largest norms by sixteenths of a power of two are collected. Every row is indexed; no bucket is capped.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components take no part; vectors of another
dimension are compared among themselves; a NULL id is a candidate (after all other ids) and never a query; rows
that repeat an id are rows of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches, written

BEST = 20
TABLES = 8
WIDTH = 2.0
SEED = 11
GROUP_FLOATS = 1 << 22  # vector components buffered per group
RANGE = 0.5  # powers of two a range of norms spans
STEPS = 16  # norms are counted by this part of a power of two
WHOLE = 1024
MORE = 8
BROADCAST_ROWS = 500_000  # most rows (24 bytes each) of the table of large buckets that is broadcast
_BLOCK = 128  # queries scored at a time
_BAND = np.int64(0x5851F42D4C957F2D)


def projections_for(n: int) -> int:
    return max(4, round(math.log2(max(n, 2)) / 2 + 0.3))


def probes_for(projections: int) -> int:
    return round(96 * 2 ** (0.75 * max(0, projections - 8)))


def perturbations(inside: np.ndarray, most: int) -> list[list[tuple[int, int]]]:
    """Sets of (projection, +1 or -1), the empty one first, by the sum of squared distances to the crossed borders.

    ``inside``: the query's place in its cell, per projection, from 0 to 1. Sets grow from the cheapest border by
    shifting their last member or adding its successor, which meets every set once, in order."""
    k = len(inside)
    moves = sorted([(float(x) ** 2, i, -1) for i, x in enumerate(inside)] +
                   [(float(1 - x) ** 2, i, 1) for i, x in enumerate(inside)])
    out: list[list[tuple[int, int]]] = [[]]
    heap = [(moves[0][0], (0,))] if k else []
    while heap and len(out) < most:
        cost, picked = heapq.heappop(heap)
        if len({moves[j][1] for j in picked}) == len(picked):
            out.append([moves[j][1:] for j in picked])
        after = picked[-1] + 1
        if after < 2 * k:
            heapq.heappush(heap, (cost - moves[picked[-1]][0] + moves[after][0], (*picked[:-1], after)))
            heapq.heappush(heap, (cost + moves[after][0], (*picked, after)))
    return out


class Tables:
    """The projections of every table and the names of buckets."""

    def __init__(self, dimension: int, tables: int, projections: int):
        rng = np.random.default_rng([SEED, dimension])
        self.shape = (tables, projections)
        self.a = rng.standard_normal((dimension + 1, tables * projections))
        self.b = rng.random(tables * projections) * WIDTH
        self.weights = rng.integers(1, 1 << 62, tables * projections, dtype=np.int64).reshape(self.shape) | 1

    def places(self, lifted: np.ndarray) -> np.ndarray:
        return ((lifted @ self.a + self.b) / WIDTH).reshape(len(lifted), *self.shape)

    def names(self, cells: np.ndarray, band: int = 0) -> np.ndarray:
        """(rows, tables): a bucket's name, 56 bits of wrapping sums of cells and norm range times odd weights, then
        the table's number."""
        mixed = (cells * self.weights).sum(-1) + np.array([band], np.int64) * _BAND
        mixed ^= mixed >> 31
        return (mixed << 8) | np.arange(self.shape[0])

    def probed(self, place: np.ndarray, most: int, band: int = 0) -> np.ndarray:
        """Names of the buckets one query visits, all tables."""
        cells = np.floor(place).astype(np.int64)
        out = []
        for t in range(self.shape[0]):
            sets = perturbations(place[t] - cells[t], most)
            step = np.zeros((len(sets), *self.shape), np.int64)
            for i, moved in enumerate(sets):
                for p, way in moved:
                    step[i, t, p] = way
            out.append(self.names(cells + step, band)[:, t])
        return np.concatenate(out)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<f8") for x in column.to_pylist()]


def valid(rows: DataFrame, *, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id long, v binary (the components as doubles): rows that take part."""
    x = F.col(vector).cast("array<double>")
    fine = rows.select(F.col(id).cast("long").alias("id"), x.alias("x")).where(
        "x is not null and size(x) > 0 and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))"
        " and exists(x, c -> c <> 0)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([(np.array(x, "<f8") + 0.0).tobytes() for x in b.column(1).to_pylist()], pa.binary())],
                names=["id", "v"])

    return map_batches(fine, run, "id long, v binary")


def classes(points: DataFrame, is_query, *, best: int = BEST) -> DataFrame:
    """One row per distinct vector: class, v, ids (its ``best`` + 1 smallest, NULL last), asked (a query has it)."""
    first = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    few = points.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= best + 1)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("_n", "id"))), lambda x: x["id"])
    few = few.groupBy("v").agg(ids.alias("ids"))
    asked = points.where(is_query).select("v").distinct().withColumn("asked", F.lit(True))
    both = few.join(asked, "v", "left").select("v", "ids", F.coalesce("asked", F.lit(False)).alias("asked"))
    return written(both.withColumn("class", F.monotonically_increasing_id()), "ann-classes")  # fixed by the write


def log_norm(v: np.ndarray) -> float:
    """Binary logarithm of the norm, finite wherever the components are."""
    most = np.abs(v).max()
    return float(np.log2(most) + 0.5 * np.log2(((v / most) ** 2).sum()))


def ranges(steps: list[tuple[int, int, float]]) -> tuple[dict[int, int], list[tuple[int, float]]]:
    """(step, rows, largest logarithm) per step of the norm -> the range of every step, and (rows, largest logarithm)
    per range; a range begins at the largest norm left."""
    of, out = {}, []
    for step, n, top in sorted(steps, reverse=True):
        if not out or out[-1][1] - step / STEPS > RANGE:
            out.append((0, top))
        out[-1] = (out[-1][0] + n, out[-1][1])
        of[step] = len(out) - 1
    return of, out


def _step(log: float) -> int:
    return math.floor(log * STEPS)


def filed(of: DataFrame, step_range: dict[int, int], bands: list[tuple[int, float]], *, tables: int) -> DataFrame:
    """rows: bucket, class, first, v of the classes; first is the smallest id. ``bands``: (projections or 0 for a range
    that is one bucket, largest logarithm) of each range of norms."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vs = _vectors(batch.column("v"))
            logs = [log_norm(v) for v in vs]
            kinds: dict[tuple[int, int], list[int]] = {}
            for i, v in enumerate(vs):
                kinds.setdefault((len(v), step_range[_step(logs[i])]), []).append(i)
            for (d, band), at in kinds.items():
                projections, top = bands[band]
                if projections:
                    most = np.array([[np.abs(vs[i]).max()] for i in at])
                    scaled = np.stack([vs[i] for i in at]) / most * np.exp2(np.log2(most) - top)
                    lifted = np.concatenate([scaled, np.sqrt(np.maximum(0.0, 1 - (scaled**2).sum(1, keepdims=True)))], 1)
                    table = Tables(d, tables, projections)
                    names = table.names(np.floor(table.places(lifted)).astype(np.int64), band)
                else:
                    names = np.full((len(at), 1), _whole(band))
                part = batch.take(pa.array(np.repeat(at, names.shape[1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.ravel()), part.column("class"), part.column("first"), part.column("v")],
                    names=["bucket", "class", "first", "v"])

    return map_batches(_slim(of), index, "bucket long, class long, first long, v binary")


def _whole(band: int) -> int:
    """The name of the bucket that holds a whole range (its table's number is one that no table has)."""
    return band << 8 | 255


def _slim(of: DataFrame) -> DataFrame:
    return of.select("class", F.coalesce(F.get("ids", F.lit(0)), F.lit(2**63 - 1)).alias("first"), "v")


def asking(queries: DataFrame, bands: list[tuple[int, float]], *, tables: int, probes: int | None, times: int) -> DataFrame:
    """class, v, buckets: what the queries (class, v) visit, all ranges of norms."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array([_whole(b) for b, (projections, _) in enumerate(bands) if not projections], np.int64)
        for batch in batches:
            vs = _vectors(batch.column("v"))
            size = np.array([len(v) for v in vs])
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                v = np.stack([vs[i] for i in at])
                v = v / np.abs(v).max(1, keepdims=True)
                unit = np.concatenate([v / np.sqrt((v**2).sum(1, keepdims=True)), np.zeros((len(v), 1))], 1)
                visits = [[whole] for _ in at]
                for band, (projections, _) in enumerate(bands):
                    if projections:
                        table = Tables(d, tables, projections)
                        for visit, place in zip(visits, table.places(unit)):
                            visit.append(table.probed(place, times * (probes or probes_for(projections)), band))
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [part.column("class"), part.column("v"),
                     pa.array([np.concatenate(visit) for visit in visits], pa.list_(pa.int64()))],
                    names=["class", "v", "buckets"])

    return map_batches(queries, ask, "class long, v binary, buckets array<long>")


def _score(batches: Iterator[pa.RecordBatch], best: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by group, rows before queries -> query, class, first, score: each query's ``best`` + 1 nearest
    classes per group, ties to smaller first ids."""
    group, held, x, bucket, ids, first, names = None, [], None, None, None, None, {}

    def ready():
        nonlocal x, bucket, ids, first, names
        if x is None and held:
            x = np.stack([np.frombuffer(v, "<f8") for *_, v in held])
            ids, first = np.array([h[1] for h in held]), np.array([h[2] for h in held])
            keys, bucket = np.unique([h[0] for h in held], return_inverse=True)
            order = np.argsort(bucket, kind="stable")
            x, ids, first, bucket = x[order], ids[order], first[order], bucket[order]
            names = {int(k): i for i, k in enumerate(keys)}

    def scored(queries: list) -> pa.RecordBatch | None:
        ready()
        if x is None:
            return None
        queries = [q for q in queries if len(q[1]) == 8 * x.shape[1]]
        if not queries:
            return None
        q = np.stack([np.frombuffer(v, "<f8") for _, v, _ in queries])
        edge = np.searchsorted(bucket, np.arange(len(names) + 1))
        visiting: dict[int, list[int]] = {}
        for i, (_, _, buckets) in enumerate(queries):
            for b in buckets:
                if b in names:
                    visiting.setdefault(names[b], []).append(i)
        s = np.full((len(queries), len(x)), -np.inf)
        for b, who in visiting.items():
            s[who, edge[b]:edge[b + 1]] = q[who] @ x[edge[b]:edge[b + 1]].T
        k = min(best + 1, s.shape[1])
        least = -np.partition(-s, k - 1, axis=1)[:, k - 1]
        who, what = np.nonzero((s >= least[:, None] - 1e-9) & (s > -np.inf))
        exact = np.einsum("ij,ij->i", q[who], x[what])  # the same sum for a pair wherever it is met
        order = np.lexsort((first[what], -exact, who))
        who, what, exact = who[order], what[order], exact[order]
        near = np.arange(len(who)) - np.searchsorted(who, who) < k
        who, what, exact = who[near], what[near], exact[near]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array([c for c, _, _ in queries])[who], pa.int64()), pa.array(ids[what], pa.int64()),
             pa.array(first[what], pa.int64()), pa.array(exact)], names=["query", "class", "first", "score"])

    waiting: list = []
    for batch in batches:
        for g, is_query, b, c, f, v, buckets in zip(*(col.to_pylist() for col in batch.columns)):
            if g != group or len(waiting) == _BLOCK:
                out = scored(waiting) if waiting else None
                waiting = []
                if out is not None:
                    yield out
            if g != group:
                group, held, x = g, [], None
            if is_query:
                waiting.append((c, v, buckets))
            else:
                held.append((b, c, f, v))
    out = scored(waiting) if waiting else None
    if out is not None:
        yield out


def visited(rows: DataFrame, queries: DataFrame, *, n: int, widest: int, tables: int, best: int) -> DataFrame:
    """query, class, score: each query's ``best`` + 1 nearest classes in the buckets it visits."""
    room = max(256, GROUP_FLOATS // (widest or 1))
    parts = max(1, math.ceil(n / room))
    d = F.octet_length("v").alias("d")
    rows = rows.select("*", d)
    large = rows.groupBy("bucket", "d").agg(F.count("*").alias("n")).where(F.col("n") > room).select(
        "bucket", "d", F.ceil(F.col("n") / room).cast("int").alias("cuts"))
    if n * tables / room <= BROADCAST_ROWS:  # at most so many buckets can be that large
        large = F.broadcast(large)
    # small buckets of one table and dimension share a group, so a class is at most once in a group
    shared = F.xxhash64("d", F.pmod(F.col("bucket"), F.lit(256)), F.pmod(F.xxhash64("bucket"), F.lit(parts)))
    def own(cut):
        return F.xxhash64("bucket", "d", cut)

    rows = rows.join(large, ["bucket", "d"], "left").withColumn("g", F.when(
        F.col("cuts").isNull(), shared).otherwise(
            own(F.pmod(F.xxhash64("class"), F.col("cuts")).cast("int"))))
    asked = queries.select("class", d, F.explode("buckets").alias("bucket")).join(
        large, ["bucket", "d"], "left").withColumn("g", F.explode(F.when(
            F.col("cuts").isNull(), F.array(shared)).otherwise(F.transform(
                F.sequence(F.lit(0), F.col("cuts") - 1), own))))
    asked = asked.groupBy("class", "g").agg(F.collect_list("bucket").alias("buckets"))  # at most the probes
    asked = asked.join(queries.select("class", "v"), "class")
    both = rows.select("g", F.lit(False).alias("is_query"), "bucket", "class", "first", "v",
                       F.lit(None).cast("array<long>").alias("buckets")).union(
        asked.select("g", F.lit(True), F.lit(None).cast("long"), "class", F.lit(None).cast("long"), "v", "buckets"))
    bounded_batches(rows.sparkSession)
    near = both.repartition("g").sortWithinPartitions("g", "is_query").mapInArrow(
        lambda batches: _score(batches, best), "query long, class long, first long, score double").distinct()
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "first", "class")
    return near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= best + 1).select("query", "class", "score")


def nearest_classes(of: DataFrame, *, best: int = BEST, tables: int = TABLES, projections: int | None = None,
                    probes: int | None = None) -> DataFrame:
    """query, class, score: per asked class its ``best`` + 1 nearest classes among those visited, all if fewer exist."""
    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = _vectors(b.column(0))
            logs = [log_norm(v) for v in vs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_step(x) for x in logs], pa.int32()), pa.array(logs, pa.float64()),
                 pa.array([len(v) for v in vs], pa.int32())], names=["step", "log", "d"])

    steps = map_batches(of.select("v"), norms, "step int, log double, d int").groupBy("step").agg(
        F.count("*").alias("n"), F.max("log").alias("top"), F.max("d").alias("d")).collect()  # bounded by the exponents
    n, widest = sum(r.n for r in steps), max((r.d for r in steps), default=1)
    step_range, sizes = ranges([(r.step, r.n, r.top) for r in steps])
    bands = [(projections or (projections_for(m) if m > WHOLE else 0), top) for m, top in sizes]
    rows = written(filed(of, step_range, bands, tables=tables), "ann-index")
    queries, done = of.where("asked").select("class", "v"), None
    how = {"n": n, "widest": widest, "tables": tables, "best": best}
    for times in (1, MORE, None):  # None: every row
        if times:
            asked = written(asking(queries, bands, tables=tables, probes=probes, times=times), "ann-probes")
        else:
            rows = _slim(of).select(F.lit(0).cast("long").alias("bucket"), "class", "first", "v")
            asked = queries.withColumn("buckets", F.array(F.lit(0).cast("long")))
        near = written(visited(rows, asked, **how), "ann-near")
        full = near.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") > best).select("query")
        short = queries.join(full, queries["class"] == full["query"], "left_anti")
        if times is None or short.isEmpty():
            return near if done is None else done.union(near)
        kept = near.join(full, "query", "left_semi")
        done = kept if done is None else done.union(kept)
        queries = written(short, "ann-short")


def search(vectors: DataFrame, is_query, *, id: str = "vec_id", vector: str = "embedding", best: int = BEST,
           **how) -> DataFrame:
    """query_id, rank (from 1), the neighbour's id, score: for every row that ``is_query`` (a condition on ``id``)."""
    points = written(valid(vectors, id=id, vector=vector), "ann-points")
    of = classes(points, is_query, best=best)
    near = nearest_classes(of, best=best, **how)
    found = near.join(of.select("class", "ids"), "class").select(
        "query", "score", (F.col("query") == F.col("class")).alias("own"), F.explode("ids").alias("id"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("own"))
    top = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= best + 1)
    top = top.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("at", "id", "score", "own"))).alias("top"))
    top = top.join(of.select(F.col("class").alias("query"), "v"), "query").select("v", "top")
    asked = points.where(is_query).select(F.col("id").alias("query_id"), "v").join(top, "v")
    mine = F.array_position(F.transform("top", lambda x: x["own"] & x["id"].eqNullSafe(F.col("query_id"))), True)
    others = F.slice(F.filter("top", lambda x, i: i + 1 != F.col("mine")), 1, best)
    return asked.withColumn("mine", mine).select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias(id), F.col("x.score").alias("score"))


def digest(vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("id") % 20 == 0)
