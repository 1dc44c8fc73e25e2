"""Pieces the training-data operators share: input tables, word rule, batch limits, scratch tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerproof.session import materialize

#: A word: a run of anything but space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of one Arrow batch handed to Python; with texts of any length this bounds a task's memory.
BATCH_ROWS = 1000
BATCH_BYTES = 16 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Ready the session for Python workers: Arrow batch limits that suit long texts (a user's own lower limit
    stays) and, in a local session, this package on the workers' path."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        now = int(now.rstrip("b")) if now and now.rstrip("b").isdigit() else None
        if now is None or now <= 0 or now > most:
            spark.conf.set(key, str(most))
    context = spark.sparkContext
    if context.master.startswith("local"):  # on a cluster the package is installed or shipped with --py-files
        root, now = str(Path(__file__).resolve().parents[2]), context.environment.get("PYTHONPATH", "")
        if root not in now.split(os.pathsep):
            context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [now, root]))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` under the batch limits."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write under the shared checkpoint folder, read back (survives a lost executor)."""
    return materialize(df, f"llm-{label}")


def word_count(text: Column) -> Column:
    """Number of words; NULL text counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Column names that no name in ``taken`` equals (Spark compares without case): the wanted ones, underscored."""
    used, out = {n.lower() for n in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def refuse_taken(taken: list[str], *names: str) -> None:
    """Raises if a column that is to be added exists already (Spark compares names without case)."""
    held = {n.lower() for n in taken}
    clash = [n for n in names if n.lower() in held]
    if clash:
        raise ValueError(f"column exists already: {', '.join(clash)}; name the new one otherwise")


#: Bits of ``maybe_in``'s filter: 1 MB broadcast. Where it fills up, more rows are flagged and results stay the same.
FILTER_BITS = 1 << 23


def maybe_in(df: DataFrame, key: Column, wanted: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``, false only where ``key`` is certainly none of ``wanted``'s one column.

    A bitmap of the wanted keys' hashes is broadcast, FILTER_BITS at most, so the rows that cannot meet stay out of the
    shuffle of an exact join that follows."""
    b, at, bucket, bits = free_names([*df.columns, flag], "_bit", "_place", "_bucket", "_bits")
    slot = F.pmod(F.xxhash64(wanted.columns[0]), F.lit(FILTER_BITS)) + 1
    table = wanted.select(slot.alias(b)).groupBy(F.bitmap_bucket_number(b).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(b)).alias(bits))
    own = df.withColumn(b, F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)) + 1).withColumn(at, F.bitmap_bit_position(b))
    own = own.join(F.broadcast(table.withColumnRenamed(bucket, f"{bucket}_")),
                   F.bitmap_bucket_number(b) == F.col(f"{bucket}_"), "left")
    byte = F.conv(F.hex(F.expr(f"substring({bits}, cast({at} div 8 + 1 as int), 1)")), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))
    return own.select(*df.columns, found.alias(flag))


def positions(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` with ``pos``: a row's place from 0 among its ``group``'s rows by ``order`` (ascending, NULLs first).

    Rows are range-partitioned and sorted by group and order, so a group of any size is spread over many tasks;
    a place is the place in its partition plus the group's rows in earlier ones, one slim row per partition and
    group. ``order`` should end in a column that tells equal rows apart, or they all meet in one range. Written."""
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    placed = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    firsts = placed.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*[f"_g{i}" for i in range(len(group))] or [F.lit(1)]).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    same = part == F.col("_part")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(firsts, same).select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos"))


_HELD: dict[str, Callable[[], None]] = {}


def hold_cache(owner: str, release: Callable[[], None]) -> None:
    """A worker process outlives its tasks, and caches speed up the next one; only one operator's cache stays.

    The cache of another ``owner`` is released first."""
    for other in [o for o in _HELD if o != owner]:
        _HELD.pop(other)()
    _HELD[owner] = release
