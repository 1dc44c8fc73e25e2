"""Drops of one layer whose columns changed over time, read as one frame.

A column that a drop lacks reads as NULL; whole numbers and floats are widened to the widest type any drop has. Nothing
else changes its type: a column that would has to be mended by hand, and the error names it, both types and both drops.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types that widen without loss, narrowest first.
_WIDENING = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.FloatType(), T.DoubleType()),
)


class SchemaConflict(ValueError):
    """A column whose type changed in a way that cannot be read together."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both, None if there is none."""
    if a == b:
        return a
    for family in _WIDENING:
        if a in family and b in family:
            return max(a, b, key=family.index)
    return None


def merged_schema(schemas: Mapping[str, T.StructType]) -> T.StructType:
    """One schema for all drops (name -> schema): columns in order of first appearance, all nullable."""
    kinds: dict[str, tuple[T.DataType, str]] = {}
    names: dict[str, str] = {}
    for drop, schema in schemas.items():
        for f in schema.fields:
            name = names.setdefault(f.name.lower(), f.name)
            if name not in kinds:
                kinds[name] = (f.dataType, drop)
                continue
            known, first = kinds[name]
            both = wider(known, f.dataType)
            if both is None:
                raise SchemaConflict(f"column {name}: {known.simpleString()} in {first}, {f.dataType.simpleString()} in {drop}")
            kinds[name] = (both, first if both == known else drop)
    return T.StructType([T.StructField(n, k) for n, (k, _) in kinds.items()])


def read_evolved(spark: SparkSession, drops: Sequence[str], *, fmt: str = "parquet") -> DataFrame:
    """The rows of all drops (folders, each written by one job and so of one schema), under their merged schema.

    One footer a drop is read for its schema; drops of the same schema are read in one scan, so the plan grows with
    the number of schema changes, not with the number of drops."""
    schemas = {d: spark.read.format(fmt).load(d).schema for d in drops}
    whole = merged_schema(schemas)
    alike: dict[str, list[str]] = {}
    for d, schema in schemas.items():
        alike.setdefault(schema.json(), []).append(d)
    frames = []
    for paths in alike.values():
        schema = schemas[paths[0]]
        rows = spark.read.format(fmt).schema(schema).load(paths) if len(paths) > 1 else spark.read.format(fmt).load(paths[0])
        held = {f.name.lower(): f.name for f in schema.fields}
        frames.append(rows.select(*[
            (F.col(held[f.name.lower()]) if f.name.lower() in held else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in whole.fields]))
    return reduce(lambda a, b: a.unionByName(b), frames)


def land_evolved(df: DataFrame, drops: Sequence[str], target: str) -> T.StructType:
    """Write ``df`` as the next drop ``target`` beside ``drops``, if their schemas can still be read together.

    Returns the merged schema; a conflict raises before anything is written."""
    spark = df.sparkSession
    schemas = {d: spark.read.parquet(d).schema for d in drops}
    whole = merged_schema({**schemas, target: df.schema})
    df.write.mode("error").parquet(target)
    return whole
