"""Maintenance of plain Parquet folders by file: which files a filter must read, and merging the small ones only.

Both begin with a frame of the folder's files. Spark lists the files and writes the data; what the driver handles is
file names, as any commit does.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerproof.session import remove_path

TARGET_BYTES = 256 * 1024 * 1024
#: A file is small below this share of the target, so a merged file (over half a target, but for a partition's last) stays.
SMALL_SHARE = 0.5


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """file, folder (below ``path``, '' at its top) and bytes of every data file under ``path``; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    top = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(top).toUri().getPath()
    folder = F.regexp_replace(F.col("path"), r"/[^/]*\z", "")
    below = F.substring(folder, F.locate(top, folder) + len(top) + 1, F.lit(1 << 20))
    return listed.select(F.col("path").alias("file"), below.alias("folder"), F.col("length").alias("bytes"))


def file_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A row per file and column: file, column, low, high (as text that sorts like the values), nulls and rows.

    One scan of the columns, one slim row per file and task: write it beside the table and a filter need not open
    files to know which to skip."""
    rows = spark.read.parquet(path)
    each = F.array(*[F.struct(F.lit(c).alias("column"), sortable_text(rows, c).alias("v")) for c in columns])
    long = rows.select(F.col("_metadata.file_path").alias("file"), F.explode(each).alias("e"))
    return long.groupBy("file", F.col("e.column").alias("column")).agg(
        F.min("e.v").alias("low"), F.max("e.v").alias("high"), F.count_if(F.col("e.v").isNull()).alias("nulls"),
        F.count("*").alias("rows"))


def sortable_text(df: DataFrame, column: str, value: Column | None = None) -> Column:
    """A column's values (or one ``value`` of its type) as text in the same order: strings as they are, integers, dates
    and times shifted to fixed-width digits. Other types have no such text here."""
    kind, col = dict(df.dtypes)[column], F.col(column) if value is None else value
    if kind == "string":
        return col.cast("string")
    if kind in ("timestamp_ntz", "timestamp"):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if kind == "date":
        return F.date_format(col, "yyyy-MM-dd")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.lpad((col.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    raise ValueError(f"no ranges for {column}: {kind}")


def files_to_read(ranges: DataFrame, table: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """The files that may hold rows with ``low <= column <= high``."""
    kind = dict(table.dtypes)[column]
    bounds = [sortable_text(table, column, F.lit(v).cast(kind)) for v in (low, high)]
    return ranges.where((F.col("column") == column) & (F.col("high") >= bounds[0]) & (F.col("low") <= bounds[1])).select("file")


# ---- small files


def merge_plan(files: DataFrame, target_bytes: int) -> DataFrame:
    """file, folder, bytes, bin of the small files that can be merged, bins by prefix sums of sizes within a folder.

    Files of the target's size, and bins of one file, are left out: a plan of nothing means nothing to do."""
    small = files.where(F.col("bytes") < F.lit(int(target_bytes * SMALL_SHARE)))
    before = Window.partitionBy("folder").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    binned = small.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes))
    several = F.count("*").over(Window.partitionBy("folder", "bin"))
    return binned.withColumn("_n", several).where("_n > 1").drop("_n")


def compact_small_files(spark: SparkSession, path: str, *, target_bytes: int = TARGET_BYTES, wave: int = 10_000) -> dict[str, int]:
    """Merges the small files of a (partitioned) Parquet folder to files of about ``target_bytes``; others are not touched.

    A wave takes up to ``wave`` files: their rows are read once, dealt to one task per bin and written to a hidden folder
    beside the data; when the rows there are as many, the old files go and the new ones move in (a failure in between
    leaves the rows in that folder, which the error names). A second run finds nothing to do.
    Returns files ``merged`` and ``written``."""
    plan = merge_plan(data_files(spark, path), target_bytes).orderBy("folder", "bin").collect()  # names of small files
    done = {"merged": len(plan), "written": 0}
    for at in _waves([(r["folder"], r["bin"]) for r in plan], wave):
        done["written"] += _merge(spark, path, plan[at])
    return done


def _waves(bins: list[tuple], wave: int) -> list[slice]:
    """Slices of about ``wave`` entries that do not cut a bin."""
    out, begin = [], 0
    for i in range(1, len(bins) + 1):
        if i == len(bins) or (i - begin >= wave and bins[i] != bins[i - 1]):
            out.append(slice(begin, i))
            begin = i
    return out


def _merge(spark: SparkSession, path: str, files: list) -> int:
    staged = f"{path.rstrip('/')}/_merging-{uuid.uuid4().hex}"
    bins = spark.createDataFrame([(r["file"].split(":", 1)[-1].lstrip("/"), f"{r['folder']}|{r['bin']}") for r in files],
                                 "_end string, _bin string")
    whole = spark.read.parquet(path).schema  # a wave's own folders need not tell a partition column's type
    rows = spark.read.schema(whole).option("basePath", path).parquet(*[r["file"] for r in files])
    dated = list(dict.fromkeys(p.split("=", 1)[0] for r in files for p in r["folder"].split("/") if "=" in p))
    end = F.regexp_replace(F.regexp_replace(F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B"))), "^[A-Za-z0-9+.-]+:", ""), "^/+", "")
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file")).withColumn("_end", end)
    dealt = placed.join(bins, "_end").repartition(len({r["folder"] + str(r["bin"]) for r in files}), "_bin")
    dealt = dealt.sortWithinPartitions("_bin").drop("_file", "_end", "_bin")
    writer = dealt.write.mode("error")
    (writer.partitionBy(*dated) if dated else writer).parquet(staged)
    before, after = rows.count(), spark.read.parquet(staged).count()
    if before != after:
        raise RuntimeError(f"{staged} holds {after} rows of {before}; the files were left as they are")
    new = data_files(spark, staged).collect()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    for r in files:
        fs.delete(jvm.org.apache.hadoop.fs.Path(r["file"]), False)
    for r in new:
        folder = posixpath.join(path, r["folder"]) if r["folder"] else path
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(r["file"]), jvm.org.apache.hadoop.fs.Path(folder, r["file"].rsplit("/", 1)[-1])):
            raise RuntimeError(f"{r['file']} could not be moved to {folder}; the merged rows are in {staged}")
    remove_path(spark, staged)
    return len(new)
