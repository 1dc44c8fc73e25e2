"""Session helpers. The library never creates a cluster session itself; it reads what the session says."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on; applied only in tests/bench where the caller owns the session.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", app_name: str = "ledgerproof", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster job gets its session from the platform."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests) may go without: it gets a private folder, which is recorded. On a cluster a folder
    of the driver's machine would be out of the executors' reach, so the missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="ledgerproof-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``SparkContext.setCheckpointDir`` at the shared folder so ``DataFrame.checkpoint()`` works."""
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_root(spark), *parts)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint folder and reading it back.

    One write (no recomputation, unlike an eager RDD checkpoint of an unpersisted plan), compressed
    columnar storage, and later reads get column pruning, filter pushdown and the vectorised reader.
    The folder survives executor loss; the caller owns its lifetime.
    """
    return materialize_at(df, label)[0]


def materialize_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``materialize`` that also returns the folder, for callers that delete it when done."""
    path = scratch_path(df.sparkSession, f"{label}-{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the Hadoop file system of its URI (works on any cluster store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def sizing_conf(input_bytes: int, total_cores: int, *, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run: partitions of ~``partition_bytes`` so a task's share
    fits executor memory and spills rarely, never fewer than two waves of the cluster's cores. AQE then
    coalesces small shuffles and splits skewed partitions at run time."""
    shuffle_partitions = max(2 * total_cores, -(-input_bytes // partition_bytes))
    size = f"{partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
