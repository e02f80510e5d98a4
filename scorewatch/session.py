"""Session helpers: where to pin intermediate tables, and joins that keep null keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A per-key table may be broadcast up to this many rows; beyond it the join shuffles.
BROADCAST_ROWS = 20_000


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a temp folder in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="scorewatch-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoints(spark: SparkSession) -> None:
    """Make sure the context has a checkpoint folder."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def pin(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so the rows are computed once and survive lost executors."""
    checkpoints(df.sparkSession)
    return df.checkpoint()


def ordered(df: DataFrame, group_cols, *order) -> DataFrame:
    """Sort a report without an exchange: one review is one bounded partition; of many, each partition is sorted."""
    return df.sortWithinPartitions(*group_cols, *order) if group_cols else df.coalesce(1).sortWithinPartitions(*order)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the shared folder and read it back: for derived inputs that several scans follow."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a table that `stored` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def bounded(df: DataFrame, group_cols) -> tuple[DataFrame, bool]:
    """A per-group table to be joined to big rows, and whether it may be broadcast.

    Without groups its rows are fixed by the schema. With groups it is pinned and counted: past BROADCAST_ROWS
    the join shuffles, and adaptive execution splits hot groups.
    """
    if not group_cols:
        return df, True
    small = pin(df)
    return small, small.count() <= BROADCAST_ROWS


def keyed_join(left: DataFrame, right: DataFrame, keys, how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Equi-join on `keys` where null keys match each other; the result keeps the left key columns."""
    keys = list(keys)
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = F.expr(" AND ".join(f"`{k}` <=> `__{k}`" for k in keys))
    joined = left.join(F.broadcast(right) if broadcast else right, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__{k}" for k in keys])


def join_per_group(left: DataFrame, right: DataFrame, group_cols, how: str = "left", broadcast: bool = False) -> DataFrame:
    """Attach one row per group. Without group columns `right` is one row, matched on a constant key.

    The one-row side is broadcast (its size is fixed); a per-group side only when the caller checked its size.
    """
    if group_cols:
        return keyed_join(left, right, group_cols, how, broadcast)
    return keyed_join(
        left.withColumn("one_group", F.lit(1)), right.withColumn("one_group", F.lit(1)), ["one_group"], how, broadcast=True
    ).drop("one_group")
