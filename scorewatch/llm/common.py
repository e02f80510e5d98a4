"""Small helpers of the corpus operators: words, pinned tables, a global order without a one-task window."""

from __future__ import annotations

import gc
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, checkpoints, discard, keyed_join, shared_path, stored

__all__ = ["BROADCAST_ROWS", "Scratch", "checkpoints", "discard", "keyed_join", "shared_path", "stored"]

# Characters that separate words: space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z, all other characters as they are (`lower` would also change letters outside ASCII)."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(column: Column) -> Column:
    return F.regexp_count(column, F.lit(WORD)).cast("long")


def global_index(df: DataFrame, *order: Column) -> DataFrame:
    """Rows with `position`, 0 for the first in `order`.

    Range partitions are sorted apart and offset by the sizes of those before them, so no task sees all rows; the
    driver gets one count per partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    sizes = {r[0]: r[1] for r in ranged.groupBy("__part").count().collect()}
    starts, total = [], 0
    for p in sorted(sizes):
        starts.append((p, total))
        total += sizes[p]
    offsets = spark.createDataFrame(starts or [(0, 0)], "__part int, __start long")
    inner = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (
        ranged.withColumn("__row", inner)
        .join(F.broadcast(offsets), "__part")
        .withColumn("position", F.col("__start") + F.col("__row") - 1)
        .drop("__part", "__start", "__row")
    )


class Covered:
    """The places that some spans cover; looked up in logarithmic time."""

    def __init__(self, spans):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at < len(self.ends) and self.starts[at] < end


class Scratch:
    """Intermediate tables in the shared folder, dropped as soon as nothing later reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop_others(self, *kept: DataFrame) -> None:
        """Delete all tables but these."""
        self.drop(*[t for t, _ in list(self.paths.values()) if not any(t is k for k in kept)])

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables, and let the driver's garbage collection release the shuffle files of finished plans."""
        jvm = self.spark.sparkContext._jvm
        for t in tables:
            _, path = self.paths.pop(id(t))
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        gc.collect()
        jvm.System.gc()
