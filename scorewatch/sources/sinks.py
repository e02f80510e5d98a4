"""Writing reports. A run is a partition, so appending a run archives it and a rerun replaces only itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, run_id: str | None = None, replace: bool = False, fmt: str = "parquet") -> None:
    """Append the report under its run, or with `replace` overwrite just the runs it holds."""
    if run_id is not None:
        df = df.withColumn("run_id", F.lit(run_id))
    writer = df.write.format(fmt).partitionBy("run_id")
    if fmt == "csv":
        writer = writer.option("header", True)
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    else:
        writer.mode("append").save(path)


def write_nested(packet: DataFrame, path: str, run_id: str | None = None, replace: bool = False) -> None:
    """A nested packet as JSON lines, one folder per run."""
    write_report(packet, path, run_id, replace, fmt="json")


def upsert_section(df: DataFrame, path: str, run_id: str, section: str) -> None:
    """Replace one named section of one run in the evidence table; all other partitions stay."""
    payload = df.select(F.to_json(F.struct(*df.columns)).alias("payload"))
    rows = payload.withColumn("run_id", F.lit(run_id)).withColumn("section", F.lit(section))
    rows.write.partitionBy("run_id", "section").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def append_feedback(accepted: DataFrame, path: str) -> None:
    """Accepted feedback events go to the end of the log."""
    accepted.write.mode("append").parquet(path)
