"""Reading review inputs: tables, metadata objects, optional reference predictions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def require_paths(spark: SparkSession, paths) -> None:
    """Fail once, naming every missing input."""
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise FileNotFoundError("missing review inputs: " + ", ".join(missing))


def read_table(spark: SparkSession, path: str, schema: str | T.StructType | None = None, fmt: str | None = None) -> DataFrame:
    """CSV, JSON, ORC or Parquet by suffix or `fmt`. Give CSV and JSON an explicit schema for large inputs."""
    kind = fmt or next((k for k in ("csv", "json", "orc") if path.rstrip("/").endswith(f".{k}")), "parquet")
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    return reader.load(path)


def read_reference(spark: SparkSession, path: str | None, schema=None) -> DataFrame | None:
    """Reference predictions, or None when there is no such log."""
    return read_table(spark, path, schema) if path and exists(spark, path) else None


def read_object(spark: SparkSession, path: str) -> dict:
    """A small metadata file holding one JSON object."""
    require_paths(spark, [path])
    value = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(value, dict):
        raise ValueError(f"expected a JSON object in {path}")
    return value


FEATURE_SCHEMA = (
    "feature string, type string, feature_group string, business_definition string,"
    " expected_min double, expected_max double"
)


def feature_metadata(spark: SparkSession, features: list[dict]) -> DataFrame:
    """Declared features as rows."""

    def number(v):
        return None if v is None else float(v)

    rows = [
        (
            f["name"],
            f.get("type", "numeric"),
            f.get("feature_group", "model_feature"),
            f.get("business_definition", ""),
            number(f.get("expected_min")),
            number(f.get("expected_max")),
        )
        for f in features
        if f.get("name")
    ]
    return spark.createDataFrame(rows, FEATURE_SCHEMA)


def declared_bounds(features: list[dict]) -> dict[str, tuple]:
    """{feature: (lower, upper)} of the declared limits; an undeclared side is None."""
    return {f["name"]: (f.get("expected_min"), f.get("expected_max")) for f in features if f.get("name")}
