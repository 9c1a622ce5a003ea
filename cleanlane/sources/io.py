"""Readers and writers.

Parquet is the default format (typed, column-pruned, predicate push-down);
CSV is supported with an explicit schema.  Writers overwrite a whole stage
directory so a re-run after a lost executor replaces partial output.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """Header CSV scan; explicit schema unless exploring (then types are inferred)."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_binary_else_csv(spark: SparkSession, parquet_path: str, csv_path: str | None = None, schema=None) -> DataFrame:
    """Prefer the typed parquet snapshot, fall back to CSV, else FileNotFoundError."""
    if _exists(spark, parquet_path):
        return spark.read.parquet(parquet_path)
    if csv_path and _exists(spark, csv_path):
        return read_csv(spark, csv_path, schema)
    raise FileNotFoundError(f"neither {parquet_path} nor {csv_path} exists")


def stage_path(out_dir: str, stage: str) -> str:
    return f"{out_dir.rstrip('/')}/{stage}"


def write_stage(df: DataFrame, out_dir: str, stage: str, fmt: str = "parquet") -> str:
    """Write one pipeline stage (parquet keeps types; csv with header)."""
    path = stage_path(out_dir, stage)
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def read_stage(spark: SparkSession, out_dir: str, stage: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(stage_path(out_dir, stage))


def write_small_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Small result tables (importances, comparisons) as one file."""
    w = df.coalesce(1).write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
    return path


def save_model_bundle(spark: SparkSession, out_dir: str, model=None, tables: Mapping[str, DataFrame] | None = None, info: Mapping | None = None) -> str:
    """Fitted ``PipelineModel`` + metric/importance/test tables as parquet + a JSON info record."""
    base = out_dir.rstrip("/")
    if model is not None:
        model.write().overwrite().save(f"{base}/model")
    for name, t in (tables or {}).items():
        t.write.mode("overwrite").parquet(f"{base}/{name}")
    if info is not None:
        spark.createDataFrame([(json.dumps(info, default=str),)], "info string").coalesce(1).write.mode("overwrite").json(f"{base}/info")
    return base


def load_model_bundle(spark: SparkSession, out_dir: str) -> tuple:
    """(fitted ``PipelineModel``, the info record); the tables are read with ``read_stage``."""
    from pyspark.ml import PipelineModel

    base = out_dir.rstrip("/")
    info = json.loads(spark.read.json(f"{base}/info").first()["info"]) if _exists(spark, f"{base}/info") else {}
    return PipelineModel.load(f"{base}/model"), info
