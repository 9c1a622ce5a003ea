"""Fitted transforms on streams.

The reference has no stream operator; what carries over is that every
``apply_*`` step (imputation values, fences, caps, frequent sets, top levels,
scaling parameters) is pure column work learned by a batch ``fit_*``.  Those
steps, and a fitted ``PipelineModel``, apply unchanged to a streaming
DataFrame from ``readStream`` — no state, no watermark needed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over a folder of parquet files with a fixed schema."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def apply_steps(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Chain batch-fitted, stateless ``apply`` steps; works for batch and streaming frames alike."""
    for step in steps:
        df = step(df)
    return df


def score_stream(df: DataFrame, model, keep: Sequence[str] = ()) -> DataFrame:
    """Apply a fitted ``PipelineModel`` to a stream: keeps ``keep`` + prediction + class-1 probability."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    return out.select(*keep, "prediction", vector_to_array("probability")[1].alias("probability_1"))


def write_stream(df: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append the scored stream to parquet; ``checkpoint`` must be on shared storage."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
