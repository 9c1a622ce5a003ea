import os
import tempfile

from pyspark.sql import functions as F

from cleanlane.operators import clean, features
from cleanlane.sources import io
from cleanlane.streaming import scoring


def test_stage_roundtrip_and_fallback(spark):
    d = tempfile.mkdtemp(prefix="cl-io-", dir="/tmp")
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, 3.0)], "id int, s string, v double")
    io.write_stage(df, d, "s1")
    back = io.read_stage(spark, d, "s1")
    assert sorted(back.collect()) == sorted(df.collect())
    io.write_stage(df, d, "s1csv", fmt="csv")
    csv = io.read_csv(spark, f"{d}/s1csv", "id int, s string, v double")
    assert csv.count() == 2
    got = io.read_binary_else_csv(spark, f"{d}/missing", f"{d}/s1csv", "id int, s string, v double")
    assert got.count() == 2
    try:
        io.read_binary_else_csv(spark, f"{d}/missing", f"{d}/missing_too")
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass
    io.write_small_table(df, f"{d}/small")
    assert len([f for f in os.listdir(f"{d}/small") if f.endswith(".csv")]) == 1


def test_fitted_steps_apply_to_a_stream(spark):
    d = tempfile.mkdtemp(prefix="cl-stream-", dir="/tmp")
    batch = spark.createDataFrame([(float(i), "x" if i % 3 else None) for i in range(30)], "v double, s string")
    fences = clean.fit_winsorize(batch.union(spark.createDataFrame([(1000.0, "x")], "v double, s string")))
    fill = clean.fit_impute(batch)
    batch.write.parquet(f"{d}/in")
    stream = scoring.read_parquet_stream(spark, f"{d}/in", batch.schema)
    out = scoring.apply_steps(stream, [lambda x: clean.apply_impute(x, fill), lambda x: clean.apply_winsorize(x, fences), features.bucket_flags])
    q = scoring.write_stream(out, f"{d}/out", f"{d}/chk")
    q.awaitTermination(120)
    res = spark.read.parquet(f"{d}/out")
    assert res.count() == 30
    assert res.where(F.col("s").isNull()).count() == 0
