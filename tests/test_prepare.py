import tempfile

import pytest
from pyspark.sql import functions as F

from cleanlane.operators import model, prepare
from cleanlane.plans import training
from cleanlane.sources import io
from cleanlane.streaming import scoring


@pytest.fixture(scope="module")
def raw(spark):
    x = spark.range(1200).select(
        "id", F.rand(1).alias("a"), F.when(F.rand(2) < 0.9, F.floor(F.rand(3) * 9)).alias("b"), F.when(F.rand(4) < 0.9, F.concat(F.lit("it's \\ "), F.floor(F.rand(5) * 4).cast("string"))).alias("kind of"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 300).cast("int")).alias("day"), (F.rand(6) < 0.5).alias("flag")
    )
    odd = x.withColumn("a", F.when(F.col("id") == 5, float("nan")).when(F.col("id") == 6, 1e9).otherwise(F.col("a")))
    return odd.withColumn("y", (F.col("a") + F.coalesce("b", F.lit(3)) / 9 + F.rand(7) > 1.4).cast("int")).drop("id").persist()


def test_steps_learn_from_what_they_are_fitted_on(raw):
    train, other = raw.where("day < '2024-06-01'"), raw.where("day >= '2024-06-01'")
    filled = prepare.Impute(["a", "b", "kind of", "flag"]).fit(train).transform(other)
    assert filled.where("a IS NULL OR isnan(a) OR b IS NULL OR `kind of` IS NULL OR flag IS NULL").isEmpty()
    median = sorted(r["b"] for r in train.where("b IS NOT NULL").collect())
    middle = (median[(len(median) - 1) // 2] + median[len(median) // 2]) / 2
    assert {r["b"] for r in filled.join(other.where("b IS NULL").select("a", "day"), ["a", "day"]).collect()} <= {middle}
    grouped = prepare.Group(["kind of"], 0.2).fit(train).transform(other.withColumn("kind of", F.lit("unseen")))
    assert {r[0] for r in grouped.select("kind of").distinct().collect()} == {"Other"}
    coded = prepare.Encode(["kind of"], 0.001).fit(train).transform(other)
    assert {r[0] for r in coded.select("kind of").distinct().collect()} == {-1.0, 0.0, 1.0, 2.0, 3.0}
    capped = prepare.Winsorise(["a"]).fit(raw).transform(raw)
    assert capped.agg(F.max("a")).first()[0] < 3
    scaled = prepare.Scale(["b"]).fit(filled).transform(filled).agg(F.avg("b"), F.stddev_pop("b")).first()
    assert scaled[0] == pytest.approx(0, abs=1e-9) and scaled[1] == pytest.approx(1)


@pytest.mark.parametrize("name", ["forest", "logistic"])
def test_bundle_of_raw_model_gives_equal_predictions_on_a_stream(spark, raw, name):
    out = tempfile.mkdtemp(prefix="cl-bundle-", dir="/tmp")
    clf = model.random_forest(num_trees=10) if name == "forest" else model.logistic(900, max_iter=50)
    r = training.train_prepared(raw, "y", clf, scale=name == "logistic", out_dir=out)
    assert r.metrics["roc_auc"] > 0.7 and {f for f, _ in r.importance} == {"a", "b", "kind of", "flag", "day_year", "day_month", "day_day"}
    r.release()
    fresh = spark.newSession()
    loaded, info = io.load_model_bundle(fresh, out)
    test = io.read_stage(fresh, out, "test")
    assert info["model"] == "prepared" and io.read_stage(fresh, out, "importance").count() == 7 and io.read_stage(fresh, out, "metrics").count() == 1
    want = sorted(map(tuple, io.read_stage(fresh, out, "predictions").select("label", "prediction", "probability_1").collect()))
    stream = scoring.read_parquet_stream(fresh, io.stage_path(out, "test"), test.schema)
    scored = scoring.score_stream(stream, loaded, keep=["y"])
    scoring.write_stream(scored, f"{out}/scored", f"{out}/progress").awaitTermination()
    got = sorted((float(x["y"]), x["prediction"], x["probability_1"]) for x in fresh.read.parquet(f"{out}/scored").collect())
    assert got == want


def test_flows_keep_their_bundle(spark, raw):
    out = tempfile.mkdtemp(prefix="cl-bundle-", dir="/tmp")
    whole = raw.fillna({"a": 0.5, "b": 3, "kind of": "x"})
    r = training.train_default_forest(whole, "y", num_trees=5, out_dir=out)
    r.release()
    loaded, info = io.load_model_bundle(spark.newSession(), out)
    assert info["model"] == "random_forest" and len(info["features"]) == len(loaded.stages[0].getInputCols())
    test = io.read_stage(spark, out, "test")
    again = model.predict(loaded, test).select("label", "prediction", "probability_1")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, io.read_stage(spark, out, "predictions").collect()))
