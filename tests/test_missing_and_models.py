"""NaN as missing, encodings with nulls and case clashes, exact splits, and the modelling chain."""

import math

import pytest
from pyspark.sql import functions as F

from cleanlane.operators import clean, features, knn, model, profile

NAN = float("nan")


@pytest.fixture(scope="module")
def holed(spark):
    rows = [(float(i), i) for i in range(1, 21)] + [(NAN, None)]
    return spark.createDataFrame(rows, "x double, n long")


def test_nan_is_missing_for_profiles_and_fits(holed):
    assert {r["column"]: r["null_count"] for r in profile.null_profile(holed).collect()} == {"x": 1, "n": 1}
    assert clean.fit_impute(holed) == {"x": 10.5, "n": 10.5}
    (row,) = profile.outlier_counts(holed, ["x"]).collect()
    assert row["n_outliers"] == 0 and row["q1"] == 5.75
    bins = profile.histogram(holed, "x", 4).collect()
    assert sum(r["count"] for r in bins) == 20 and not any(math.isnan(r["lower"]) for r in bins)
    assert features.fit_scale(holed)["params"]["x"][0] == 10.5


def test_nan_stays_missing_where_values_are_capped(holed):
    for out in (clean.winsorize_iqr(holed, ["x"]), clean.apply_caps(holed, {"x": 15.0})):
        assert out.where("n is null").select("x").first()["x"] is None
    assert clean.cap_quantile_by_segment(holed.withColumn("s", F.lit("a")), "s", ["a"], "x").where("n is null").first()["x"] is None
    filled = clean.impute(holed)
    assert dict(filled.dtypes) == {"x": "double", "n": "double"} and filled.where("x is null or n is null").isEmpty()


def test_text_nan_is_no_number(spark):
    raw = spark.createDataFrame([("NaN", "NaN", "nan"), ("3.7", "2.5", "1")], "a string, b string, c string")
    out = clean.coerce_types(raw, {"integer": ["a"], "nullable_integer": ["b"], "float": ["c"]}).orderBy("a").collect()
    assert [tuple(r) for r in out] == [(0, None, None), (3, 2, 1.0)]


def test_null_is_a_class_of_its_own(spark):
    df = spark.createDataFrame([("b",), ("z",), (None,), ("b",)], "k string")
    got = {r["v"]: r["k"] for r in features.encode_categoricals(df.withColumn("v", F.col("k")), ["k"]).collect()}
    assert got == {"b": 0, None: 1, "z": 2}
    whole = features.encode_categoricals(df.where("k is not null").withColumn("v", F.col("k")), ["k"])
    assert {r["v"]: r["k"] for r in whole.collect()} == {"b": 0, "z": 1}


def test_levels_that_differ_in_case_are_columns_of_their_own(spark):
    df = spark.createDataFrame([("A",), ("OTHER",), ("Other",), (None,)], "k string")
    out = features.one_hot(df.withColumn("v", F.col("k")), "k")
    assert out.columns == ["v", "k_OTHER", "k_Other__2"]
    assert {r["v"]: (r["k_OTHER"], r["k_Other__2"]) for r in out.collect()} == {"A": (0, 0), "OTHER": (1, 0), "Other": (0, 1), None: (0, 0)}


def test_very_many_levels_make_one_vector(spark):
    df = spark.range(1200).select(F.format_string("v%04d", "id").alias("k"), F.col("id")).union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    out = features.encode_categoricals(df, ["k"])
    assert out.columns == ["id", "k_onehot"]
    rows = {r["id"]: r["k_onehot"] for r in out.collect()}
    assert rows[-1].numNonzeros() == 0 and rows[0].numNonzeros() == 0
    assert all(v.size == 1199 for v in rows.values())
    assert len({int(v.indices[0]) for i, v in rows.items() if i > 0}) == 1199


def test_codes_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(features, "CODE_SAMPLE", 64)
    df = spark.range(3000).select(F.format_string("v%05d", F.col("id") % 1500).alias("k"), (F.col("id") % 1500).alias("want"))
    assert features.category_codes(df, "k", "code").where("code <> want").isEmpty()


@pytest.mark.parametrize("fraction", [0.25, 0.3, 0.5])
def test_split_is_exact_on_repeated_rows(spark, fraction):
    df = spark.range(1000).select((F.col("id") % 5).alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    train, test = model.stratified_split(df, "label", fraction)
    assert test.count() == math.ceil(1000 * fraction) and train.count() == 1000 - test.count()
    want = {(r["x"], r["label"]): r["count"] for r in df.groupBy("x", "label").count().collect()}
    both = train.union(test)
    assert {(r["x"], r["label"]): r["count"] for r in both.groupBy("x", "label").count().collect()} == want
    assert {r["label"]: r["count"] for r in test.groupBy("label").count().collect()} == model.allocate_test_counts({0.0: 500, 1.0: 500}, fraction)


@pytest.fixture(scope="module")
def planted(spark):
    """Two features in very different units; a quarter of the rows is positive."""
    return spark.range(400).select(
        (F.col("id") * 1000.0 + 1e6).alias("big"), (F.when(F.col("id") % 4 == 0, 1.0).otherwise(0.0) + F.rand(3) * 0.5).alias("small"), F.when(F.col("id") % 4 == 0, 1.0).otherwise(0.0).alias("label")
    )


def test_scaler_then_resampler_then_classifier(spark, planted, monkeypatch):
    seen = {}
    true_smote = model.smote
    monkeypatch.setattr(model, "smote", lambda df, cols, *a, **k: seen.setdefault("out", true_smote(seen.setdefault("in", df), seen.setdefault("cols", cols), *a, **k)))
    fitted = model.fit_pipeline(planted, ["big", "small"], lambda n: model.logistic(seen.setdefault("n", n)), scale=True, resample=True)
    assert seen["cols"] == ["big__scaled", "small__scaled"] and seen["n"] == 600 and seen["in"].count() == 400
    r = seen["in"].agg(F.avg("big__scaled"), F.stddev_pop("big__scaled"), F.avg("small__scaled"), F.stddev_pop("small__scaled")).first()
    assert [round(x, 9) for x in r] == [0.0, 1.0, 0.0, 1.0]
    assert fitted.stages[-1].getRegParam() == 1 / 600
    scored = model.predict(fitted, planted)
    assert scored.where("prediction = label").count() == 400
    assert dict(model.feature_importance(fitted, ["big", "small"]))["small"] > 0.9


def test_grid_search_at_its_default_folds(planted):
    est = model.random_forest(num_trees=5)
    best, results = model.grid_search(planted, ["big", "small"], est, {"maxDepth": [1, 3]}, resample=True)
    rows = results.collect()
    assert len(rows) == 2 and all(r["mean_test_score"] > 0.9 for r in rows) and best.transform(model.assemble(planted, ["big", "small"])).count() == 400


def test_smote_wants_two_classes(spark):
    with pytest.raises(ValueError):
        model.smote(spark.createDataFrame([(1.0, 0.0)], "x double, label double"), ["x"])


def test_nothing_stays_cached(spark, planted):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    model.smote(planted, ["big", "small"]).count()
    knn_out = knn.knn_within(planted.select(F.array("big", "small").alias("vec")), "vec", k=3, rows_per_bucket=50)
    knn_out.count()
    knn_out.unpersist()
    model.fit_pipeline(planted, ["big", "small"], model.logistic, scale=True, resample=True)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_fit_frames_have_partitions_by_cores_not_by_rows(spark, monkeypatch):
    monkeypatch.setattr(model, "FIT_TASK_ROWS", 10)
    cores = spark.sparkContext.defaultParallelism
    many = model.fit_frame(spark.range(2000).repartition(200))
    few = model.fit_frame(spark.range(25).repartition(8))
    assert many.rdd.getNumPartitions() == min(200, 4 * cores) and many.count() == 2000 and few.rdd.getNumPartitions() == 3
    many.unpersist()
    few.unpersist()


def test_rows_of_one_partition_are_spread_for_a_fit(spark, monkeypatch):
    monkeypatch.setattr(model, "SPREAD_TASK_ROWS", 100)
    one = model.fit_frame(spark.range(300).coalesce(1), spread=True)
    assert one.rdd.getNumPartitions() == min(3, 4 * spark.sparkContext.defaultParallelism) and sorted(r["id"] for r in one.collect()) == list(range(300))
    one.unpersist()


def test_fit_frames_of_many_rows_have_partitions_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(model, "FIT_TASKS_PER_CORE", 1)
    monkeypatch.setattr(model, "MAX_TASK_ROWS", 10, raising=False)
    cores = spark.sparkContext.defaultParallelism
    for source in (spark.range(1000).repartition(cores + 150), spark.range(1000).coalesce(2)):
        frame = model.fit_frame(source)
        assert frame.rdd.getNumPartitions() >= 100 and frame.count() == 1000
        frame.unpersist()


def test_rows_are_kept_as_plain_columns_for_a_fit(planted, monkeypatch):
    kept, keep = [], model.fit_frame
    monkeypatch.setattr(model, "fit_frame", lambda df, *a, **k: kept.append(df.dtypes) or keep(df, *a, **k))
    model.fit_pipeline(planted.withColumn("weight", F.lit(2.0)), ["big", "small"], model.random_forest("weight", num_trees=2, max_depth=2))
    model.grid_search(planted, ["big", "small"], model.random_forest(num_trees=2), {"maxDepth": [1, 2]}, folds=2)
    assert dict(kept[0]) == {"big": "double", "small": "double", "label": "double", "weight": "double"}
    assert all(t != "vector" for dtypes in kept for _, t in dtypes)


def test_fits_beside_each_other_share_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(model, "SPREAD_TASK_ROWS", 10)
    monkeypatch.setattr(model, "FIT_TASKS_PER_CORE", 4)
    cores = spark.sparkContext.defaultParallelism
    frame = model.fit_frame(spark.range(4000).coalesce(1), True, 4)
    assert frame.rdd.getNumPartitions() == cores and frame.count() == 4000
    frame.unpersist()


def test_boosted_trees_without_cached_node_ids_are_the_same_model(planted):
    assert not model.boosted_trees().getCacheNodeIds()
    plain, cached = (model.fit_pipeline(planted, ["big", "small"], model.boosted_trees(max_iter=3, max_depth=4, **kw)).stages[-1] for kw in ({}, {"cacheNodeIds": True}))
    assert plain.toDebugString.split("\n")[1:] == cached.toDebugString.split("\n")[1:]
