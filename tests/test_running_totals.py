import pytest
from pyspark.sql import functions as F

from cleanlane.operators import stats


@pytest.mark.parametrize("descending", [False, True])
def test_buckets_keep_their_size_beyond_the_first_cuts(spark, monkeypatch, descending):
    sizes = []
    real = stats._with_buckets

    def watched(*a):
        out = real(*a)
        sizes.append([r["count"] for r in out.groupBy("_bucket").count().collect()])
        return out

    monkeypatch.setattr(stats, "_with_buckets", watched)
    df = spark.range(20000).select(((F.col("id") * 7919) % 20000).alias("s"), (F.col("id") % 5).alias("y"))
    rows = stats.running_totals(df, "s", ["y"], descending=descending, rows_per_bucket=500, max_buckets=4).orderBy(F.col("s") * (-1 if descending else 1)).collect()
    total = 0
    for r in rows:
        total += r["y"]
        assert r["y_cum"] == total
    assert len(rows) == 20000 and max(sizes[0]) < 1000 and sum(sizes[0]) == 20000
