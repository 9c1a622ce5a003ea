import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cleanlane.llm import topk


def brute(rows, k, is_query):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {(i, tuple(v)) for i, v in good if is_query(i)}:
        best = sorted(((-sum(a * b for a, b in zip(q[1], v, strict=False)), math.inf if i is None else i) for i, v in good if i != q[0]))[:k]
        out += [(q[0], r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=str)


def test_like_brute_force(frame):
    rng = np.random.default_rng(5)
    for scale in (0.3, 1e5):
        rows = [(int(i), [float(x) for x in rng.normal(0, scale, 16)]) for i in range(400)]
        rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(5, rows[7][1]), (None, rows[7][1]), (20, rows[20][1])]
        rows += [(40, None), (2000, [1.0, None]), (2001, [float("nan")] * 16), (2002, [float("inf")] * 16), (2020, []), (2003, [1.0, -1.0]), (2040, [0.5] * 20)]
        df = frame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, Score string")
        got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=7, block=16)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 7, lambda i: i is not None and i % 20 == 0)


def test_stops_early_only_on_proof():
    rng = np.random.default_rng(6)
    x = rng.integers(-60, 60, (3000, 32))
    q = rng.integers(-60, 60, (20, 32))
    ids = np.arange(3000)
    possible = topk.search_shard(x, ids, q, np.arange(5000, 5020), 10, np.full(20, -np.inf))
    scores = q @ x.T
    for i in range(20):
        assert possible[i, np.lexsort((ids, -scores[i]))[:10]].all()
    assert possible.sum(1).mean() < 300


def test_empty_and_few(frame):
    none = frame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, F.lit(True)).count() == 0
    few = frame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(few, F.col("vec_id") == 0).collect())) == [(0, 1, 1, 64 * 128)]


@pytest.mark.parametrize("large", [2.0**25, -(2.0**25) - 1, 1e300])
def test_a_component_out_of_range_is_an_error(frame, large):
    rows = frame([(0, [1.0, 1.0]), (1, [large, 1.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="lies beyond"):
        topk.top_k(rows, F.col("vec_id") == 0).collect()


def test_the_largest_component(frame):
    top = (2**31 - 1) / 64
    rows = frame([(0, [1.0]), (1, [top]), (2, [-top])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(rows, F.col("vec_id") == 0).collect())) == [(0, 1, 1, 64 * (2**31 - 1)), (0, 2, 2, -64 * (2**31 - 1))]
