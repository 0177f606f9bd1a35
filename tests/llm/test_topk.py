"""Exact top-k search against all products in whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldweave.llm.common import scratch
from goldweave.llm.topk import Settings, exact_top_k

LONG = 1 << 63


def plain(rows, asks, k, scale=64):
    whole = lambda x: int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale)
    sound = [(i, [whole(float(x)) for x in v]) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for a, (i, v) in enumerate(sound):
        if asks(i):
            scored = [(-min(max(sum(x * y for x, y in zip(v, w)), 1 - LONG), LONG - 1), j is None, j or 0) for b, (j, w) in enumerate(sound) if b != a]
            out += [(i, rank + 1, None if gone else j, -s) for rank, (s, gone, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def check(spark, rows, cfg, kind="float"):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) if kind == "float" else float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, row string, score int")
    got = exact_top_k(df, F.col("vec_id") % 20 == 0, scratch(spark, "test"), cfg)
    assert got.columns == ["query_id", "rank", "neighbour_id", "score"]
    ours = sorted(((r.query_id, r["rank"], r.neighbour_id, r.score) for r in got.collect()), key=str)
    assert ours == plain(rows, lambda i: i is not None and i % 20 == 0, cfg.k)
    return ours


@pytest.mark.parametrize("cfg", [Settings(k=5), Settings(k=5, values=40, tile=3, fan=2), Settings(k=20, values=64, tile=7)])
def test_small_tables_in_parts_of_any_size(spark, cfg):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6)) for i in range(60)]
    rows += [(100 + i, rows[4][1]) for i in range(30)]  # copies, with the ties that they make
    rows += [(40, rows[4][1]), (40, rows[4][1]), (None, rows[7][1]), (200, []), (201, [0.0] * 6), (220, [-0.001, 5.0]), (221, rng.normal(size=9))]
    rows += [(240, None), (241, [1.0, None]), (242, [float("nan")]), (260, [float("inf"), 1.0])]
    check(spark, rows, cfg)


def test_components_beyond_floating_point(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4) * 10.0 ** rng.integers(-3, 30)) for i in range(50)]
    rows += [(80, [3e4] * 4), (81, [3e4, -3e4, 3e4, 1e-3]), (60, [1e18, 1.0, -1e18, 0.25])]
    check(spark, rows, Settings(k=7))
    check(spark, rows + [(100, [1e300, 1.7e308, 1.0, -1.0])], Settings(k=7, values=50, tile=5), "double")


def test_empty_tables_and_no_queries(spark):
    assert check(spark, [], Settings()) == []
    assert check(spark, [(1, [1.0]), (2, [2.0])], Settings()) == []
    assert check(spark, [(20, [1.0])], Settings()) == []
    assert len(check(spark, [(20, [1.0]), (40, [2.0])], Settings())) == 2


def test_one_vector_holds_a_third_of_all_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(i, np.ones(8) if i % 3 == 0 else rng.normal(size=8)) for i in range(300)]
    check(spark, rows, Settings(k=20, values=500, tile=16, fan=3))
