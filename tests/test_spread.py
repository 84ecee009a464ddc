"""Chains of sorts by one key stay dealt over the session's number of tasks; adaptive execution does not join them."""

import datetime as dt

import numpy as np
import pyarrow as pa

from riskloom.functions import linalg
from riskloom.operators import bitemporal as bt, factors as fa, fundamentals as fu, joins as jn, quality as ql, regressions as rg


def tasks(df):
    return df.rdd.getNumPartitions()


def intervals(spark, rows):
    return spark.createDataFrame([(k, dt.date(2000, 1, a), dt.date(2000, 1, b)) for k, a, b in rows], "id long, from_dt date, thru_dt date")


def test_intervals_are_dealt_by_key(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a = intervals(spark, [(i, d, d + 2) for i in range(40) for d in (1, 2, 9, 12, 20)] + [(None, 1, 5)])
    b = intervals(spark, [(i, 3, 10) for i in range(0, 40, 2)])
    assert tasks(bt.merge_intervals(a, ["id"])) == n
    life = intervals(spark, [(i, 1, 25) for i in range(40)])
    gaps = ql.id_gaps(a, life, "id")
    assert tasks(gaps) == n and gaps.count() == 40 * 4
    left = jn.subtract_intervals(bt.merge_intervals(a, ["id"]), b, ["id"])
    got = sorted((r.from_dt.day, r.thru_dt.day) for r in left.where("id = 2").collect())
    assert got == [(1, 3), (10, 11), (12, 14), (20, 22)]
    assert [(r.from_dt.day, r.thru_dt.day) for r in left.where("id is null").collect()] == [(1, 5)]


def test_growth_with_forecasts_is_dealt_by_key(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(i, dt.date(y, 12, 31), float(100 + i + (y - 2000) * 10)) for i in range(40) for y in range(2000, 2006)]
    annual = spark.createDataFrame(rows, "asset_id long, dt date, value double")
    out = fu.growth(annual, "2004-12-31", forecasts=annual)
    assert tasks(out) == n and out.count() == 40


def test_histories_are_views_of_a_batch():
    at = pa.array([[9], [0, 2], [], [1]], pa.list_(pa.int32())).slice(1)
    x = pa.array([[9.0], [1.0, 2.0], [], [3.0]], pa.list_(pa.float64())).slice(1)
    got = list(fa._histories(at, x))
    assert [(i.tolist(), r.tolist()) for i, r in got] == [([0, 2], [1.0, 2.0]), ([], []), ([1], [3.0])]
    assert all(isinstance(i, np.ndarray) and not i.flags.owndata and not r.flags.owndata for i, r in got)


def test_large_robust_fits_settle_in_few_passes(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(2, 800))
    y = 2 * x + np.where(rng.random(800) < 0.3, 20 * rng.standard_cauchy(800), 0.1 * y)
    df = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(x, y)], "k int, x double, y double")
    fit = rg.huber_cross_section(df, ["k"], ["x"], "y", intercept=True, in_task=0, tol=1e-10).first()
    assert fit.converged and fit.n_passes <= 9
    want = linalg.huber_fit(np.column_stack([np.ones(800), x]), y)
    assert np.allclose(fit.coef, want, atol=1e-7)
