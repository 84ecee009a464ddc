"""Digest trees, funds against blocks of indexes, subspace iteration and nested exposures against plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import linalg
from riskloom.operators import digests as dg, factors as fa, joins as jn, regressions as rg


@pytest.fixture
def rng():
    return np.random.default_rng(11)


def test_one_changed_row_reads_one_range(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    a, b, c = (f"file://{tmp_path}/{x}" for x in "abc")
    dg.write_digested(rows, ["k"], ["v"], a, ranges=64, fan=4)
    dg.write_digested(rows.withColumn("v", F.when(F.col("k") == 1234, None).otherwise(F.col("v"))), ["k"], ["v"], b, ranges=64, fan=4)
    dg.write_digested(rows.repartition(3), ["k"], ["v"], c, ranges=64, fan=4)
    assert dg.differing_ranges(spark, a, c, fan=4) == []
    found = dg.differing_ranges(spark, a, b, fan=4)
    assert len(found) == 1
    part = dg.read_ranges(spark, a, found)
    assert 0 < part.count() < 5000 / 20
    assert "PartitionFilters: [isnotnull(range#" in part._jdf.queryExecution().toString()
    assert [tuple(r) for r in dg.digest_diff(spark, a, b, ["k"], "v", fan=4).collect()] == [(1234, "update", None, 1234 % 7.0)]


def test_digests_tell_order_nulls_and_repeats(spark, tmp_path):
    def root(rows):
        return [tuple(r) for r in dg.digests(spark.createDataFrame(rows, "k string, v string"), ["k"], ["v"], ranges=4, fan=2).where("level = 2").collect()]

    one = [("a", "x"), ("b", None), (None, "y")]
    assert root(one) == root(one[::-1])
    for other in (one + [("a", "x")], [("a", "x"), ("b", ""), (None, "y")], [("a", "x"), ("b", None), ("y", None)], [("a", "x"), ("b", None)]):
        assert root(one) != root(other)
    empty = spark.createDataFrame([], "k long, v double")
    for name, rows in (("e", empty), ("f", spark.createDataFrame([(1, 1.0)], "k long, v double"))):
        dg.write_digested(rows, ["k"], ["v"], f"file://{tmp_path}/{name}", ranges=8, fan=2)
    assert [r.action for r in dg.digest_diff(spark, f"file://{tmp_path}/f", f"file://{tmp_path}/e", ["k"], "v", fan=2).collect()] == ["insert"]
    assert dg.digest_diff(spark, f"file://{tmp_path}/e", f"file://{tmp_path}/e", ["k"], "v", fan=2).count() == 0


def plain_funds(y, x, places, sizes, own, least, k, threshold):
    out = {}
    for f in range(y.shape[0]):
        rows = []
        for i in range(x.shape[0]):
            ok = np.isfinite(y[f]) & np.isfinite(x[i])
            if ok.sum() >= least and (places is None or places[i] == own[f][0]):
                te = round(float(np.std(y[f, ok] - x[i, ok], ddof=1)), 9)
                if threshold is None or te <= threshold:
                    rows.append((te, abs(sizes[i] - own[f][1]) if places is not None else 0, i, int(ok.sum())))
        for p, (te, _, i, n) in enumerate(sorted(rows)[:k]):
            out[f, p + 1] = (i, te, n)
    return out


@pytest.mark.parametrize("gaps, info, threshold", [(0.0, False, None), (0.2, True, None), (0.0, True, 1.0), (0.1, False, 0.9)])
def test_funds_against_all_pairs(spark, rng, gaps, info, threshold):
    steps, n_i, n_f = 40, 60, 25
    scale = rng.uniform(0.2, 3, n_i)
    x = rng.normal(size=(n_i, steps)) * scale[:, None]
    y = x[rng.integers(0, n_i, n_f)] + 0.3 * rng.normal(size=(n_f, steps))
    x[5] = x[6]  # a tie
    y[0] = x[5] + 0.1 * rng.normal(size=steps)
    x[rng.random(x.shape) < gaps], y[rng.random(y.shape) < gaps] = np.nan, np.nan
    y[1, 3:] = np.nan  # too short
    places = [["a"], ["b"], ["a", "b"]]

    def long(m, key):
        return spark.createDataFrame([(i, t, float(v)) for i, r in enumerate(m) for t, v in enumerate(r) if np.isfinite(v)], f"{key} long, t int, r double")

    own = [(("a",) if f % 2 else ("a", "b"), f) for f in range(n_f)]
    fi = spark.createDataFrame([(f, list(p)[::-1], s) for f, (p, s) in enumerate(own)], "fund long, countries array<string>, n_assets long")
    ii = spark.createDataFrame([(i, places[i % 3], i) for i in range(n_i)], "idx long, countries array<string>, n_assets long")
    out = jn.match_funds(long(y, "fund"), long(x, "idx"), "fund", "idx", "t", "r", 5, threshold, 3, fi if info else None, ii if info else None, block=16).collect()
    want = plain_funds(y, x, [tuple(places[i % 3]) for i in range(n_i)] if info else None, list(range(n_i)), own, 5, 3, threshold)
    assert {(r.fund, r.place): (r.idx, r.te, r.n) for r in out} == want
    if not gaps and not info:  # the bound spares pairs of whole histories
        one = jn.match_funds(long(y, "fund"), long(x, "idx"), "fund", "idx", "t", "r", 5, None, 1).collect()
        assert {(r.fund, r.place): (r.idx, r.te, r.n) for r in one} == plain_funds(y, x, None, [0] * n_i, own, 5, 1, None)
        looked = [r.candidates for r in one if np.isfinite(y[r.fund]).all()]
        assert np.mean(looked) < 0.7 * n_i


def test_funds_of_empty_tables(spark):
    none = spark.createDataFrame([], "fund long, t int, r double")
    some = spark.createDataFrame([(1, 1, 0.5)], "idx long, t int, r double")
    assert jn.match_funds(none, some, "fund", "idx", "t", "r").count() == 0
    assert jn.match_funds(some.withColumnRenamed("idx", "fund"), none.withColumnRenamed("fund", "idx"), "fund", "idx", "t", "r").count() == 0


def test_subspace_finds_the_leading_vectors(spark, rng):
    t, n, k = 400, 150, 3
    r = rng.normal(size=(t, k)) * [6, 4, 2.5] @ rng.normal(size=(k, n)) / np.sqrt(k) + rng.normal(size=(t, n))
    r[rng.random(r.shape) < 0.1] = 0.0
    df = spark.createDataFrame(pd.DataFrame([(j, i, r[i, j]) for i in range(t) for j in range(n) if r[i, j] or i == j], columns=["id", "dt", "ret"])).repartition(6)
    f, exp, stats = fa.subspace_components(df, "id", "dt", "ret", k, tol=1e-12, most=60)
    u, s, v = np.linalg.svd(r, full_matrices=False)
    got = f.orderBy("dt").toPandas()[["f1", "f2", "f3"]].to_numpy()
    assert np.allclose(np.abs((got * u[:, :k]).sum(axis=0)), 1, atol=1e-5)
    load = exp.orderBy("id").toPandas()[["f1", "f2", "f3"]].to_numpy()
    assert np.allclose(load, r.T @ got, atol=1e-6)
    row = stats.first()
    assert row.converged and row.explained == pytest.approx((s[:k] ** 2).sum() / (s**2).sum(), abs=1e-6)
    assert not fa.subspace_components(df, "id", "dt", "ret", k, tol=0.0, most=2)[2].first().converged
    few = df.where("dt < 2")
    assert fa.subspace_components(few, "id", "dt", "ret", k)[0].count() == 2


def staged(x, y, blocks, orthogonal):
    b, left, used = np.zeros(x.shape[1]), y.copy(), []
    for block in blocks:
        z = x[:, block]
        if orthogonal and used:
            z = z - x[:, used] @ np.linalg.lstsq(x[:, used], z, rcond=None)[0]
        b[block] = np.linalg.lstsq(z, left, rcond=None)[0]
        left = left - z @ b[block]
        used = used + list(block)
    return b


@pytest.mark.parametrize("orthogonal", [True, False])
def test_nested_exposures_are_staged_fits(spark, rng, orthogonal):
    n = 80
    x = rng.normal(size=(n, 5)) @ (np.eye(5) + 0.4)
    x[:, 3] = 0.0
    y = rng.normal(size=(n, 3))
    names = [f"f{i}" for i in range(5)]
    rows = [(a, s, *map(float, x[t]), float(y[t, a])) for a, s in ((0, "u"), (1, "v"), (2, None)) for t in range(n)]
    df = spark.createDataFrame(rows, "id int, sector string, f0 double, f1 double, f2 double, f3 double, f4 double, r double")
    got = rg.nested_exposure(df, "id", "r", [["f0", "f1"], ["f2", "f3"], ["f4"]], orthogonal).orderBy("id").toPandas()[names].to_numpy()
    for a in range(3):
        assert np.allclose(got[a], staged(x, y[:, a], [[0, 1], [2], [4]], orthogonal), atol=1e-8)
    kw = {"sector": "sector", "sector_factors": {"u": "f1", "v": "f4"}}
    own = rg.nested_exposure(df, "id", "r", [["f0", "f1"], ["f2", "f4"]], orthogonal, **kw).orderBy("id").toPandas()[["f0", "f1", "f2", "f4"]].to_numpy()
    for a, blocks in enumerate(([[0, 1], [2]], [[0], [2, 4]], [[0, 1], [2, 4]])):
        assert np.allclose(own[a], staged(x, y[:, a], blocks, orthogonal)[[0, 1, 2, 4]], atol=1e-8)
    last = rg.nested_exposure(df, "id", "r", [["f1", "f0"], ["f2", "f4"]], orthogonal, **kw, sector_last=True).orderBy("id").toPandas()[["f0", "f1", "f2", "f4"]].to_numpy()
    for a, blocks in enumerate(([[0], [2], [1]], [[0], [2], [4]])):
        assert np.allclose(last[a], staged(x, y[:, a], blocks, orthogonal)[[0, 1, 2, 4]], atol=1e-8)
    assert linalg.nested_normal(np.zeros((2, 2)), np.zeros(2), [[0], [1]], True).tolist() == [0, 0]
