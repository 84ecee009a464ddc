"""Operators that SQL cannot express, against numpy on small frames, and identities."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import linalg
from riskloom.operators import aggregates as ag, crossprod as cp, factors as fa, ranks, regressions as rg, risk as rk, standardize as sd, timeseries as ts, universe as un


@pytest.fixture(scope="module")
def rng():
    return np.random.default_rng(7)


def frame(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


# --- order statistics ---------------------------------------------------------------------


def hazen(x, p):
    y = np.sort(x)
    pos = min(max(p * len(y) / 100 - 0.5, 0), len(y) - 1)
    lo = int(math.floor(pos))
    hi = min(lo + 1, len(y) - 1)
    return y[lo] + (pos - lo) * (y[hi] - y[lo])


def test_percentiles_match_brute_force_on_skewed_groups(spark, rng):
    # one group holds most rows and many ties at zero; values span signs and scales
    g = np.array(["hot"] * 900 + ["cold"] * 97 + ["two"] * 2 + ["one"])
    v = np.concatenate([np.where(rng.random(900) < 0.4, 0.0, rng.normal(size=900) ** 3), np.exp(rng.normal(size=97) * 5), [1.0, -1.0], [3.0]])
    df = frame(spark, g=g, v=v)
    pts = {"a": 2.5, "b": 25.0, "c": 50.0, "d": 97.5}
    for history in (False, True):
        out = ranks.percentiles(df, ["g"], "v", pts, history=history).toPandas().set_index("g")
        for k in ("hot", "cold", "two", "one"):
            for n, p in pts.items():
                assert out.loc[k, n] == pytest.approx(hazen(v[g == k], p), abs=1e-12)


def test_percentiles_without_keys_and_with_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (3.0,), (4.0,)], "v double")
    r = ranks.percentiles(df, [], "v", {"q": 25.0}).first()
    assert r.q == 1.5 and r.n == 4


def test_running_by_rank_matches_sort(spark, rng):
    v = np.round(rng.normal(size=500), 1)
    v[:200] = 0.0
    df = frame(spark, k=np.where(np.arange(500) < 400, "a", "b"), id=rng.permutation(500), v=v, s=rng.random(500))
    got = ranks.running_by_rank(df, ["k"], "v", "id", {"run": "s"}).toPandas()
    for k, p in df.toPandas().groupby("k"):
        want = p.sort_values(["v", "id"], ascending=[False, True]).reset_index(drop=True)
        mine = got[got.k == k].sort_values("rank").reset_index(drop=True)
        assert (mine.id == want.id).all()
        assert np.allclose(mine.run, want.s.cumsum()) and np.allclose(mine.run_total, want.s.sum())


def test_mad_keeps_share_of_zeros(spark):
    x = np.array([0.0] * 6 + [1.0, 2.0, 3.0, 4.0])
    b = ranks.mad_bounds(frame(spark, k=["a"] * 10, v=x), ["k"], "v", 2.0, zero_tolerance=0.25).first()
    kept = np.array([0.0, 0.0, 1.0, 2.0, 3.0, 4.0])
    med = np.median(kept)
    assert b.centre == med and b.scale == pytest.approx(np.median(np.abs(kept - med)) / 0.67449)


def test_order_bucket_is_monotone(spark):
    v = np.sort(np.concatenate([-np.logspace(-9, 12, 400), [0.0], np.logspace(-9, 12, 400)]))
    b = frame(spark, v=v).select("v", ranks.order_bucket(F.col("v")).alias("b")).toPandas().sort_values("v").b.to_numpy()
    assert (np.diff(b) >= 0).all() and b[np.searchsorted(v, 0.0)] == 0


# --- regressions --------------------------------------------------------------------------


def test_golden_least_squares(spark):
    df = frame(spark, k=[1] * 5, y=[1.0, 0, 1, 0, 1], a=[1.0, 2, 3, 4, 5], b=[0.0, 1, 0, 1, 0], w=[1.0, 1, 1, 0, 0])
    c = rg.wls(df, ["k"], ["a", "b"], "y").first().coef
    assert c == pytest.approx([0.24324324, -0.72972973], abs=1e-8)
    assert rg.wls(df, ["k"], ["a", "b"], "y", "w").first().coef == pytest.approx([0.4, -0.8], abs=1e-12)


def test_blocked_products_equal_generated_ones(spark, rng, monkeypatch):
    n, k = 300, 6
    pdf = pd.DataFrame(rng.normal(size=(n, k)), columns=[f"x{i}" for i in range(k)])
    pdf["y"], pdf["w"], pdf["d"] = rng.normal(size=n), rng.random(n), rng.integers(0, 4, n)
    df = spark.createDataFrame(pdf).repartition(5)
    xs = [f"x{i}" for i in range(k)]
    a = cp.cross_products(df, ["d"], xs, "y", "w", True).toPandas().set_index("d")
    monkeypatch.setattr(cp, "COLUMN_LIMIT", 2)
    b = cp.cross_products(df, ["d"], xs, "y", "w", True).toPandas().set_index("d")
    for d in range(4):
        assert np.allclose(a.loc[d, "xtx"], b.loc[d, "xtx"]) and np.allclose(a.loc[d, "xty"], b.loc[d, "xty"])
        assert a.loc[d, "n"] == b.loc[d, "n"] and a.loc[d, "yty"] == pytest.approx(b.loc[d, "yty"])


def test_residuals_are_orthogonal(spark, rng):
    pdf = pd.DataFrame({"d": np.repeat([1, 2], 50), "a": rng.normal(size=100), "b": rng.normal(size=100), "y": rng.normal(size=100), "w": rng.random(100)})
    df = spark.createDataFrame(pdf)
    fit = rg.wls(df, ["d"], ["a", "b"], "y", "w", True)
    e = rg.residuals(df, fit, ["d"], ["a", "b"], "y", True).toPandas()
    for _, g in e.groupby("d"):
        assert abs((g.w * g.resid).sum()) < 1e-9 and abs((g.w * g.resid * g.a).sum()) < 1e-9


def test_constrained_fit_meets_constraint(spark, rng):
    pdf = pd.DataFrame(rng.normal(size=(80, 4)), columns=["a", "b", "c", "y"]).assign(k=0)
    c = np.array(rg.constrained_wls(spark.createDataFrame(pdf), ["k"], ["a", "b", "c"], "y", [[1, 1, 1]], [1.0]).first().coef)
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf.y.to_numpy()
    z = np.array([[1, 0], [0, 1], [-1, -1]])
    base = np.array([0, 0, 1.0])
    t = np.linalg.lstsq(x @ z, y - x @ base, rcond=None)[0]
    assert c.sum() == pytest.approx(1.0) and c == pytest.approx(base + z @ t)


def test_nnls_beats_every_subset(rng):
    for _ in range(20):
        x, y = rng.normal(size=(30, 4)), rng.normal(size=30)
        b = linalg.nnls_normal((x.T @ x).ravel(), x.T @ y)
        best = min(
            (np.sum((y - x[:, s] @ c) ** 2) for m in range(1, 16) for s in [[i for i in range(4) if m >> i & 1]] for c in [np.linalg.lstsq(x[:, s], y, rcond=None)[0]] if (c >= -1e-12).all()),
            default=np.sum(y**2),
        )
        assert (b >= 0).all() and np.sum((y - x @ b) ** 2) <= min(best, np.sum(y**2)) + 1e-8


def test_huber_resists_outliers(spark, rng):
    x = rng.normal(size=200)
    y = 2.0 * x + rng.normal(size=200) * 0.1
    y[:10] += 100
    df = frame(spark, k=[1] * 200, x=x, y=y)
    c = rg.huber_cross_section(df, ["k"], ["x"], "y", intercept=True).first().coef
    assert c[1] == pytest.approx(2.0, abs=0.05)
    assert linalg.huber_fit(np.column_stack([np.ones(200), x]), y)[1] == pytest.approx(c[1], abs=0.01)


def fixed_scale_fit(x, y, w, k):
    """The scale of two passes, then the convex loss by Newton's steps with halving."""
    r = np.sqrt(w)
    xw, yw = x * r[:, None], y * r
    b = np.linalg.lstsq(xw, yw, rcond=None)[0]
    for i in range(2):
        e = yw - xw @ b
        s = np.median(np.abs(e - np.median(e))) / 0.67449
        u = np.minimum(1, k * s / np.maximum(np.abs(e), 1e-300))
        b = np.linalg.lstsq(xw * np.sqrt(u)[:, None], yw * np.sqrt(u), rcond=None)[0]

    def loss(b):
        e = np.abs(yw - xw @ b)
        return np.where(e <= k * s, e * e / 2, k * s * e - (k * s) ** 2 / 2).sum()

    for _ in range(200):
        e = yw - xw @ b
        near = np.abs(e) <= k * s
        step = np.linalg.lstsq(xw[near].T @ xw[near] + 1e-12 * np.eye(len(b)), xw.T @ np.clip(e, -k * s, k * s), rcond=None)[0]
        t = 1.0
        while loss(b + t * step) > loss(b) and t > 1e-9:
            t /= 2
        b = b + t * step
    return b


def test_huber_settles_and_agrees_with_newton(rng):
    for n, k in ((6, 1.345), (40, 1.345), (81, 5.0), (400, 1.345)):
        for _ in range(10):
            x = np.column_stack([np.ones(n), rng.normal(size=n)])
            y, w = 0.3 * x[:, 1] + rng.standard_t(2, size=n), rng.uniform(0.5, 2, n)
            b, done, _ = linalg.huber_solve(x, y, w, k)
            assert done and np.allclose(b, fixed_scale_fit(x, y, w, k), atol=1e-6)


def test_huber_on_ties_constants_and_few_rows(spark):
    rows = [("tied", i % 2, 1.0 if i < 8 else 9.0) for i in range(12)] + [("constant", i, 3.0) for i in range(9)] + [(f"few{n}", i, float(i * i)) for n in range(1, 6) for i in range(n)] + [("same_x", 1, float(i)) for i in range(7)]
    df = spark.createDataFrame([(k, float(x), y) for k, x, y in rows], "k string, x double, y double")
    got = {r.k: r for r in rg.huber_cross_section(df, ["k"], ["x"], "y", intercept=True).collect()}
    assert all(r.converged for r in got.values()) and len(got) == 8
    assert list(got["few1"].coef) == [0.0, 0.0] and got["constant"].coef[0] == pytest.approx(3.0) and got["constant"].coef[1] == pytest.approx(0.0, abs=1e-9)
    hist = {r.k: r for r in rg.huber_history(df, "k", ["x"], "y").collect()}
    assert hist["few3"].x == 0.0 and all(r.converged for r in hist.values())


def test_huber_by_sums_equals_fits_in_tasks(spark, rng):
    n = 300
    df = frame(spark, k=["a", "b"] * n, x=rng.normal(size=2 * n), y=rng.standard_t(3, size=2 * n), w=rng.uniform(0.5, 2, 2 * n))
    one = {r.k: r for r in rg.huber_cross_section(df, ["k"], ["x"], "y", "w", intercept=True).collect()}
    two = {r.k: r for r in rg.huber_cross_section(df, ["k"], ["x"], "y", "w", intercept=True, in_task=0, tol=1e-5).collect()}
    assert one.keys() == two.keys()
    for key, r in one.items():
        assert r.converged and two[key].converged and list(r.coef) == pytest.approx(list(two[key].coef), abs=1e-4)
    assert rg.huber_cross_section(df, [], ["x"], "y", "w", intercept=True).columns == ["n", "coef", "converged", "n_passes"]


def test_huber_that_has_no_time_says_so(spark, rng):
    df = frame(spark, k=["a"] * 50, x=rng.normal(size=50), y=rng.standard_t(1, size=50))
    assert not rg.huber_cross_section(df, ["k"], ["x"], "y", intercept=True, in_task=0, most=2).first().converged


def test_robust_average(spark, rng):
    cases = {"one": [1.0] * 10, "spiked": [10000.0] * 50 + [1.0] * 950, "single": [5.0], "two": [1.0, 3.0], "five": [1.0, 2.0, 2.0, 3.0, 100.0], "ties": [1.0] * 3 + [2.0] * 3 + [50.0], "heavy": rng.standard_t(1, size=3000).tolist(), "far": (1e6 + rng.normal(size=200)).tolist()}
    data = [(k, v, float(rng.uniform(0.1, 9))) for k, vs in cases.items() for v in vs] + [("one", None, 1.0), ("two", 7.0, None)]
    df = spark.createDataFrame(data, "k string, v double, w double")
    for weight in (None, "w"):
        got = {r.k: r.average for r in ag.robust_average(df, ["k"], "v", weight).collect()}
        for k in cases:
            rows = [(v, w if weight else 1.0) for kk, v, w in data if kk == k and v is not None and (w is not None or not weight)]
            v, w = (np.array(c) for c in zip(*rows))
            want = 0.0 if len(v) < 2 else linalg.huber_location(v, w)
            assert got[k] == pytest.approx(want, rel=1e-7, abs=1e-7), (k, weight)
            if len(v) > 1 and weight is None:  # the zero of the clipped residuals
                b = linalg.huber_solve(np.ones((len(v), 1)), v, w, tol=1e-14, most=5000)[0][0]
                assert want == pytest.approx(b, rel=1e-5, abs=1e-5)
    whole = ag.robust_average(df.where("k = 'heavy'"), [], "v").first().average
    assert whole == pytest.approx(linalg.huber_location(np.array(cases["heavy"]), np.ones(3000)), abs=1e-8)


def test_t_distribution():
    assert linalg.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=2e-4)
    assert linalg.t_two_sided(1.96, 1e6) == pytest.approx(0.05, abs=1e-4)
    assert linalg.t_two_sided(0.0, 5) == pytest.approx(1.0)


def test_error_forms(spark, rng):
    n = 60
    x, e = rng.normal(size=n), rng.normal(size=n)
    y = 0.5 + 1.5 * x + e * (1 + abs(x))
    df = frame(spark, k=[1] * n, t=np.arange(n), x=x, y=y)
    d = np.column_stack([np.ones(n), x])
    inv = np.linalg.inv(d.T @ d)
    b = inv @ d.T @ y
    r = y - d @ b
    white = np.sqrt(np.diag(inv @ (d.T * r**2) @ d @ inv))
    s = rg.reg_stats(df, ["k"], ["x"], "y", errors="white").toPandas().set_index("term")
    assert s.loc["x", "coef"] == pytest.approx(b[1]) and s.loc["x", "se"] == pytest.approx(white[1])
    u = d * r[:, None]
    m = u.T @ u
    for l in (1, 2):
        g = u[l:].T @ u[:-l]
        m += (1 - l / 3) * (g + g.T)
    nw = np.sqrt(np.diag(inv @ m @ inv))
    out = rg.newey_west_errors(df, "k", ["x"], "y", 2, "t").first()
    assert out.se_x == pytest.approx(nw[1]) and out.se_intercept == pytest.approx(nw[0])


def test_vif_of_three(spark, rng):
    a = rng.normal(size=(100, 3))
    a[:, 2] = a[:, 0] + 0.5 * a[:, 2]
    df = spark.createDataFrame(pd.DataFrame(a, columns=["a", "b", "c"]).assign(k=1))
    got = rg.vif(df, ["k"], ["a", "b", "c"]).toPandas().set_index("factor").vif
    want = np.diag(np.linalg.inv(np.corrcoef(a.T)))
    assert got[["a", "b", "c"]].to_numpy() == pytest.approx(want)


def test_cochrane_orcutt_finds_rho(spark, rng):
    n = 400
    x, e = rng.normal(size=n), np.zeros(n)
    for i in range(1, n):
        e[i] = 0.6 * e[i - 1] + rng.normal() * 0.5
    out = rg.cochrane_orcutt(frame(spark, k=[1] * n, t=np.arange(n), x=x, y=1 + 2 * x + e), "k", ["x"], "y", "t").first()
    assert out.rho == pytest.approx(0.6, abs=0.1) and out.x == pytest.approx(2.0, abs=0.1)


def test_var1_and_reduced_rank(spark, rng):
    n = 120
    f = np.zeros((n, 2))
    a = np.array([[0.5, 0.1], [0.0, 0.3]])
    for i in range(1, n):
        f[i] = a @ f[i - 1] + rng.normal(size=2)
    out = rg.var1(frame(spark, t=np.arange(n), p=f[:, 0], q=f[:, 1]), "t", ["p", "q"]).toPandas().set_index("equation")
    x = np.column_stack([np.ones(n - 1), f[:-1]])
    want = np.linalg.lstsq(x, f[1:], rcond=None)[0].T
    assert out.loc[["p", "q"], ["intercept", "lag_p", "lag_q"]].to_numpy() == pytest.approx(want)
    full = rg.reduced_rank(frame(spark, a=x[:, 1], b=x[:, 2], p=f[1:, 0], q=f[1:, 1]), ["a", "b"], ["p", "q"], 2).toPandas()
    assert full.set_index(["x", "y"]).coef.loc[("a", "p")] == pytest.approx(want[0, 1])


def test_cointegrated_line_is_stationary(spark, rng):
    n = 300
    m = rng.normal(size=n) * 0.02
    noise = rng.normal(size=n) * 0.001
    follow = m + np.diff(np.concatenate([[0], noise]))
    loose = rng.normal(size=n) * 0.02
    ret = pd.concat([pd.DataFrame({"id": i, "t": np.arange(n), "ret": np.expm1(r)}) for i, r in enumerate([m, follow, loose])])
    lines = frame(spark, id=[0, 1, 2], issuer=[9, 9, 9], master=[0, 0, 0])
    out = rg.cointegration(spark.createDataFrame(ret), lines, "id", "issuer", "t").toPandas().set_index("id")
    assert out.loc[1, "coef"] == pytest.approx(1.0, abs=0.02) and out.loc[1, "level"] <= 0.01
    assert set(out.index) == {1, 2} and out.loc[1, "adf_t"] < out.loc[2, "adf_t"]


@pytest.mark.parametrize("bad", [-1.0, -1.5, float("inf"), float("nan"), None])
def test_cointegration_takes_returns_without_a_logarithm_as_missing(spark, rng, bad):
    n = 60
    r = rng.normal(size=(2, n)) * 0.02
    rows = lambda first: [(i, t, first if i == 1 and t == 0 else float(r[i, t])) for i in range(2) for t in range(n)]
    lines = frame(spark, id=[0, 1], issuer=[9, 9], master=[0, 0])
    got, want = (rg.cointegration(spark.createDataFrame(rows(x), "id long, t long, ret double"), lines, "id", "issuer", "t").collect() for x in (bad, 0.0))
    assert got == want and got[0].adf_t is not None


# --- components ---------------------------------------------------------------------------


def panel(spark, r):
    n, t = r.shape
    return spark.createDataFrame(pd.DataFrame({"id": np.repeat(np.arange(n), t), "t": np.tile(np.arange(t), n), "ret": r.ravel()}))


def test_components_match_svd(spark, rng):
    r = rng.normal(size=(40, 12)) + np.outer(rng.normal(size=40), rng.normal(size=12)) * 3
    f, exp, st = fa.apca(panel(spark, r), "id", "t", "ret", 2)
    _, s, vt = np.linalg.svd(r, full_matrices=False)
    got = f.toPandas().sort_values("t")[["f1", "f2"]].to_numpy()
    for i in range(2):
        assert abs(got[:, i] @ vt[i]) == pytest.approx(1.0, abs=1e-9)
    assert st.first().explained == pytest.approx((s[:2] ** 2).sum() / (s**2).sum())
    b = exp.toPandas().sort_values("id")[["f1", "f2"]].to_numpy()
    assert np.allclose(b, r @ got)


def test_mimicking_portfolio_returns_the_factor(spark, rng):
    n = 60
    pdf = pd.DataFrame({"dt": [1] * n, "id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n), "ret": rng.normal(size=n), "w": rng.random(n)})
    df = spark.createDataFrame(pdf)
    f = rg.wls(df, ["dt"], ["a", "b"], "ret", "w").first().coef
    p = fa.mimicking_portfolios(df, "dt", "id", ["a", "b"], "w").toPandas().merge(pdf, on="id")
    assert (p.fmp_a * p.ret).sum() == pytest.approx(f[0]) and (p.fmp_a * p.a).sum() == pytest.approx(1.0) and (p.fmp_a * p.b).sum() == pytest.approx(0.0, abs=1e-9)


# --- risk ---------------------------------------------------------------------------------


def cov_frame(spark, m, names):
    k = len(names)
    return spark.createDataFrame(pd.DataFrame({"f1": np.repeat(names, k), "f2": np.tile(names, k), "value": m.ravel()}))


def to_matrix(df, names):
    p = df.toPandas().pivot(index="f1", columns="f2", values="value")
    return p.loc[names, names].to_numpy()


def test_imposed_block_and_floor(spark, rng):
    a = rng.normal(size=(50, 4))
    m = np.cov(a.T)
    names = ["a", "b", "c", "d"]
    t = np.array([[2.0, 0.5], [0.5, 1.0]])
    blk = cov_frame(spark, t, ["a", "b"]).withColumn("block", F.lit("x"))
    out = to_matrix(rk.impose_blocks(cov_frame(spark, m, names), blk), names)
    assert np.allclose(out[:2, :2], t) and np.allclose(out[2:, 2:], m[2:, 2:]) and np.linalg.eigvalsh(out).min() > 0
    assert np.allclose(linalg.impose_block(m, [0, 1], t), out)
    bad = np.array([[1.0, 2.0], [2.0, 1.0]])
    fixed = to_matrix(rk.floor_eigenvalues(cov_frame(spark, bad, ["a", "b"]), 1e-6), ["a", "b"])
    assert np.linalg.eigvalsh(fixed).min() >= 1e-6 - 1e-12


def test_shrinkage_pulls_spectrum_together(rng):
    x = rng.normal(size=(60, 20))
    m = x.T @ x / 60
    s = linalg.shrink_eigenvalues(m, 60)
    a, b = np.linalg.eigvalsh(m), np.linalg.eigvalsh(s)
    assert np.allclose(s, s.T) and b.max() / b.min() < a.max() / a.min()


def test_composite_covariance_is_its_parts(spark, rng):
    x = rng.normal(size=(40, 3))
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(step=np.arange(40)).melt("step", var_name="factor"))
    got = to_matrix(rk.factor_cov(df, corr_half_life=None, var_half_life=None, corr_lags=1, var_lags=1, annual=252.0), ["a", "b", "c"])
    c = x.T @ x / 40
    l = x[:-1].T @ x[1:] / 40
    nw = c + 0.5 * (l + l.T)
    assert np.allclose(got, 252 * nw)


def test_dead_factor_and_zero_variance(spark, rng):
    x = rng.normal(size=40)
    df = spark.createDataFrame(pd.DataFrame({"a": x, "z": np.zeros(40)}).assign(step=np.arange(40)).melt("step", var_name="factor"))
    got = to_matrix(rk.factor_cov(df, floor=None), ["a", "z"])
    assert got[1, 1] == 0 and got[0, 1] == 0 and got[0, 0] > 0


def test_total_risk_adds_up(spark, rng):
    m = np.cov(rng.normal(size=(30, 3)).T)
    names = ["a", "b", "c"]
    x = rng.normal(size=(5, 3))
    exp = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(asset_id=range(5)))
    spec = frame(spark, asset_id=range(5), spec_var=[0.1] * 5)
    out = rk.total_risk(exp, cov_frame(spark, m, names), spec, names).toPandas().sort_values("asset_id")
    assert out.factor_var.to_numpy() == pytest.approx(np.einsum("ij,jk,ik->i", x, m, x))
    assert (out.total_risk**2).to_numpy() == pytest.approx((out.factor_var + out.spec_var).to_numpy())
    w = frame(spark, name=["p"] * 5, asset_id=range(5), weight=[0.2] * 5)
    r = rk.portfolio_risk(w, exp, cov_frame(spark, m, names), spec, names).first()
    h = x.mean(axis=0)
    assert r.factor_var == pytest.approx(h @ m @ h) and r.specific_var == pytest.approx(0.1 / 5)
    mc = rk.marginal_contribution(w, exp, cov_frame(spark, m, names), spec, names, True).toPandas()
    assert (mc.weight * mc.mctr).sum() == pytest.approx(r.risk)
    b = rk.predicted_beta(exp.withColumn("market", F.lit("p")), cov_frame(spark, m, names), spec, w.withColumnRenamed("name", "market"), names).toPandas()
    assert b.beta.mean() == pytest.approx(1.0)


def test_volatility_adjustment_levels_two_regimes(rng):
    v = np.concatenate([rng.normal(size=200), rng.normal(size=200) * 3])
    s = linalg_scale = ts.volatility_scale(v, 40)
    assert s[0] == pytest.approx(1.0) and s[-1] < 0.7 and len(linalg_scale) == 400
    assert (ts.volatility_scale(v[:30], 40) == 1).all()


def test_volatility_knots_cover_the_series():
    for n, length in ((45, 40), (61, 40), (400, 40), (419, 41), (20, 40), (100, 7)):
        knots, first, end = ts.volatility_knots(n, length)
        h = -(-length // 2)
        assert knots[0] == 0 and (np.diff(knots) > 0).all() and (end > first).all() and end.max() == n
        assert ((knots[1:] - first[1:] == h) | (knots[1:] == n)).all() and set(range(n)) == {i for a, b in zip(first, end) for i in range(a, b)}
    steps = ts.volatility_scale(np.repeat([1.0, 4.0], 100), 40, -0.1, 0.1, smooth=False)
    assert steps[0] == 1 and steps[-1] == pytest.approx(0.9**5, abs=0.1) and (np.diff(steps) <= 0).all()


def test_spline_goes_through_knots():
    x, y = np.array([0.0, 1, 3, 4, 7]), np.array([1.0, 2, 0, 1, 5])
    assert linalg.cubic_spline(x, y, x) == pytest.approx(y)
    assert linalg.cubic_spline(x, x**3, np.array([2.0, 5.0])) == pytest.approx([8.0, 125.0])


# --- edge frames --------------------------------------------------------------------------


def test_products_survive_minus_one(spark):
    df = frame(spark, k=[1] * 4, dt=[1, 2, 3, 4], ret=[0.1, -1.0, 0.5, -2.0])
    c = ts.cumulative(df, ["k"], "ret").toPandas().sort_values("dt").cum
    assert c.tolist() == pytest.approx([1.1, 0.0, 0.0, 0.0])
    neg = frame(spark, k=[1] * 2, dt=[1, 2], ret=[-2.0, 0.5])
    assert ts.cumulative(neg, ["k"], "ret").toPandas().sort_values("dt").cum.tolist() == pytest.approx([-1.0, -1.5])


def test_gap_keeps_long_run_growth(spark):
    df = spark.createDataFrame([(1, 1, 0.02, 0.0), (1, 2, None, 0.01), (1, 3, None, 0.02), (1, 4, None, -0.01), (1, 5, 0.10, 0.0)], "k int, step int, ret double, proxy double")
    f = ts.fill_smooth(df, "k", "ret", "proxy").toPandas().sort_values("step").filled
    assert np.prod(1 + f) == pytest.approx(1.02 * 1.10)


def test_interval_end_is_open_and_deleted_hides(spark):
    from riskloom.operators import bitemporal as bt

    iv = spark.sql("select 1 as k, date'2020-01-01' as from_dt, date'2020-02-01' as thru_dt, 'x' as v")
    d = spark.sql("select 1 as k, explode(array(date'2020-01-01', date'2020-01-31', date'2020-02-01')) as dt")
    assert bt.valid_on(d, iv, ["k"]).count() == 2
    rev = spark.sql("select * from values (1, date'2020-01-01', 'N', 5), (1, date'2020-01-02', 'Y', 6), (2, date'2020-01-01', 'N', 7) t(k, rev_dt, rev_del_flag, v)")
    once = bt.active(rev, ["k"])
    assert [r.k for r in once.collect()] == [2]
    assert bt.active(once, ["k"]).count() == 1


def test_standardise_constant_null_and_empty_bucket(spark):
    rows = [("a", "x", 1.0, True, 1.0), ("b", "x", 1.0, True, 1.0), ("c", "x", 1.0, True, 1.0), ("a", "y", None, True, 1.0), ("b", "y", None, True, 1.0), ("c", "y", None, True, 1.0), ("a", "z", 1.0, False, 1.0), ("b", "z", 5.0, False, 1.0), ("c", "z", 9.0, False, 1.0)]
    df = spark.createDataFrame(rows, "id string, factor string, value double, estu boolean, cap double").withColumn("ok", F.lit(True))
    out = sd.standardize(df, ["factor"], "value", "estu", "cap", eligible="ok").toPandas().set_index(["factor", "id"]).value
    assert out.loc[("x", "a")] == 1.0 and pd.isna(out.loc[("y", "a")])
    assert out.loc[("z", "b")] == pytest.approx(0.0) and out.loc[("z", "c")] == pytest.approx(1.0)


def test_weights_sum_to_one_and_coverage_keeps_crossing_line(spark):
    df = frame(spark, d=[1] * 4, id=[1, 2, 3, 4], cap=[50.0, 30.0, 15.0, 5.0])
    p = ag.market_portfolio(df, ["d"], "id", "cap", coverage=0.75).toPandas()
    assert sorted(p.id) == [1, 2] and p.weight.sum() == pytest.approx(1.0)
    keep = un.exclude_by_cap_rank(df, ["d"], "id", "cap", min_width=1.0).toPandas()
    assert sorted(keep.id) == [1, 2]


# --- streams, files and the package --------------------------------------------------------


def test_stream_takes_late_and_corrected_steps(spark, tmp_path):
    from riskloom.streaming import incremental as inc

    parts = [[(1, 3, 0.1), (2, 1, 0.5)], [(1, 1, 0.2), (1, 4, None)], [(1, 2, -0.1), (1, 3, 0.3), (2, 2, 0.1)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "id int, mi int, ret double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    log = inc.run_available(inc.stream_cumulative(inc.read_stream(spark, str(tmp_path / "in"), 1), "id", "mi", "ret"), "late")
    got = {(r.id, r.mi): r.cum for r in inc.latest(log, ["id", "mi"]).collect()}
    assert got == pytest.approx({(1, 1): 1.2, (1, 2): 1.08, (1, 3): 1.08 * 1.3, (1, 4): 1.08 * 1.3, (2, 1): 1.5, (2, 2): 1.65})


def test_stream_windows_keep_late_rows(spark, tmp_path):
    from riskloom.streaming import incremental as inc

    for ts, v in (("2020-03-01 10:00:00", 5.0), ("2020-01-01 10:00:00", 1.0), ("2020-01-02 10:00:00", 4.0)):
        spark.createDataFrame([("a", ts, v)], "k string, t string, v double").selectExpr("k", "CAST(t AS timestamp) AS t", "v").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = inc.stream_windows(inc.read_stream(spark, str(tmp_path / "in"), 1), "k", "t", "v", "2 days", "1 day").toPandas()
    both = out[out.n == 2]
    assert len(both) == 1 and both["mean"].iloc[0] == 2.5 and both["std"].iloc[0] == pytest.approx(4.5**0.5) and out.n.sum() == 6


def test_flat_files_must_agree(spark, tmp_path):
    from riskloom.sources import flatfiles as ff

    df = spark.createDataFrame([(1, "x")], "a int, b string")
    ff.write_flat(df, str(tmp_path / "f"), {"a": "INTEGER"})
    ff.write_flat(df, str(tmp_path / "f"), {"a": "INTEGER"})
    assert ff.read_flat(spark, str(tmp_path / "f")).dtypes == [("a", "bigint"), ("b", "string")]
    ff.write_flat(df, str(tmp_path / "f"), {"a": "NUMBER"})
    with pytest.raises(ValueError):
        ff.read_flat(spark, str(tmp_path / "f"))


def test_actions_keep_long_waits_and_the_last_ones(spark):
    import datetime as d

    cal = spark.createDataFrame([(0, d.date(2020, 6, 1)), (0, d.date(2020, 6, 3))], "market int, dt date")
    act = spark.createDataFrame([(0, 7, d.date(2017, 1, 1), 2.0), (0, 7, d.date(2020, 6, 1), 3.0), (0, 7, d.date(2020, 6, 2), 5.0), (0, 7, d.date(2021, 1, 1), 7.0)], "market int, id int, dt date, factor double")
    got = {r.trade_dt: r.factor for r in ts.roll_actions(act, cal, "market", "id").collect()}
    assert got == {d.date(2020, 6, 1): pytest.approx(6.0), d.date(2020, 6, 3): pytest.approx(5.0), None: pytest.approx(7.0)}
