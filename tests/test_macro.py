"""State-space factors against plain Gaussian conditioning and planted factors; daily expansion against dense matrices."""

from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import statespace as ss
from riskloom.operators import factors as fa, macro as mc


@pytest.fixture
def rng():
    return np.random.default_rng(5)


def simulate(rng, steps, n, k, rho=0.6, noise=0.4):
    var = np.diag(np.linspace(0.7, 0.3, k))
    f = np.zeros((steps, k))
    for t in range(1, steps):
        f[t] = var @ f[t - 1] + rng.normal(size=k)
    lam = rng.normal(size=(n, k)) + 0.5
    e = np.zeros((steps, n))
    for t in range(1, steps):
        e[t] = rho * e[t - 1] + noise * rng.normal(size=n)
    return f, lam, f @ lam.T + e


def test_smoother_is_the_conditional_expectation(rng):
    steps, n, k = 6, 3, 2
    var, shock = np.array([[0.6, 0.1], [0.0, 0.3]]), np.array([[1.0, 0.2], [0.2, 0.5]])
    rho, sigma2, lam = np.array([0.5, -0.2, 0.0]), np.array([0.3, 0.2, 0.5]), rng.normal(size=(n, k))
    z = rng.normal(size=(steps, n))
    z[rng.random((steps, n)) < 0.3] = np.nan
    z[-1] = np.nan
    got = ss.smooth(z, lam, var, shock, rho, sigma2)
    d = k + n
    move = np.block([[var, np.zeros((k, n))], [np.zeros((n, k)), np.diag(rho)]])
    noise = np.block([[shock, np.zeros((k, n))], [np.zeros((n, k)), np.diag(sigma2)]])
    p = np.linalg.solve(np.eye(d * d) - np.kron(move, move), noise.ravel()).reshape(d, d)
    cov = np.zeros((steps * d, steps * d))
    for i in range(steps):
        for j in range(i, steps):
            c = np.linalg.matrix_power(move, j - i) @ p
            cov[j * d : (j + 1) * d, i * d : (i + 1) * d], cov[i * d : (i + 1) * d, j * d : (j + 1) * d] = c, c.T
    read = np.kron(np.eye(steps), np.hstack([lam, np.eye(n)]))[np.isfinite(z).ravel()]
    y = z.ravel()[np.isfinite(z).ravel()]
    s = read @ cov @ read.T + ss.EXACT * np.eye(len(y))
    gain = cov @ read.T @ np.linalg.inv(s)
    after = cov - gain @ read @ cov
    assert np.allclose(got.mean.ravel(), gain @ y, atol=1e-8)
    for t in range(steps):
        assert np.allclose(got.cov[t], after[t * d : (t + 1) * d, t * d : (t + 1) * d], atol=1e-8)
        if t:
            assert np.allclose(got.lag[t], after[t * d : (t + 1) * d, (t - 1) * d : t * d], atol=1e-8)
    want = -0.5 * (len(y) * np.log(2 * np.pi) + np.linalg.slogdet(s)[1] + y @ np.linalg.solve(s, y))
    assert got.loglik == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("k", [1, 2])
def test_planted_factors_on_an_unbalanced_panel(rng, k):
    f, lam, x = simulate(rng, 180, 10, k)
    x = 3.0 + 2.0 * x
    x[rng.random(x.shape) < 0.25] = np.nan
    x[:40, :3] = np.nan  # series that begin late
    x[-2:, ::2] = np.nan  # a ragged end
    fit = ss.dynamic_factors(x, k)
    assert fit.converged and all(b >= a - 1e-6 * abs(a) for a, b in zip(fit.loglik, fit.loglik[1:]))
    fitted = fit.factors @ np.linalg.lstsq(fit.factors, f, rcond=None)[0]
    assert all(np.corrcoef(fitted[:, i], f[:, i])[0, 1] > 0.95 for i in range(k))
    assert np.median(fit.rho) == pytest.approx(0.6, abs=0.15)
    assert np.allclose(fit.factors.T @ fit.factors / len(f), np.eye(k), atol=1e-6) and (fit.loadings.sum(axis=0) >= 0).all()


def test_missing_values_do_not_count_as_zero(rng):
    """A level far from zero and long gaps: what is missing does not pull factors to the mean's other side."""
    _, _, x = simulate(rng, 150, 8, 1)
    whole = ss.dynamic_factors(x, 1).factors[:, 0]
    gaps = x.copy()
    gaps[60:80, :6] = np.nan
    got = ss.dynamic_factors(gaps + 1000.0, 1).factors[:, 0]
    assert np.corrcoef(whole, got)[0, 1] > 0.97
    assert np.corrcoef(whole[60:80], got[60:80])[0, 1] > 0.85


def test_degenerate_tables_and_few_passes(rng):
    x = np.column_stack([np.full(20, np.nan), np.full(20, 2.0), rng.normal(size=20), rng.normal(size=20)])
    fit = ss.dynamic_factors(x, 2)
    assert np.isfinite(fit.factors).all() and not fit.loadings[:2].any()
    assert ss.dynamic_factors(x[:, :2], 1).factors.shape == (20, 0)
    _, _, y = simulate(rng, 60, 6, 1)
    assert not ss.dynamic_factors(y, 1, tol=0.0, most=3).converged


def test_spread_against_dense_matrices(rng):
    counts = np.array([3, 1, 5, 2, 4, 20])
    days = int(counts.sum())
    x, total = np.column_stack([np.ones(days), rng.normal(size=days)]), rng.normal(size=6)
    c = np.repeat(np.eye(6), counts, axis=1)
    for rho in (0.0, 0.4, 0.9):
        v = rho ** np.abs(np.subtract.outer(np.arange(days), np.arange(days))) if rho else np.eye(days)
        w = np.linalg.inv(c @ v @ c.T)
        b = np.linalg.solve((c @ x).T @ w @ c @ x, (c @ x).T @ w @ total)
        want = x @ b + v @ c.T @ w @ (total - c @ x @ b)
        got, coef, _ = ss.spread(total, counts, x, rho)
        assert np.allclose(got, want) and np.allclose(coef, b) and np.allclose(c @ got, total)
    partly = total.copy()
    partly[2] = np.nan
    got, _, rho = ss.spread(partly, counts, x)
    assert np.allclose((c @ got)[[0, 1, 3, 4, 5]], partly[[0, 1, 3, 4, 5]]) and np.isfinite(got).all() and 0 <= rho < 1


def test_vintages_have_ragged_ends(spark):
    rows = [("a", 1, date(2020, 2, 10), 1.0), ("a", 1, date(2020, 4, 10), 1.5), ("a", 2, date(2020, 3, 10), 2.0), ("b", 1, date(2020, 3, 20), 7.0), ("b", 1, date(2020, 3, 20), 8.0), ("b", 2, date(2020, 3, 1), None)]
    df = spark.createDataFrame(rows, "name string, step int, released date, value double")
    got = {(r.name, r.step, r.as_of.month): r.value for r in mc.vintages(df, ["name", "step"], "value", "released", [date(2020, 3, 15), date(2020, 5, 1)]).collect()}
    assert got == {("a", 1, 3): 1.0, ("a", 2, 3): 2.0, ("a", 1, 5): 1.5, ("a", 2, 5): 2.0, ("b", 1, 5): 8.0}


def test_factors_and_days_in_spark(spark, rng):
    f, lam, x = simulate(rng, 90, 7, 1)
    rows = [(g, f"s{i}", t, float(x[t, i]) if (t + i) % 7 else None) for g in ("u", "v") for t in range(90) if t != 50 for i in range(7)]
    df = spark.createDataFrame(rows, "g string, s string, t int, x double").repartition(4)
    out = mc.state_space_factors(df, ["g"], "s", "t", "x", 2)
    p = out["factors"].where("g = 'u'").orderBy("t").toPandas()
    assert list(p.t) == list(range(90)) and p.converged.all() and abs(np.corrcoef(p.f1, f[:, 0])[0, 1]) > 0.95
    assert out["loadings"].count() == 14
    days = spark.createDataFrame([(g, t, 20 * t + d, float(rng.normal()) if d else None) for g in ("u", "v") for t in range(88) for d in range(20)], "g string, t int, day int, z double")
    daily = mc.daily_expansion(out["factors"], days, ["g"], "t", "day", "f1", ["z"]).toPandas()
    sums = daily[daily.g == "u"].assign(t=lambda d: d.day // 20).groupby("t").f1.sum()
    assert len(daily) == 2 * 88 * 20 and np.allclose(sums, p.f1[:88])
    none = out["factors"].withColumn("f1", F.lit(None).cast("double"))
    assert mc.daily_expansion(none, days, ["g"], "t", "day", "f1", ["z"]).where("f1 IS NOT NULL").count() == 0


def test_statistical_model_turns_both_sides(spark, rng):
    x = np.outer(rng.normal(size=30), rng.normal(size=12) + 2) + 0.1 * rng.normal(size=(30, 12))
    df = spark.createDataFrame(pd.DataFrame([(i, t, float(x[t, i])) for t in range(30) for i in range(12)], columns=["id", "dt", "ret"]))
    plain = fa.statistical_model(df, "id", "dt", "ret", 1)
    before = plain["exposures"].withColumn("f1", -F.col("f1"))
    turned = fa.statistical_model(df, "id", "dt", "ret", 1, before=before)
    a, b = (m["exposures"].toPandas().set_index("id").f1 for m in (plain, turned))
    c, d = (m["factor_returns"].toPandas().set_index("dt").value for m in (plain, turned))
    assert np.allclose(a, -b[a.index]) and np.allclose(c, -d[c.index])
