"""Components, chains of links and covariances of merged groups."""

import numpy as np
import pandas as pd
import pytest

from riskloom.operators import graph, joins as jn, risk as rk


@pytest.fixture
def rng():
    return np.random.default_rng(9)


def plain_components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = (a if a is not None else b), (b if b is not None else a)
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark, rng):
    chain = [(i, i + 1) for i in range(1000, 1040)]
    edges = chain + [(5000, 5000 + i) for i in range(200)] + [tuple(map(int, e)) for e in rng.integers(0, 300, (200, 2))] + [(7, 7), (None, 9000), (9001, None), (None, None), (3, 4), (3, 4)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == plain_components(edges)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_roots_of_chains_and_circles(spark):
    pointers = [(i, i + 1) for i in range(20)] + [(100, 101), (101, 102), (102, 100), (103, 100), (200, 200)]
    got = {r.c: r.root for r in graph.roots(spark.createDataFrame(pointers, "c long, p long"), "c", "p").collect()}
    assert got == {**{i: 20 for i in range(20)}, 100: None, 101: None, 102: None, 103: None, 200: None}
    assert graph.roots(spark.createDataFrame([], "c long, p long"), "c", "p").count() == 0


def test_groups_that_share_a_line_are_merged(spark):
    lines = spark.createDataFrame([(1, 10), (1, 11), (2, 11), (2, 20), (3, 30), (4, 40), (5, 50)], "issuer long, line long")
    links = spark.createDataFrame([(30, 40), (50, 99)], "line long, master long")
    dual = spark.createDataFrame([], "a long, b long")
    got = {(r.issuer, r.line): r.merged for r in jn.merged_groups(lines, links, dual, "issuer", "line").collect()}
    assert got == {(1, 10): 1, (1, 11): 1, (2, 11): 1, (2, 20): 1, (3, 30): 3, (4, 40): 3, (5, 50): 5}


@pytest.mark.parametrize("most", [400, 1])
def test_merged_covariance(spark, rng, most):
    n, steps = 7, 80
    common = rng.normal(size=steps)
    x = 0.6 * common[:, None] + rng.normal(size=(steps, n))
    x[:30, 6] = np.nan
    issuer = [1, 1, 1, 2, 2, 3, 4]
    ret = spark.createDataFrame(pd.DataFrame([(i, t, float(x[t, i])) for t in range(steps) for i in range(n) if np.isfinite(x[t, i])], columns=["id", "t", "r"]))
    members = spark.createDataFrame([(issuer[i], i, 1 if issuer[i] < 4 else 4) for i in range(n)], "issuer long, id long, merged long")
    var = rng.uniform(0.5, 2, n)
    c = {1: 0.9, 2: 0.8, 4: 0.95}
    master = {1: 0, 2: 0, 4: 3}
    pairs = spark.createDataFrame([(master[i], i, c[i], c[i] * float(np.sqrt(var[i] * var[master[i]])), master[i], i) for i in c], "id1 long, id2 long, corr double, cov double, master long, line long")
    linked = {"variance": spark.createDataFrame([(i, float(var[i])) for i in range(n)], "id long, spec_var double"), "pairs": pairs}
    p = rk.merged_covariance(ret, members, linked, "id", "issuer", "t", "r", steps, 40.0, most=most).toPandas()
    assert set(p.merged) == {1} and (p.dense == (most == 400)).all()
    m = np.zeros((6, 6))
    for r in p.itertuples():
        m[r.id1, r.id2] = m[r.id2, r.id1] = r.cov
    if most == 1:  # listed by masters: two other lines by the product
        m[1, 2] = m[2, 1] = 0.72 * np.sqrt(var[1] * var[2])
    assert np.allclose(np.diag(m), var[:6]) and np.linalg.eigvalsh(m).min() > -1e-10
    s = np.sqrt(np.diag(m))
    corr = m / np.outer(s, s)
    assert corr[0, 1] == pytest.approx(0.9) and corr[0, 2] == pytest.approx(0.8) and corr[3, 4] == pytest.approx(0.95)
    if most == 400:
        assert corr[1, 2] == pytest.approx(0.72) and 0.05 < corr[0, 5] < 0.9 and abs(corr[1, 4]) > 0


def test_pair_correlation_and_unit_diagonal(rng):
    from riskloom.functions import linalg

    x = rng.normal(size=(50, 4))
    got = linalg.pair_correlation(x, np.ones(50))
    want = (x.T @ x) / np.sqrt(np.outer((x**2).sum(0), (x**2).sum(0)))
    assert np.allclose(got, want)
    gaps = np.where(rng.random(x.shape) < 0.6, np.nan, x)
    fixed = linalg.unit_diagonal(linalg.pair_correlation(gaps, np.ones(50)))
    assert np.allclose(np.diag(fixed), 1) and np.linalg.eigvalsh(fixed).min() > 0


def linked_by_hand(var, fits, master, lo=0.75, hi=0.99995):
    """The named method in plain loops: (variances, correlations) of one issuer; ``fits``: (x, y) -> (coef of y on x, error variance)."""
    var, n = dict(var), len(var)
    mv = var[master]
    for s in var:
        if s != master:
            cands = [fits[p][0] ** 2 * mv + fits[master, s][1] for p in ((master, s), (s, master))]
            var[s] = min([var[s], *cands], key=lambda c: abs(c - mv))
    m = np.eye(n)
    for a in range(n):
        for b in range(n):
            if a != b:
                m[a, b] = np.clip(max(fits[a, b][0] * np.sqrt(var[a] / var[b]), fits[b, a][0] * np.sqrt(var[b] / var[a])), lo, hi)
    d, v = np.linalg.eigh(m)
    m = (v * np.maximum(d, 1e-8)) @ v.T
    s = np.sqrt(np.diag(m))
    return var, m / np.outer(s, s)


def linked_frames(spark, rng, n=5, steps=60):
    """Returns of an issuer's lines and a line of another issuer, and what is measured on them."""
    from riskloom.operators import regressions as rg

    common = rng.normal(size=steps) * 0.05
    r = common[:, None] * rng.uniform(0.5, 1.5, n) + rng.normal(size=(steps, n)) * 0.03
    r = np.column_stack([r, rng.normal(size=steps) * 0.05])
    ret = spark.createDataFrame(pd.DataFrame([(i, t, float(r[t, i])) for i in range(n + 1) for t in range(steps)], columns=["id", "t", "ret"]))
    lines = spark.createDataFrame([(i, 1, 2) for i in range(n)] + [(n, 2, n)], "id long, issuer long, master long")
    pairs = rk.linked_pairs(lines, "id", "issuer")
    direct = rk.linked_correlation(ret, pairs.where("id > master"), "id", "issuer", "t", "ret", steps, 40.0)
    coint = rg.cointegration(ret, pairs, "id", "issuer", "t")
    spec = spark.createDataFrame([(i, float((r[:, i] ** 2).mean())) for i in range(n + 1)], "id long, spec_var double")
    return r, spec, coint, direct, lines


def test_every_pair_of_lines_has_its_own_correlation(spark, rng):
    n = 5
    r, spec, coint, direct, lines = linked_frames(spark, rng, n)
    assert {(x.master, x.id) for x in direct.collect()} == {(a, b) for a in range(n) for b in range(a + 1, n)}
    out = rk.linked_covariance(spec, coint, direct, lines, "id", "issuer")
    px = np.log1p(r[:, :n]).cumsum(axis=0)
    fits = {}
    for a in range(n):
        for b in range(n):
            if a != b:
                c = np.clip(px[:, a] @ px[:, b] / (px[:, a] @ px[:, a]), 0.67, 1.5)
                fits[a, b] = c, np.var(np.diff(px[:, b] - c * px[:, a]), ddof=1)
    var, corr = linked_by_hand({i: (r[:, i] ** 2).mean() for i in range(n)}, fits, 2)
    got = {x.id: x.spec_var for x in out["variance"].collect()}
    assert set(got) == set(range(n + 1)) and all(got[i] == pytest.approx(var[i]) for i in range(n))
    p = out["pairs"].collect()
    assert sorted((x.id1, x.id2) for x in p) == [(a, b) for a in range(n) for b in range(a + 1, n)]
    for x in p:
        assert x.corr == pytest.approx(corr[x.id1, x.id2]) and x.cov == pytest.approx(x.corr * np.sqrt(var[x.id1] * var[x.id2]))
        assert x.master == 2 and x.line == (x.id2 if x.id1 == 2 else x.id1 if x.id2 == 2 else None)


def test_short_histories_and_indefinite_groups(spark):
    long = "issuer long, master long, id long, coef double, err_var double, n long"
    lines = spark.createDataFrame([(i, 1, 0) for i in range(4)], "id long, issuer long, master long")
    fit = lambda c, n: [(1, a, b, c.get((min(a, b), max(a, b)), 0.67), 0.0, n) for a in range(4) for b in range(4) if a != b]
    none = spark.createDataFrame([], "issuer long, master long, id long, corr double")
    spec = spark.createDataFrame([(i, 1.0 if i < 3 else 4.0) for i in range(4)], "id long, spec_var double")
    few = rk.linked_covariance(spec, spark.createDataFrame(fit({}, 4), long), none, lines, "id", "issuer")
    assert all(x.spec_var == 1 for x in few["variance"].collect()) and all(x.corr == pytest.approx(0.99995) for x in few["pairs"].collect())
    # 0-1 and 0-2 nearly one, 1-2 at the floor: no such matrix
    odd = rk.linked_covariance(spec, spark.createDataFrame(fit({(0, 1): 1.0, (0, 2): 1.0}, 9), long), none, lines, "id", "issuer")
    m = np.eye(4)
    for x in odd["pairs"].collect():
        m[x.id1, x.id2] = m[x.id2, x.id1] = x.corr
    assert np.linalg.eigvalsh(m).min() > 0 and 0.75 < m[1, 2] < m[0, 1] < 0.99995


def test_low_correlations_name_pairs_without_the_master(spark, rng):
    from riskloom.operators import quality as ql

    _, spec, coint, direct, lines = linked_frames(spark, rng)
    pairs = rk.linked_covariance(spec, coint, direct, lines, "id", "issuer")["pairs"].toPandas()
    bound = pairs["corr"].median()
    got = {(x.id1, x.id2) for x in ql.low_correlations(spark.createDataFrame(pairs[["issuer", "id1", "id2", "corr"]]), bound).collect()}
    assert got == {(x.id1, x.id2) for x in pairs.itertuples() if x.corr < bound} and any(2 not in p for p in got)


def test_portfolio_risk_counts_every_pair_of_lines(spark, rng):
    _, spec, coint, direct, lines = linked_frames(spark, rng)
    out = rk.linked_covariance(spec, coint, direct, lines, "id", "issuer")
    h = rng.uniform(0, 1, 6)
    weights = spark.createDataFrame([("p", i, float(h[i])) for i in range(6)], "name string, asset_id long, weight double")
    exp = spark.createDataFrame([(i, 0.0) for i in range(6)], "asset_id long, x double")
    cov = spark.createDataFrame([("x", "x", 1.0)], "f1 string, f2 string, value double")
    m = np.diag([x.spec_var for x in out["variance"].orderBy("id").collect()])
    for x in out["pairs"].collect():
        m[x.id1, x.id2] = m[x.id2, x.id1] = x.cov
    assert (m[:5, :5] != 0).all() and np.linalg.eigvalsh(m).min() > 0
    got = rk.portfolio_risk(weights, exp, cov, out["variance"].withColumnRenamed("id", "asset_id"), ["x"], out["pairs"]).first()
    assert got.specific_var == pytest.approx(h @ m @ h) and got.risk == pytest.approx(np.sqrt(h @ m @ h))


def test_extract_is_the_whole_upper_triangle(spark, rng):
    from riskloom.sources import extracts as ex

    _, spec, coint, direct, lines = linked_frames(spark, rng)
    got = ex.upper_triangle(rk.linked_covariance(spec, coint, direct, lines, "id", "issuer")["pairs"]).select("id1", "id2", "cov").collect()
    assert sorted((x.id1, x.id2) for x in got) == [(a, b) for a in range(5) for b in range(a + 1, 5)] and all(x.cov > 0 for x in got)
