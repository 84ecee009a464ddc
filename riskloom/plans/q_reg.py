"""Regressions and factor returns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window, functions as F

from riskloom.operators import factors as fa, macro as mc, regressions as rg, timeseries as ts
from riskloom.plans.q_base import fx_rates, rf_rates
from riskloom.plans.registry import query
from riskloom.session import stored

END = 12 * 2000 + 12
STYLES = ["size", "momentum", "volatility", "turnover"]


def _r(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


@query("reg01_wls", "exposures factor_ret", "SELECT dt, ROUND(f_size, 6) AS size, ROUND(f_mom, 6) AS momentum FROM factor_ret")
def _(v):
    x = v.exposures
    return _r(rg.coefficients(rg.wls(x, ["dt"], ["size", "momentum"], "ret", "root_cap").where("n > 2"), ["dt"], ["size", "momentum"]), ["size", "momentum"])


@query("reg01_wls_residuals", "specific", "SELECT asset_id, dt, ROUND(sret, 6) AS resid FROM specific")
def _(v):
    x = stored(v.exposures.select("asset_id", "dt", "size", "momentum", "ret", "root_cap"))
    fit = rg.wls(x, ["dt"], ["size", "momentum"], "ret", "root_cap")
    return _r(rg.residuals(x, fit, ["dt"], ["size", "momentum"], "ret").select("asset_id", "dt", "resid"), ["resid"])


@query("reg02_constrained_wls", "exposures", """
WITH b AS (SELECT dt, SUM(root_cap * (size - momentum) * ret) / SUM(root_cap * (size - momentum)^2) AS b FROM exposures GROUP BY dt) SELECT dt, ROUND(b, 6) AS size, ROUND(-b, 6) AS momentum FROM b""")
def _(v):
    fit = rg.constrained_wls(v.exposures, ["dt"], ["size", "momentum"], "ret", [[1.0, 1.0]], [0.0], "root_cap")
    return _r(rg.coefficients(fit, ["dt"], ["size", "momentum"]), ["size", "momentum"])


@query("reg03_huber_cross_section", "exposures")
def _(v):
    fit = rg.huber_cross_section(v.exposures, ["region"], STYLES[:2], "ret", "root_cap", intercept=True)
    return _r(rg.coefficients(fit, ["region"], STYLES[:2], True), ["intercept", *STYLES[:2]])


def asset_market(v):
    """Asset returns beside their region's and the world's return."""
    m = v.market.select("region", "mi", "mret")
    return v.panel.select("asset_id", "mi", "region", "country", "ret").join(m, ["region", "mi"]).join(v.world.select("mi", "wret"), "mi")


@query("reg03_huber_history", "panel market")
def _(v):
    return _r(rg.huber_history(asset_market(v), "asset_id", ["mret"], "ret"), ["intercept", "mret"])


@query("reg04_non_negative", "panel market world", """
WITH s AS (SELECT p.asset_id, SUM(m.mret * m.mret) AS aa, SUM(m.mret * w.wret) AS ab, SUM(w.wret * w.wret) AS bb, SUM(m.mret * p.ret) AS ay, SUM(w.wret * p.ret) AS cy
  FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi JOIN world w ON p.mi = w.mi WHERE p.ret IS NOT NULL GROUP BY 1),
u AS (SELECT *, (ay * bb - cy * ab) / NULLIF(aa * bb - ab * ab, 0) AS u1, (cy * aa - ay * ab) / NULLIF(aa * bb - ab * ab, 0) AS u2, CASE WHEN ay > 0 THEN ay * ay / aa ELSE 0 END AS g1, CASE WHEN cy > 0 THEN cy * cy / bb ELSE 0 END AS g2 FROM s)
SELECT asset_id, ROUND(CASE WHEN u1 >= 0 AND u2 >= 0 THEN u1 WHEN g1 > 0 AND g1 >= g2 THEN ay / aa ELSE 0 END, 6) AS mret, ROUND(CASE WHEN u1 >= 0 AND u2 >= 0 THEN u2 WHEN g2 > g1 THEN cy / bb ELSE 0 END, 6) AS wret FROM u""")
def _(v):
    fit = rg.wls(asset_market(v), ["asset_id"], ["mret", "wret"], "ret", solver="nnls")
    return _r(rg.coefficients(fit, ["asset_id"], ["mret", "wret"]), ["mret", "wret"])


_SIMPLE = """s AS (SELECT p.asset_id, COUNT(*) AS n, regr_slope(p.ret, m.mret) AS b, regr_intercept(p.ret, m.mret) AS a, regr_sxx(p.ret, m.mret) AS sxx, regr_syy(p.ret, m.mret) AS syy, AVG(m.mret) AS mx
 FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi WHERE p.ret IS NOT NULL GROUP BY 1),
e AS (SELECT *, CASE WHEN syy - b * b * sxx > 1e-12 * syy THEN syy - b * b * sxx ELSE 0 END AS sse FROM s)"""


@query("reg05_reg_stats", "panel market", "WITH " + _SIMPLE + """,
t AS (SELECT asset_id, 'mret' AS term, b AS coef, sqrt(sse / (n - 2) / sxx) AS se, n, 1 - sse / syy AS r2 FROM e UNION ALL SELECT asset_id, 'intercept', a, sqrt(sse / (n - 2) * (1.0::DOUBLE / n + mx * mx / sxx)), n, 1 - sse / syy FROM e)
SELECT asset_id, term, ROUND(coef, 6) AS coef, ROUND(se, 6) AS se, n, ROUND(r2, 6) AS r2, ROUND(GREATEST(0, 1 - (1 - r2) * (n - 1) / (n - 2)), 6) AS adj_r2, ROUND(coef / NULLIF(se, 0), 6) AS t FROM t""")
def _(v):
    s = rg.reg_stats(asset_market(v), ["asset_id"], ["mret"], "ret", with_p=False)
    return _r(s.select("asset_id", "term", "coef", "se", "n", "r2", "adj_r2", "t"), ["coef", "se", "r2", "adj_r2", "t"])


@query("reg05_white_errors", "exposures")
def _(v):
    x = stored(v.exposures.select("dt", "size", "momentum", "ret", "root_cap"))
    s = rg.reg_stats(x, ["dt"], ["size", "momentum"], "ret", "root_cap", errors="white")
    return _r(s.select("dt", "term", "coef", "se", "t", "p", "r2"), ["coef", "se", "t", "p", "r2"])


@query("reg05_newey_west_errors", "panel market", """
WITH x AS (SELECT p.asset_id, p.mi, p.ret AS y, m.mret AS x FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi WHERE p.ret IS NOT NULL),
f AS (SELECT asset_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, COUNT(*) AS n, SUM(x) AS sx, SUM(x * x) AS sxx FROM x GROUP BY 1),
e AS (SELECT x.asset_id, mi, x, y - a - b * x AS u, a, b, n, sx, sxx FROM x JOIN f USING (asset_id)),
l AS (SELECT *, LAG(u) OVER w AS u1, LAG(u, 2) OVER w AS u2, LAG(x) OVER w AS x1, LAG(x, 2) OVER w AS x2 FROM e WINDOW w AS (PARTITION BY asset_id ORDER BY mi)),
m AS (SELECT asset_id, a, b, n, sx, sxx, n * sxx - sx * sx AS det,
  SUM(u * u) + 2 * (2.0 / 3 * COALESCE(SUM(u * u1), 0) + 1.0 / 3 * COALESCE(SUM(u * u2), 0)) AS m00,
  SUM(u * u * x) + 2.0 / 3 * COALESCE(SUM(u * u1 * (x + x1)), 0) + 1.0 / 3 * COALESCE(SUM(u * u2 * (x + x2)), 0) AS m01,
  SUM(u * u * x * x) + 2 * (2.0 / 3 * COALESCE(SUM(u * u1 * x * x1), 0) + 1.0 / 3 * COALESCE(SUM(u * u2 * x * x2), 0)) AS m11 FROM l GROUP BY ALL)
SELECT asset_id, ROUND(a, 6) AS intercept, ROUND(b, 6) AS mret, ROUND(sqrt(GREATEST((sxx * sxx * m00 - 2 * sxx * sx * m01 + sx * sx * m11) / (det * det), 0)), 6) AS se_intercept,
 ROUND(sqrt(GREATEST((sx * sx * m00 - 2 * sx * n * m01 + n * n * m11) / (det * det), 0)), 6) AS se_mret FROM m""")
def _(v):
    out = rg.newey_west_errors(asset_market(v), "asset_id", ["mret"], "ret", 2, "mi")
    return _r(out, ["intercept", "mret", "se_intercept", "se_mret"])


@query("reg06_vif", "exposures", """
WITH c AS (SELECT dt, SUM(root_cap) AS w, SUM(root_cap * size) AS a, SUM(root_cap * momentum) AS b, SUM(root_cap * size * size) AS aa, SUM(root_cap * momentum * momentum) AS bb, SUM(root_cap * size * momentum) AS ab FROM exposures GROUP BY dt),
r AS (SELECT dt, (ab - a * b / w)^2 / ((aa - a * a / w) * (bb - b * b / w)) AS r2 FROM c)
SELECT dt, 'size' AS factor, ROUND(1 / (1 - r2), 6) AS vif FROM r UNION ALL SELECT dt, 'momentum', ROUND(1 / (1 - r2), 6) FROM r""")
def _(v):
    return _r(rg.vif(v.exposures, ["dt"], ["size", "momentum"], "root_cap"), ["vif"])


@query("reg07_ts_beta", "panel market", f"""
SELECT p.asset_id, ROUND(regr_intercept(COALESCE(p.ret, m.mret), m.mret), 6) AS intercept, ROUND(regr_slope(COALESCE(p.ret, m.mret), m.mret), 6) AS mret, COUNT(*) AS n FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi WHERE p.mi > {END} - 36 AND p.mi <= {END} GROUP BY 1""")
def _(v):
    return _r(rg.ts_beta(asset_market(v), "asset_id", "ret", ["mret"], "mi", END, 36, market="mret"), ["intercept", "mret"])


@query("reg07_ts_beta_weighted", "panel market", f"""
WITH x AS (SELECT p.asset_id, COALESCE(p.ret, m.mret) AS y, m.mret AS x, pow(2.0::DOUBLE, -({END} - p.mi) / 12.0::DOUBLE) AS w FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi WHERE p.mi > {END} - 36 AND p.mi <= {END}),
s AS (SELECT asset_id, COUNT(*) AS n, SUM(w) AS w, SUM(w * x) AS sx, SUM(w * y) AS sy, SUM(w * x * x) AS sxx, SUM(w * x * y) AS sxy FROM x GROUP BY 1), b AS (SELECT *, (sxy - sx * sy / w) / (sxx - sx * sx / w) AS b FROM s)
SELECT asset_id, ROUND((sy - b * sx) / w, 6) AS intercept, ROUND(b, 6) AS mret, n FROM b""")
def _(v):
    return _r(rg.ts_beta(asset_market(v), "asset_id", "ret", ["mret"], "mi", END, 36, lambda pos, age: ts.exp_weight(age, 12), market="mret"), ["intercept", "mret"])


@query("reg07_ts_beta_net_of_market", "panel market world", f"""
WITH x AS (SELECT p.asset_id, COALESCE(p.ret, m.mret) AS y, m.mret AS m, w.wret AS w FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi JOIN world w ON w.mi = p.mi WHERE p.mi > {END} - 48 AND p.mi <= {END}),
f AS (SELECT asset_id, regr_slope(y, m) AS b, regr_intercept(y, m) AS a FROM x GROUP BY 1), e AS (SELECT x.asset_id, y - a - b * m AS e, w, b FROM x JOIN f USING (asset_id))
SELECT asset_id, ROUND(regr_intercept(e, w), 6) AS intercept, ROUND(regr_slope(e, w), 6) AS wret, COUNT(*) AS n, ROUND(ANY_VALUE(b), 6) AS mret FROM e GROUP BY 1 HAVING COUNT(*) >= 2""")
def _(v):
    return _r(rg.ts_beta(asset_market(v), "asset_id", "ret", ["wret"], "mi", END, 48, market="mret", net_of=["mret"]), ["intercept", "wret", "mret"])


@query("reg08_historic_beta", "panel market", f"""
WITH s AS (SELECT p.asset_id, COUNT(*) AS n, regr_slope(COALESCE(p.ret, m.mret), m.mret) AS b, regr_intercept(COALESCE(p.ret, m.mret), m.mret) AS a, regr_sxx(COALESCE(p.ret, m.mret), m.mret) AS sxx, regr_syy(COALESCE(p.ret, m.mret), m.mret) AS syy FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi WHERE p.mi > {END} - 60 AND p.mi <= {END} GROUP BY 1)
SELECT asset_id, ROUND(b, 6) AS beta, ROUND(a, 6) AS alpha, ROUND(b / NULLIF(sqrt(CASE WHEN syy - b * b * sxx > 1e-12 * syy THEN syy - b * b * sxx ELSE 0 END / (n - 2) / sxx), 0), 6) AS t_beta, ROUND(b * b * sxx / syy, 6) AS r2, n FROM s""")
def _(v):
    x = v.panel.select("asset_id", "region", "mi", "ret")
    out = rg.historic_beta(x, v.market, "asset_id", "region", "mi", END, 60, with_p=False)
    return _r(out, ["beta", "alpha", "t_beta", "r2"])


@query("reg08_currency_beta", "panel")
def _(v):
    fx = ts.fx_returns(fx_rates(v), rf_rates(v).drop("mi"), 0).where("ret is not null").select(F.col("ccy").alias("country"), "mi", F.col("ret").alias("mret"))
    x = v.panel.where("country <> 0").select("asset_id", "country", "mi", "ret")
    return _r(rg.historic_beta(x, fx, "asset_id", "country", "mi", END, 60), ["beta", "alpha", "t_beta", "r2", "p_beta"])


@query("reg09_alpha_and_residual_vol", "panel market", "WITH " + _SIMPLE + " SELECT asset_id, ROUND(a, 6) AS alpha, ROUND(b, 6) AS beta, ROUND(sqrt(sse / (n - 2)), 6) AS resid_vol FROM e")
def _(v):
    return _r(rg.alpha_and_residual_vol(asset_market(v).where("ret is not null"), "asset_id", "ret", "mret"), ["alpha", "beta", "resid_vol"])


@query("reg10_world_sensitivity", "panel world", "SELECT p.asset_id, ROUND(regr_slope(p.ret, w.wret), 6) AS sensitivity FROM panel p JOIN world w ON p.mi = w.mi + 1 GROUP BY 1")
def _(v):
    return _r(rg.sensitivity(v.panel, "asset_id", "ret", v.world.select("mi", F.col("wret").alias("factor")), "mi", 1), ["sensitivity"])


@query("reg11_macro_overlapping", "panel world", """
WITH x AS (SELECT p.asset_id, p.mi, p.ret, w.wret FROM panel p JOIN world w ON p.mi = w.mi WHERE p.ret IS NOT NULL),
o AS (SELECT asset_id, SUM(ret) OVER k AS y, SUM(wret) OVER k AS x, COUNT(*) OVER k AS n FROM x WINDOW k AS (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT asset_id, ROUND(regr_slope(y, x), 6) AS wret FROM o WHERE n = 4 GROUP BY 1""")
def _(v):
    x = v.panel.where("ret is not null").select("asset_id", "mi", "ret").join(v.world.select("mi", "wret"), "mi")
    return _r(rg.macro_exposure(x, "asset_id", "ret", ["wret"], "mi", "overlapping", 4), ["wret"])


@query("reg11_macro_block", "panel world", """
WITH b AS (SELECT asset_id, floor(p.mi / 3) AS b, SUM(ret) AS y, SUM(wret) AS x FROM panel p JOIN world w ON p.mi = w.mi WHERE ret IS NOT NULL GROUP BY 1, 2) SELECT asset_id, ROUND(regr_slope(y, x), 6) AS wret FROM b GROUP BY 1""")
def _(v):
    x = v.panel.where("ret is not null").select("asset_id", "mi", "ret").join(v.world.select("mi", "wret"), "mi")
    return _r(rg.macro_exposure(x, "asset_id", "ret", ["wret"], "mi", "block", 3), ["wret"])


@query("reg11_macro_ridge", "panel world", """
SELECT asset_id, ROUND((SUM(wret * ret) + 0.5::DOUBLE * SUM(wret * wret) * 1.0::DOUBLE) / (SUM(wret * wret) * 1.5::DOUBLE), 6) AS wret FROM panel p JOIN world w ON p.mi = w.mi WHERE ret IS NOT NULL GROUP BY 1""")
def _(v):
    x = v.panel.where("ret is not null").select("asset_id", "mi", "ret").join(v.world.select("mi", "wret"), "mi")
    prior = v.panel.select("asset_id").distinct().withColumn("wret", F.lit(1.0))
    return _r(rg.macro_exposure(x, "asset_id", "ret", ["wret"], "mi", "ridge", prior=prior, ridge=0.5), ["wret"])


_NESTED = """x AS (SELECT p.asset_id, p.region, p.ret AS y, w.wret AS a, m.mret AS b FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi JOIN world w ON p.mi = w.mi WHERE p.ret IS NOT NULL),
s AS (SELECT asset_id, region, SUM(a * a) AS aa, SUM(a * b) AS ab, SUM(b * b) AS bb, SUM(a * y) AS ay, SUM(b * y) AS cy FROM x GROUP BY 1, 2)"""


@query("reg11_macro_nested", "panel market world", "WITH " + _NESTED + """
SELECT asset_id, ROUND(ay / aa, 6) AS wret, ROUND((cy - ab / aa * ay) / (bb - ab * ab / aa), 6) AS mret FROM s WHERE aa > 0 AND bb - ab * ab / aa > 1e-9 * bb""")
def _(v):
    x = asset_market(v).where("ret is not null")
    out = rg.nested_exposure(x, "asset_id", "ret", [["wret"], ["mret"]])
    some = x.groupBy("asset_id").agg(F.sum(F.col("wret") ** 2).alias("aa"), F.sum(F.col("wret") * F.col("mret")).alias("ab"), F.sum(F.col("mret") ** 2).alias("bb"))
    clear = some.where("aa > 0 AND bb - ab * ab / aa > 1e-9 * bb").select("asset_id")  # one month has no second direction
    return _r(out.join(clear, "asset_id"), ["wret", "mret"])


@query("reg11_macro_nested_raw", "panel market world", "WITH " + _NESTED + " SELECT asset_id, ROUND(ay / aa, 6) AS wret, ROUND((cy - ab * ay / aa) / bb, 6) AS mret FROM s WHERE aa > 0 AND bb > 0")
def _(v):
    return _r(rg.nested_exposure(asset_market(v).where("ret is not null"), "asset_id", "ret", [["wret"], ["mret"]], orthogonal=False), ["wret", "mret"])


@query("reg11_macro_sector", "panel market world", "WITH " + _NESTED + """
SELECT asset_id, ROUND(ay / aa, 6) AS wret, CASE WHEN region = 0 THEN ROUND((cy - ab * ay / aa) / bb, 6) ELSE 0 END AS m0, CASE WHEN region = 1 THEN ROUND((cy - ab * ay / aa) / bb, 6) ELSE 0 END AS m1
FROM s WHERE region < 2 AND aa > 0 AND bb > 0""")
def _(v):
    """Two regions as sectors: each asset meets the world, and what is left meets its own region only."""
    m = v.market.where("region < 2").groupBy("mi").pivot("region", [0, 1]).agg(F.first("mret")).withColumnsRenamed({"0": "m0", "1": "m1"})
    x = v.panel.where("ret is not null and region < 2").select("asset_id", "region", "mi", "ret").join(m, "mi").join(v.world.select("mi", "wret"), "mi")
    x = x.withColumn("m0", F.coalesce("m0", F.lit(0.0))).withColumn("m1", F.coalesce("m1", F.lit(0.0)))
    return _r(rg.nested_exposure(x, "asset_id", "ret", [["m0", "wret", "m1"]], orthogonal=False, sector="region", sector_factors={0: "m0", 1: "m1"}, sector_last=True), ["wret", "m0", "m1"]).select("asset_id", "wret", "m0", "m1")


@query("reg12_cochrane_orcutt", "panel market")
def _(v):
    return _r(rg.cochrane_orcutt(asset_market(v), "asset_id", ["mret"], "ret", "mi"), ["intercept", "mret", "rho"])


@query("reg13_var1", "factor_ret", """
WITH l AS (SELECT mi, f_size, f_mom, LAG(f_size) OVER (ORDER BY mi) AS a, LAG(f_mom) OVER (ORDER BY mi) AS b FROM factor_ret),
x AS (SELECT 'f_size' AS equation, f_size AS y, a, b FROM l WHERE a IS NOT NULL UNION ALL SELECT 'f_mom', f_mom, a, b FROM l WHERE a IS NOT NULL),
s AS (SELECT equation, AVG(y) AS my, AVG(a) AS ma, AVG(b) AS mb, covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(a, b) AS ab, covar_pop(y, a) AS ya, covar_pop(y, b) AS yb FROM x GROUP BY 1),
c AS (SELECT *, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS ca, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS cb FROM s)
SELECT equation, ROUND(my - ca * ma - cb * mb, 6) AS intercept, ROUND(ca, 6) AS lag_f_size, ROUND(cb, 6) AS lag_f_mom FROM c""")
def _(v):
    out = rg.var1(v.factor_ret.select("mi", "f_size", "f_mom"), "mi", ["f_size", "f_mom"])
    return _r(out, ["intercept", "lag_f_size", "lag_f_mom"])


@query("reg14_reduced_rank", "market factor_ret")
def _(v):
    m = v.market.groupBy("mi").pivot("region", [0, 1, 2, 3, 4]).agg(F.first("mret"))
    m = m.withColumnsRenamed({str(i): f"r{i}" for i in range(5)}).join(v.factor_ret.select("mi", "f_size", "f_mom"), "mi")
    return _r(rg.reduced_rank(m, [f"r{i}" for i in range(5)], ["f_size", "f_mom"], 1), ["coef"])


def linked_lines(v):
    """Groups of four suppliers as an issuer; the largest id's neighbour with top value is the master."""
    a = v.panel.groupBy("asset_id").agg(F.round(F.avg("mcap"), 4).alias("score")).withColumn("issuer", F.floor(F.col("asset_id") / 4))
    best = a.groupBy("issuer").agg(F.max_by("asset_id", F.struct("score", "asset_id")).alias("master"))
    return a.join(best, "issuer")


@query("reg15_cointegration", "panel")
def _(v):
    out = rg.cointegration(v.panel.select("asset_id", "mi", "ret"), linked_lines(v), "asset_id", "issuer", "mi")
    return _r(out, ["coef", "adf_t", "err_var"])


_COINT = """a AS (SELECT asset_id, CAST(floor(asset_id / 4) AS BIGINT) AS issuer, ROUND(AVG(mcap), 4) AS score FROM panel GROUP BY 1),
l AS (SELECT *, FIRST_VALUE(asset_id) OVER (PARTITION BY issuer ORDER BY score DESC, asset_id DESC) AS master FROM a),
px AS (SELECT asset_id, mi, SUM(ln(1 + COALESCE(ret, 0))) OVER (PARTITION BY asset_id ORDER BY mi) AS lp FROM panel),
c AS (SELECT l.issuer, l.master, l.asset_id, GREATEST(0.67::DOUBLE, LEAST(1.5::DOUBLE, SUM(p.lp * m.lp) / SUM(m.lp * m.lp))) AS coef, COUNT(*) AS n FROM l JOIN px p ON p.asset_id = l.asset_id JOIN px m ON m.asset_id = l.master AND m.mi = p.mi WHERE l.asset_id <> l.master GROUP BY 1, 2, 3)"""


@query("reg15_cointegration_coefficients", "panel", "WITH " + _COINT + " SELECT issuer, master, asset_id, ROUND(coef, 6) AS coef, n FROM c")
def _(v):
    out = rg.cointegration(v.panel.select("asset_id", "mi", "ret"), linked_lines(v), "asset_id", "issuer", "mi")
    return _r(out.select("issuer", "master", "asset_id", "coef", "n"), ["coef"])


@query("reg16_cointegration_report", "panel")
def _(v):
    out = rg.cointegration(v.panel.select("asset_id", "mi", "ret"), linked_lines(v), "asset_id", "issuer", "mi")
    return _r(rg.cointegration_report(out), ["share", "mean_coef"])


# --- factor returns -----------------------------------------------------------------------


def _exp(v, *cols):
    return stored(v.exposures.select("asset_id", "dt", "region", "country", "mcap", "root_cap", "ret", *STYLES, *cols))


@query("fac01_factor_returns", "exposures factor_ret", """
SELECT dt, factor, ROUND(value, 6) AS value FROM (SELECT dt, 'size' AS factor, f_size AS value FROM factor_ret UNION ALL SELECT dt, 'momentum', f_mom FROM factor_ret)""")
def _(v):
    x = _exp(v)
    fit = fa.factor_regression(x, "dt", ["size", "momentum"], "ret", "mcap", clip_at=None)
    return _r(fa.factor_rows(fit.where("n > 2"), "dt", ["size", "momentum"]), ["value"])


@query("fac01_specific_returns", "specific", "SELECT asset_id, dt, ROUND(sret, 6) AS sret FROM specific")
def _(v):
    x = _exp(v)
    fit = fa.factor_regression(x, "dt", ["size", "momentum"], "ret", "mcap", clip_at=None)
    return _r(fa.specific_returns(x, fit, "dt", ["size", "momentum"], "ret").select("asset_id", "dt", "sret"), ["sret"])


@query("fac01_factor_returns_clipped", "exposures")
def _(v):
    # market, four styles and regions against the first one
    x = _exp(v).withColumn("market", F.lit(1.0)).withColumns({f"r{i}": F.when(F.col("region") == i, 1.0).otherwise(0.0) for i in range(1, 5)})
    xs = ["market", *STYLES, "r1", "r2", "r3", "r4"]
    fit = fa.factor_regression(x, "dt", xs, "ret", "mcap", clip_at=5.0)
    return _r(fa.factor_rows(fit, "dt", xs), ["value"])


@query("fac01_regression_statistics", "exposures")
def _(v):
    s = fa.regression_stats(_exp(v), "dt", ["size", "momentum"], "ret", "root_cap")
    return _r(s, ["coef", "se", "t", "p", "r2", "adj_r2"])


@query("fac02_nested", "exposures", """
WITH a AS (SELECT dt, SUM(root_cap * size * ret) / SUM(root_cap * size * size) AS f FROM exposures WHERE mcap > 50000 GROUP BY dt), e AS (SELECT x.*, ret - size * f AS e FROM exposures x JOIN a ON x.dt = a.dt),
b AS (SELECT dt, SUM(root_cap * turnover * e) / SUM(root_cap * turnover * turnover) AS f FROM e WHERE region < 3 GROUP BY dt)
SELECT dt, 'size' AS factor, 'main' AS regression, ROUND(f, 6) AS value FROM a UNION ALL SELECT dt, 'turnover', 'local', ROUND(f, 6) FROM b""")
def _(v):
    x = _exp(v).withColumn("main_estu", F.col("mcap") > 50000).withColumn("local_estu", F.col("region") < 3)
    rows, _ = fa.nested(x, "dt", "ret", "mcap", [("main", ["size"], "main_estu"), ("local", ["turnover"], "local_estu")])
    return _r(rows.select("dt", "factor", "regression", "value"), ["value"])


@query("fac03_thin_dummies", "exposures", """
WITH x AS (SELECT dt, country, root_cap AS w, size, ret FROM exposures), m AS (SELECT dt, SUM(w * ret) / SUM(w) AS mkt FROM x GROUP BY dt),
f AS (SELECT dt, country, SUM(w) AS total, SUM(w)^2 / SUM(w * w) AS eff_n, SUM(w * size) / SUM(w) AS size FROM x WHERE country IN (1, 2, 3) GROUP BY 1, 2)
SELECT f.dt, concat('c', country) AS factor, ROUND(eff_n, 6) AS eff_n, ROUND(size, 6) AS size, ROUND(mkt, 6) AS ret, ROUND((6 - eff_n) * total / eff_n, 4) AS weight FROM f JOIN m ON f.dt = m.dt WHERE eff_n < 6""")
def _(v):
    x = _exp(v).withColumns({f"c{i}": F.when(F.col("country") == i, 1.0).otherwise(0.0) for i in (1, 2, 3)})
    d = fa.thin_dummies(x, "dt", ["size", "c1", "c2", "c3"], ["c1", "c2", "c3"], "ret", "root_cap", 6.0, styles=["size"])
    return _r(d.select("dt", "factor", F.round("eff_n", 6).alias("eff_n"), F.round("size", 6).alias("size"), F.round("ret", 6).alias("ret"), F.round("_w", 4).alias("weight")), [])


@query("fac03_regression_with_dummies", "exposures")
def _(v):
    cs = [f"c{i}" for i in range(1, 25)]
    x = _exp(v).withColumns({f"c{i}": F.when(F.col("country") == i, 1.0).otherwise(0.0) for i in range(1, 25)})
    d = fa.thin_dummies(x, "dt", ["size", *cs], cs, "ret", "root_cap", 6.0, "fourth_power", ["size"])
    fit = fa.factor_regression(x, "dt", ["size", *cs], "ret", "mcap", clip_at=None, dummies=d)
    return _r(fa.factor_rows(fit, "dt", ["size", *cs]), ["value"])


@query("fac04_screen_factors", "exposures", """
WITH x AS (SELECT dt, size, 0.0 AS momentum, CASE WHEN country = 1 THEN 1.0 ELSE 0.0 END AS c1 FROM exposures),
g AS (SELECT dt, COUNT(CASE WHEN size <> 0 THEN 1 END) AS a, MIN(size) = MAX(size) AS k, COUNT(CASE WHEN c1 <> 0 THEN 1 END) AS c FROM x GROUP BY dt)
SELECT dt, 'size' AS factor, a AS n, CASE WHEN a = 0 THEN 'empty' WHEN k THEN 'constant' ELSE 'ok' END AS status FROM g UNION ALL SELECT dt, 'momentum', 0, 'empty' FROM g UNION ALL SELECT dt, 'c1', c, CASE WHEN c = 0 THEN 'empty' ELSE 'ok' END FROM g""")
def _(v):
    x = v.exposures.withColumn("c1", F.when(F.col("country") == 1, 1.0).otherwise(0.0))
    return fa.screen_factors(x, "dt", ["size", "momentum", "c1"], ["size", "momentum"], ["momentum"])[1]


_FMP = """c AS (SELECT dt, SUM(root_cap * size * size) AS a, SUM(root_cap * momentum * momentum) AS b, SUM(root_cap * size * momentum) AS m FROM exposures GROUP BY dt)
SELECT asset_id, e.dt, ROUND(root_cap * (b * size - m * momentum) / (a * b - m * m), 6) AS fmp_size, ROUND(root_cap * (a * momentum - m * size) / (a * b - m * m), 6) AS fmp_momentum FROM exposures e JOIN c ON e.dt = c.dt WHERE a * b - m * m > 1e-6 * a * b"""


@query("fac05_mimicking_portfolios", "exposures", "WITH " + _FMP)
def _(v):
    x = _exp(v)
    return _r(fa.mimicking_portfolios(x, "dt", "asset_id", ["size", "momentum"], "root_cap"), ["fmp_size", "fmp_momentum"])


@query("src28_fmp_extract", "exposures", "WITH f AS (WITH " + _FMP + ") SELECT asset_id, dt, fmp_size FROM f WHERE dt = (SELECT MAX(dt) FROM exposures)")
def _(v):
    out = fa.mimicking_portfolios(v.latest_exp, "dt", "asset_id", ["size", "momentum"], "root_cap")
    return _r(out.select("asset_id", "dt", "fmp_size"), ["fmp_size"])


def _window(v):
    return stored(v.panel.where("ret is not null").select("asset_id", "region", "country", "dt", "mi", "ret"))


@query("fac06_apca_factor_returns", "panel")
def _(v):
    return _r(fa.apca(_window(v), "asset_id", "dt", "ret", 3)[0], ["f1", "f2", "f3"])


@query("fac06_apca_exposures", "panel")
def _(v):
    x = _window(v)
    scale = x.groupBy("asset_id").agg(F.stddev_samp("ret").alias("root"))
    return _r(fa.apca(x, "asset_id", "dt", "ret", 3, scale=scale)[1], ["f1", "f2", "f3"])


@query("fac06_subspace_agrees", "panel", "SELECT f, true AS same FROM (VALUES ('f1'), ('f2'), ('f3')) x(f)")
def _(v):
    """Leading components found without the date x date matrix and with it: every date's factor returns alike up to sign."""
    x = _window(v)
    a, b = fa.apca(x, "asset_id", "dt", "ret", 3)[0], fa.subspace_components(x, "asset_id", "dt", "ret", 3, tol=1e-12, most=100)[0]
    j = a.join(b.withColumnsRenamed({f"f{i}": f"g{i}" for i in (1, 2, 3)}), "dt")
    along = j.agg(*[F.abs(F.sum(F.col(f"f{i}") * F.col(f"g{i}"))).alias(f"f{i}") for i in (1, 2, 3)])
    return along.unpivot([], ["f1", "f2", "f3"], "f", "c").select("f", (F.abs(F.col("c") - 1) < 1e-4).alias("same"))


@query("fac06_subspace_daily", "")
def _(v):
    """Daily price moves of suppliers: some thousand dates."""
    d = v.lineitem.groupBy(F.col("l_suppkey").alias("asset_id"), F.col("l_shipdate").cast("date").alias("dt")).agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price"))
    w = Window.partitionBy("asset_id").orderBy("dt")
    x = d.withColumn("ret", F.log("price") - F.log(F.lag("price").over(w))).where("ret is not null")
    return _r(fa.subspace_components(x, "asset_id", "dt", "ret", 3, tol=1e-4)[2], ["explained"], 4)


@query("fac07_apca_jones", "panel")
def _(v):
    return _r(fa.apca(_window(v), "asset_id", "dt", "ret", 3, jones=True)[0], ["f1", "f2", "f3"])


@query("fac08_apca_by_region", "panel")
def _(v):
    return _r(fa.apca(_window(v), "asset_id", "dt", "ret", 2, by=["region"])[2], ["explained"])


@query("fac09_statistical_model", "panel")
def _(v):
    x = _window(v)
    before = fa.apca(x.where(F.col("mi") < F.lit(END)), "asset_id", "dt", "ret", 2)[1]
    return _r(fa.statistical_model(x, "asset_id", "dt", "ret", 2, before=before)["exposures"], ["f1", "f2"])


@query("fac10_currency_model", "panel")
def _(v):
    fx = stored(ts.fx_returns(fx_rates(v), rf_rates(v).drop("mi"), 0).select("ccy", "dt", "ret").where("ccy <> 0"))
    return _r(fa.currency_model(fx, "ccy", "dt", "ret", 3, pegged=[5, 6])["exposures"], ["f1", "f2", "f3"])


@query("fac09_parts_add_up", "panel", "SELECT asset_id, dt, ROUND(ret, 6) AS ret FROM panel WHERE ret IS NOT NULL")
def _(v):
    """Exposures times factor returns, both turned to agree with the former model, and the specific return."""
    x = _window(v)
    before = fa.apca(x.where(F.col("mi") < F.lit(END)), "asset_id", "dt", "ret", 2)[1].withColumns({"f1": -F.col("f1"), "f2": -F.col("f2")})
    m = fa.statistical_model(x, "asset_id", "dt", "ret", 2, before=before)
    fitted = m["exposures"].unpivot(["asset_id"], ["f1", "f2"], "factor", "load").join(m["factor_returns"], "factor")
    fitted = fitted.groupBy("asset_id", "dt").agg(F.sum(F.col("load") * F.col("value")).alias("fit"))
    return m["specific"].join(fitted, ["asset_id", "dt"]).select("asset_id", "dt", F.round(F.col("sret") + F.col("fit"), 6).alias("ret"))


def country_returns(v):
    """Monthly returns of countries with the day on which each is published: the next month's 5th, 15th or 25th."""
    s = ts.weighted_return(v.panel, ["region", "country", "dt", "mi"], "ret", "lag_mcap", "x")
    return s.withColumn("released", F.date_add(F.add_months("dt", 1), (F.col("country") % 3 * 10 + 4).cast("int")))


VINTAGES = [date(1995, 6, 10), date(1997, 3, 1), date(1999, 1, 1)]


@query("fac11_vintages", "revisions", """
SELECT id, dt, as_of, value FROM revisions, (VALUES (DATE '1995-06-10'), (DATE '1997-03-01'), (DATE '1999-01-01')) a(as_of) WHERE rev_dt <= as_of
QUALIFY row_number() OVER (PARTITION BY id, dt, as_of ORDER BY rev_dt DESC, value DESC) = 1""")
def _(v):
    return mc.vintages(v.revisions, ["id", "dt"], "value", "rev_dt", VINTAGES)


@query("fac11_macro_factors", "panel")
def _(v):
    known = mc.vintages(country_returns(v), ["region", "country", "mi"], "x", "released", VINTAGES)
    out = mc.state_space_factors(known, ["region", "as_of"], "country", "mi", "x", 2)["factors"]
    return _r(out, ["f1", "f2"], 4)


@query("fac11_macro_loadings", "panel")
def _(v):
    known = mc.vintages(country_returns(v), ["region", "country", "mi"], "x", "released", VINTAGES[-1:])
    return _r(mc.state_space_factors(known, ["region"], "country", "mi", "x", 2)["loadings"], ["f1", "f2", "rho", "sigma2"], 4)


def daily_prices(v):
    """Mean price of each region and day, and how far it is from the month's first."""
    places = v.supplier.join(v.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("region"))
    d = v.lineitem.join(places, "l_suppkey").withColumn("day", F.col("l_shipdate").cast("date"))
    d = d.groupBy("region", "day").agg(F.sum("l_extendedprice").alias("p"), F.sum("l_quantity").alias("q"))
    return d.select("region", "day", ts.month_index(F.trunc("day", "month")).alias("mi"), F.round(F.col("p") / F.col("q"), 9).alias("x"))


@query("fac11_daily_expansion", "market", """
WITH d AS (SELECT n_regionkey AS region, CAST(l_shipdate AS DATE) AS day, ROUND(SUM(l_extendedprice) / SUM(l_quantity), 9) AS x
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
e AS (SELECT *, CAST(12 * year(day) + month(day) AS BIGINT) AS mi FROM d),
m AS (SELECT e.region, e.mi, COUNT(*) AS n, SUM(x) AS s, ANY_VALUE(mret) AS y FROM e JOIN market k ON k.region = e.region AND k.mi = e.mi GROUP BY 1, 2),
c AS (SELECT region, SUM(n) AS nn, SUM(s) AS ss, SUM(s * s / n) AS qq, SUM(y) AS yy, SUM(s * y / n) AS sy FROM m GROUP BY 1),
b AS (SELECT region, (sy - ss * yy / nn) / (qq - ss * ss / nn) AS b, (yy - ss * (sy - ss * yy / nn) / (qq - ss * ss / nn)) / nn AS a FROM c)
SELECT e.region, day, ROUND(a + b * x + COALESCE((y - n * a - b * s) / n, 0), 6) AS mret, 0.0::DOUBLE AS rho FROM e JOIN b ON b.region = e.region LEFT JOIN m ON m.region = e.region AND m.mi = e.mi""")
def _(v):
    return _r(mc.daily_expansion(v.market, daily_prices(v), ["region"], "mi", "day", "mret", ["x"], rho=0.0), ["mret"])


@query("fac11_daily_factors", "panel")
def _(v):
    """Monthly state-space factors made daily by the region's daily price, with noise that goes on from day to day."""
    known = mc.vintages(country_returns(v), ["region", "country", "mi"], "x", "released", VINTAGES[-1:])
    f = mc.state_space_factors(known, ["region"], "country", "mi", "x", 1)["factors"]
    return _r(mc.daily_expansion(f, daily_prices(v), ["region"], "mi", "day", "f1", ["x"]), ["f1"], 4)


@query("fac12_projection", "factor_ret market")
def _(v):
    from riskloom.operators import aggregates as ag

    m = v.market.groupBy("mi").pivot("region", [0, 1]).agg(F.first("mret")).withColumnsRenamed({"0": "r0", "1": "r1"})
    x = m.join(v.factor_ret.select("mi", "f_size", "f_mom"), "mi").unpivot(["mi"], ["r0", "r1", "f_size", "f_mom"], "f", "v")
    return _r(fa.project(ag.covariance(x, "f", "v", "mi"), ["r0", "r1"], ["f_size", "f_mom"])["betas"], ["beta"])


@query("fac13_link_returns", "factor_ret market", """
SELECT factor, dt, model, ROUND(value, 6) AS value FROM (SELECT 'a-size' AS factor, dt, 'a' AS model, f_size AS value FROM factor_ret UNION ALL SELECT 'momentum', dt, 'a', f_mom FROM factor_ret UNION ALL SELECT 'b-size', dt, 'b', mret FROM market WHERE region = 0)""")
def _(v):
    a = v.factor_ret.select("dt", F.col("f_size").alias("size"), F.col("f_mom").alias("momentum")).unpivot(["dt"], ["size", "momentum"], "factor", "value")
    b = v.market.where("region = 0").select("dt", F.lit("size").alias("factor"), F.col("mret").alias("value"))
    return _r(fa.link_returns({"a": a, "b": b}), ["value"])


@query("win43_component_proxy", "panel market")
def _(v):
    x = v.panel.join(v.market.select("region", "mi", F.col("mret").alias("proxy")), ["region", "mi"], "left")
    x = x.select("asset_id", "mi", F.when((F.col("asset_id") + F.col("mi")) % 4 < 3, F.col("ret")).alias("ret"), "proxy")
    return _r(fa.fill_by_components(x, "asset_id", "mi", "ret", "proxy", 100, k=5).select("asset_id", "mi", "filled"), ["filled"])
