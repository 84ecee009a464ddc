"""Risk, with the extracts that read it."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import aggregates as ag, factors as fa, joins as jn, regressions as rg, risk as rk, timeseries as ts
from riskloom.plans.q_agg import _FS, factor_long
from riskloom.plans.q_base import fx_rates, rf_rates
from riskloom.plans.q_reg import linked_lines
from riskloom.plans.registry import query
from riskloom.session import stored
from riskloom.sources import extracts as ex

END = 12 * 2000 + 12
XS = ["momentum", "size"]


def _r(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


def spec_table(v):
    """Specific variance per asset."""
    return v.spec_risk.select("asset_id", F.col("svar").alias("spec_var"))


def latest(v):
    """Latest exposures, stored once: most risk reports join them more than once."""
    return stored(v.latest_exp.select("asset_id", "country", "region", "mcap", *XS))


def market_factors(v):
    """Seven monthly series: five regional market returns and two factor returns."""
    m = v.market.select("mi", F.concat(F.lit("r"), F.col("region")).alias("factor"), F.col("mret").alias("value"))
    f = factor_long(v).select("mi", F.col("f").alias("factor"), F.col("v").alias("value"))
    return stored(m.unionByName(f).where(F.col("mi") > END - 66))


@query("rsk01_factor_covariance", "factor_ret", "WITH " + _FS.replace("(v - m)", "v").replace("sqrt(n - 1)", "sqrt(n)") + """
SELECT c0.f1, c0.f2, ROUND(12 * (c0.value + 0.5 * (a.value + b.value)), 6) AS value FROM c0 JOIN c1 a ON a.f1 = c0.f1 AND a.f2 = c0.f2 JOIN c1 b ON b.f1 = c0.f2 AND b.f2 = c0.f1""")
def _(v):
    x = factor_long(v)
    return _r(rk.factor_cov(x, "f", "v", "mi", 24.0, 24.0, 1, 1, annual=12.0, floor=None), ["value"])


@query("rsk01_factor_covariance_composite", "factor_ret market")
def _(v):
    return _r(rk.factor_cov(market_factors(v), step="mi", corr_half_life=36.0, var_half_life=18.0, annual=12.0, dva=20, shrink_obs=60), ["value"])


@query("rsk02_block_diagonal", "factor_ret", "WITH " + _FS + " SELECT f1, f2, ROUND(CASE WHEN f1 = f2 THEN value ELSE 0 END, 9) AS value FROM c0")
def _(v):
    c = ag.covariance(factor_long(v), "f", "v", "mi", 24.0)
    b = v.spark.createDataFrame([("size", "a"), ("momentum", "b")], "factor string, block string")
    return _r(rk.block_diagonal(c, b), ["value"], 9)


@query("rsk02_stambaugh", "factor_ret market", """
WITH x AS (SELECT m.mi, m.mret AS a, CASE WHEN m.mi > 23990 THEN f.f_mom END AS b FROM market m JOIN factor_ret f ON m.mi = f.mi WHERE m.region = 0),
l AS (SELECT var_pop(a) AS v11 FROM x), s AS (SELECT covar_pop(b, a) / var_pop(a) AS beta, var_pop(b) - covar_pop(b, a)^2 / var_pop(a) AS left_var FROM x WHERE b IS NOT NULL)
SELECT 'a' AS f1, 'a' AS f2, ROUND(v11, 9) AS value FROM l UNION ALL SELECT 'a', 'b', ROUND(v11 * beta, 9) FROM l, s UNION ALL SELECT 'b', 'a', ROUND(v11 * beta, 9) FROM l, s UNION ALL SELECT 'b', 'b', ROUND(left_var + beta * beta * v11, 9) FROM l, s""")
def _(v):
    x = v.market.where("region = 0").select("mi", F.col("mret").alias("a")).join(v.factor_ret.select("mi", F.when(F.col("mi") > 23990, F.col("f_mom")).alias("b")), "mi")
    return _r(rk.stambaugh(x, "mi", ["a"], ["b"]), ["value"], 9)


@query("rsk03_impose_blocks", "factor_ret market")
def _(v):
    x = market_factors(v)
    c = ag.covariance(x, "factor", "value", "mi")
    t = ag.covariance(x.where(F.col("factor").startswith("r")), "factor", "value", "mi", 12.0).withColumn("block", F.lit("regions"))
    return _r(rk.impose_blocks(c, t), ["value"], 9)


@query("rsk04_shrinkage", "factor_ret market")
def _(v):
    return _r(rk.shrink(ag.covariance(market_factors(v), "factor", "value", "mi"), 66), ["value"], 9)


@query("rsk04_eigenvalue_floor", "market")
def _(v):
    x = market_factors(v).where(F.col("mi") > END - 4)
    return _r(rk.floor_eigenvalues(ag.covariance(x, "factor", "value", "mi"), 1e-4), ["value"], 9)


_SV = f"""x AS (SELECT asset_id, mi, sret AS r, pow(2.0::DOUBLE, -({END} - mi) / 24.0::DOUBLE) AS w0 FROM specific WHERE mi > {END} - 60 AND mi <= {END}), t AS (SELECT SUM(pow(2.0::DOUBLE, -i / 24.0::DOUBLE)) AS t FROM range(60) r(i)),
z AS (SELECT asset_id, mi, r, w0 * 60 / t AS w FROM x, t),
l AS (SELECT a.asset_id, a.r, a.w, COALESCE(sqrt(b.w) * b.r, 0) * sqrt(a.w) * a.r AS l1 FROM z a LEFT JOIN z b ON b.asset_id = a.asset_id AND b.mi = a.mi - 1),
sv AS (SELECT asset_id, SUM(w * r * r + 2 * 0.5::DOUBLE * l1) / 60 AS spec_var, SUM(CASE WHEN r <> 0 THEN 1 ELSE 0 END)::BIGINT AS n_ret FROM l GROUP BY 1)"""


@query("rsk05_specific_variance", "specific", "WITH " + _SV + " SELECT asset_id, ROUND(spec_var, 9) AS spec_var, n_ret FROM sv")
def _(v):
    return _r(rk.specific_variance(v.specific, "asset_id", "mi", "sret", END, 60, 24.0, 1), ["spec_var"], 9)


@query("rsk05_specific_risk", "specific", "WITH " + _SV + """,
c AS (SELECT asset_id, country, AVG(mcap) AS mcap FROM specific GROUP BY 1, 2), p AS (SELECT country, SUM(sqrt(mcap) * spec_var) / SUM(sqrt(mcap)) AS p FROM sv JOIN c USING (asset_id) WHERE n_ret >= 40 GROUP BY 1)
SELECT asset_id, n_ret, ROUND(sqrt(GREATEST(0.0001::DOUBLE, LEAST(9::DOUBLE, 12 * CASE WHEN p IS NULL THEN spec_var ELSE (1 - pow(2.0::DOUBLE, -n_ret / 12.0::DOUBLE)) * spec_var + pow(2.0::DOUBLE, -n_ret / 12.0::DOUBLE) * p END))), 6) AS spec_risk FROM sv JOIN c USING (asset_id) LEFT JOIN p USING (country)""")
def _(v):
    x = stored(v.specific.select("asset_id", "mi", "sret", "country", "mcap"))
    var = rk.specific_variance(x, "asset_id", "mi", "sret", END, 60, 24.0, 1)
    attr = x.groupBy("asset_id", "country").agg(F.avg("mcap").alias("mcap"))
    out = rk.blend_specific(var, rk.proxy_variance(var, attr, "asset_id", ["country"], "mcap", 40), "asset_id", 24.0, 12.0, 0.0001, 9.0)
    return _r(out.select("asset_id", "n_ret", "spec_risk"), ["spec_risk"])


@query("rsk05_specific_risk_overlap", "specific")
def _(v):
    x = stored(v.specific.select("asset_id", "mi", "sret"))
    first = x.groupBy("asset_id").agg(F.min("mi").alias("first"))
    return _r(rk.specific_variance(x, "asset_id", "mi", "sret", END, 60, 24.0, clip_at=5.0, overlap=3, first_step=first), ["spec_var"], 9)


_LK = """a AS (SELECT asset_id, CAST(floor(asset_id / 4) AS BIGINT) AS issuer, ROUND(AVG(mcap), 4) AS score FROM panel GROUP BY 1),
ln AS (SELECT *, FIRST_VALUE(asset_id) OVER (PARTITION BY issuer ORDER BY score DESC, asset_id DESC) AS master FROM a),
x AS (SELECT asset_id, mi, sret * sqrt(pow(2.0::DOUBLE, -({e} - mi) / 24.0::DOUBLE)) AS s FROM specific WHERE mi <= {e}),
j AS (SELECT ln.issuer, ln.master, ln.asset_id, x.mi, x.s, m.s AS m FROM ln JOIN x ON x.asset_id = ln.asset_id JOIN x m ON m.asset_id = ln.master AND m.mi = x.mi WHERE ln.asset_id <> ln.master),
k AS (SELECT *, COALESCE(LAG(s) OVER w, 0) AS s1, COALESCE(LAG(m) OVER w, 0) AS m1 FROM j WINDOW w AS (PARTITION BY asset_id ORDER BY mi)),
g AS (SELECT issuer, master, asset_id, SUM(s * s + s * s1) AS xx, SUM(m * m + m * m1) AS yy, SUM(s * m + 0.5::DOUBLE * (s * m1 + m * s1)) AS xy FROM k GROUP BY 1, 2, 3),
dc AS (SELECT issuer, master, asset_id, 0.33::DOUBLE + 0.67::DOUBLE * GREATEST(0.25::DOUBLE, LEAST(0.99995::DOUBLE, CASE WHEN xx > 0 AND yy > 0 THEN xy / sqrt(xx * yy) ELSE 0 END)) AS corr FROM g)""".replace("{e}", str(END))


@query("rsk06_linked_correlation", "specific", "WITH " + _LK + " SELECT issuer, master, asset_id, ROUND(corr, 6) AS corr FROM dc")
def _(v):
    out = rk.linked_correlation(v.specific, linked_lines(v), "asset_id", "issuer", "mi", "sret", END, 24.0)
    return _r(out, ["corr"])


def linked_cov(v):
    """Linked covariances of the panel's issuers, of every pair of an issuer's lines."""
    sp = stored(v.specific.select("asset_id", "mi", "sret"))
    lines = stored(linked_lines(v))
    pairs = stored(rk.linked_pairs(lines, "asset_id", "issuer"))
    direct = rk.linked_correlation(sp, pairs.where("asset_id > master"), "asset_id", "issuer", "mi", "sret", END, 24.0)
    coint = stored(rg.cointegration(sp.withColumnRenamed("sret", "ret"), pairs, "asset_id", "issuer", "mi"))
    spec = sp.groupBy("asset_id").agg((12 * F.avg(F.col("sret") * F.col("sret"))).alias("spec_var"))
    return rk.linked_covariance(spec, coint, direct, lines, "asset_id", "issuer", annual=12.0)


@query("rsk07_linked_covariance", "specific")
def _(v):
    return _r(linked_cov(v)["pairs"], ["corr", "cov"])


def merged(v):
    """Issuers of suppliers, some dual-listed, some with a line cloned by another issuer's or held by two."""
    lines = v.supplier.select(F.col("s_suppkey").alias("asset_id")).withColumn("issuer", F.floor(F.col("asset_id") / 4))
    lines = lines.union(lines.where("asset_id % 40 = 13").withColumn("issuer", F.col("issuer") + 2))
    links = lines.where("asset_id % 16 = 7").select("asset_id", (F.col("asset_id") + 9).alias("master"))
    dual = lines.where("issuer % 5 = 0").select(F.col("issuer").alias("a"), (F.col("issuer") + 1).alias("b")).distinct()
    return jn.merged_groups(lines, links, dual, "issuer", "asset_id")


@query("rsk07_merged_groups", "", """
WITH RECURSIVE l0 AS (SELECT s_suppkey AS asset_id, CAST(floor(s_suppkey / 4) AS BIGINT) AS issuer FROM supplier),
l AS (SELECT * FROM l0 UNION ALL SELECT asset_id, issuer + 2 FROM l0 WHERE asset_id % 40 = 13),
e0 AS (SELECT x.issuer AS a, y.issuer AS b FROM l x JOIN l y USING (asset_id) UNION SELECT x.issuer, y.issuer FROM l x JOIN l y ON y.asset_id = x.asset_id + 9 WHERE x.asset_id % 16 = 7 UNION SELECT issuer, issuer + 1 FROM l WHERE issuer % 5 = 0),
e AS (SELECT a, b FROM e0 UNION SELECT b, a FROM e0),
r AS (SELECT a AS issuer, a AS other FROM e UNION SELECT r.issuer, e.b FROM r JOIN e ON e.a = r.other),
m AS (SELECT issuer, MIN(other) AS merged FROM r GROUP BY 1)
SELECT issuer, asset_id, merged FROM l JOIN m USING (issuer)""")
def _(v):
    return merged(v)


@query("rsk07_merged_covariance", "specific")
def _(v):
    out = rk.merged_covariance(v.specific.select("asset_id", "mi", "sret"), merged(v), linked_cov(v), "asset_id", "issuer", "mi", "sret", END, 24.0)
    return _r(out, ["corr", "cov"])


@query("src22_specific_covariance_extract", "specific")
def _(v):
    return _r(ex.upper_triangle(linked_cov(v)["pairs"]).select("id1", "id2", "cov"), ["cov"])


_TR = """tr AS (SELECT e.asset_id, e.region, e.country, e.mcap, e.size * e.size * v_ss + 2 * e.size * e.momentum * v_sm + e.momentum * e.momentum * v_mm AS factor_var, s.svar AS spec_var FROM latest_exp e JOIN spec_risk s ON e.asset_id = s.asset_id, cov2)"""


@query("rsk08_total_risk", "latest_exp cov2 spec_risk", "WITH " + _TR + " SELECT asset_id, ROUND(factor_var, 6) AS factor_var, ROUND(spec_var, 6) AS spec_var, ROUND(sqrt(factor_var + spec_var), 6) AS total_risk FROM tr")
def _(v):
    return _r(rk.total_risk(v.latest_exp, v.cov_long, spec_table(v), XS), ["factor_var", "spec_var", "total_risk"])


_PR = """px AS (SELECT name, SUM(weight * e.size) AS xs, SUM(weight * e.momentum) AS xm, SUM(weight * weight * s.svar) AS specific_var FROM h JOIN latest_exp e USING (asset_id) LEFT JOIN spec_risk s USING (asset_id) GROUP BY 1),
pr AS (SELECT name, xs, xm, xs * xs * v_ss + 2 * xs * xm * v_sm + xm * xm * v_mm AS factor_var, COALESCE(specific_var, 0) AS specific_var FROM px, cov2)"""


@query("rsk09_portfolio_risk", "holdings cov2 spec_risk", "WITH h AS (SELECT name, asset_id, weight FROM holdings), " + _PR + """
SELECT name, ROUND(factor_var, 6) AS factor_var, ROUND(specific_var, 6) AS specific_var, ROUND(sqrt(factor_var + specific_var), 6) AS risk FROM pr""")
def _(v):
    x = latest(v)
    return _r(rk.portfolio_risk(v.holdings, x, v.cov_long, spec_table(v), XS), ["factor_var", "specific_var", "risk"])


@query("rsk09_tracking_error", "holdings cov2 spec_risk latest_exp", """WITH b AS (SELECT region, asset_id, mcap / SUM(mcap) OVER (PARTITION BY region) AS w FROM latest_exp), n AS (SELECT DISTINCT name, region FROM holdings),
h AS (SELECT name, asset_id, SUM(weight) AS weight FROM (SELECT name, asset_id, weight FROM holdings UNION ALL SELECT n.name, b.asset_id, -b.w FROM n JOIN b ON b.region = n.region) u GROUP BY 1, 2), """ + _PR + """
SELECT name, ROUND(factor_var, 6) AS factor_var, ROUND(specific_var, 6) AS specific_var, ROUND(sqrt(factor_var + specific_var), 6) AS risk FROM pr""")
def _(v):
    x = latest(v)
    tot = x.groupBy("region").agg(F.sum("mcap").alias("_t"))
    b = x.join(tot, "region").select("region", "asset_id", (F.col("mcap") / F.col("_t")).alias("weight"))
    # each country portfolio against its region: 25 names, regional members
    bm = v.holdings.select("name", "region").distinct().join(b, "region")
    return _r(rk.portfolio_risk(rk.active_weights(v.holdings, bm), x, v.cov_long, spec_table(v), XS), ["factor_var", "specific_var", "risk"])


@query("rsk09_portfolio_risk_with_links", "holdings cov2 specific")
def _(v):
    x = latest(v)
    lk = linked_cov(v)
    h = x.join(x.groupBy("region").agg(F.sum("mcap").alias("_t")), "region").select(F.col("region").alias("name"), "asset_id", (F.col("mcap") / F.col("_t")).alias("weight"))
    return _r(rk.portfolio_risk(h, x, v.cov_long, lk["variance"], XS, lk["pairs"]), ["factor_var", "specific_var", "risk"])


@query("rsk10_portfolio_correlation", "holdings cov2 spec_risk", "WITH h AS (SELECT name, asset_id, weight FROM holdings), " + _PR + """,
c AS (SELECT a.name AS f1, b.name AS f2, a.xs * b.xs * v_ss + (a.xs * b.xm + a.xm * b.xs) * v_sm + a.xm * b.xm * v_mm + CASE WHEN a.name = b.name THEN a.specific_var ELSE 0 END AS value FROM pr a, pr b, cov2)
SELECT CAST(c.f1 AS VARCHAR) AS f1, CAST(c.f2 AS VARCHAR) AS f2, ROUND(c.value, 6) AS value, ROUND(c.value / sqrt(a.value * b.value), 6) AS corr, ROUND(sqrt(a.value), 6) AS risk1 FROM c JOIN c a ON a.f1 = c.f1 AND a.f2 = c.f1 JOIN c b ON b.f1 = c.f2 AND b.f2 = c.f2""")
def _(v):
    return _r(rk.portfolio_corr(v.holdings, latest(v), v.cov_long, spec_table(v), XS), ["value", "corr", "risk1"])


@query("rsk11_marginal_contribution", "holdings cov2 spec_risk", "WITH h AS (SELECT name, asset_id, weight FROM holdings), " + _PR + """
SELECT h.name, h.asset_id, ROUND(h.weight, 6) AS weight, ROUND((e.size * (v_ss * xs + v_sm * xm) + e.momentum * (v_sm * xs + v_mm * xm)) / sqrt(factor_var + specific_var), 6) AS mctr FROM h JOIN pr USING (name) JOIN latest_exp e USING (asset_id), cov2""")
def _(v):
    return _r(rk.marginal_contribution(v.holdings, latest(v), v.cov_long, spec_table(v), XS), ["weight", "mctr"])


_BETA = """h AS (SELECT region AS name, asset_id, mcap / SUM(mcap) OVER (PARTITION BY region) AS weight FROM latest_exp), """ + _PR + """,
bt AS (SELECT e.region AS market, e.asset_id, e.size * (v_ss * xs + v_sm * xm) / (factor_var + specific_var) AS c_size, e.momentum * (v_sm * xs + v_mm * xm) / (factor_var + specific_var) AS c_momentum, COALESCE(h.weight * s.svar, 0) / (factor_var + specific_var) AS c_specific
 FROM latest_exp e JOIN pr ON pr.name = e.region JOIN h ON h.asset_id = e.asset_id LEFT JOIN spec_risk s ON s.asset_id = e.asset_id, cov2)"""


def _market(v, x):
    t = x.groupBy("region").agg(F.sum("mcap").alias("_t"))
    return x.join(t, "region").select(F.col("region").alias("market"), "asset_id", (F.col("mcap") / F.col("_t")).alias("weight"))


@query("rsk12_predicted_beta", "latest_exp cov2 spec_risk", "WITH " + _BETA + " SELECT market, asset_id, ROUND(c_size + c_momentum + c_specific, 6) AS beta FROM bt")
def _(v):
    x = latest(v)
    return _r(rk.predicted_beta(x.withColumn("market", F.col("region")), v.cov_long, spec_table(v), _market(v, x), XS), ["beta"])


@query("rsk13_beta_decomposition", "latest_exp cov2 spec_risk", "WITH " + _BETA + """
SELECT market, asset_id, part, ROUND(contribution, 6) AS contribution FROM (SELECT market, asset_id, 'size' AS part, c_size AS contribution FROM bt UNION ALL SELECT market, asset_id, 'momentum', c_momentum FROM bt UNION ALL SELECT market, asset_id, 'specific', c_specific FROM bt) u""")
def _(v):
    x = latest(v)
    return _r(rk.beta_decomposition(x.withColumn("market", F.col("region")), v.cov_long, spec_table(v), _market(v, x), XS), ["contribution"])


@query("rsk14_risk_series", "exposures cov2 spec_risk", """
WITH w AS (SELECT dt, region AS name, asset_id, size, momentum, mcap / SUM(mcap) OVER (PARTITION BY dt, region) AS w FROM exposures),
p AS (SELECT dt, name, SUM(w * size) AS xs, SUM(w * momentum) AS xm, SUM(w * w * svar) AS sv FROM w LEFT JOIN spec_risk USING (asset_id) GROUP BY 1, 2)
SELECT dt, name, ROUND(sqrt(xs * xs * v_ss + 2 * xs * xm * v_sm + xm * xm * v_mm + COALESCE(sv, 0)), 6) AS risk FROM p, cov2""")
def _(v):
    x = stored(v.exposures.select("asset_id", "dt", "region", "mcap", *XS))
    t = x.groupBy("dt", "region").agg(F.sum("mcap").alias("_t"))
    w = x.join(t, ["dt", "region"]).select("dt", F.col("region").alias("name"), "asset_id", (F.col("mcap") / F.col("_t")).alias("weight"))
    dates = x.select("dt").distinct()
    cov = dates.withColumn("_one", F.lit(1)).join(v.cov_long.withColumn("_one", F.lit(1)), "_one").drop("_one")
    spec = x.select("dt", "asset_id").join(spec_table(v), "asset_id")
    return _r(rk.risk_series(w, x, cov, spec, XS), ["risk"])


@query("rsk15_linked_model", "cov2 factor_ret", """
SELECT 'a-' || f1 AS f1, 'a-' || f2 AS f2, value FROM c UNION ALL SELECT 'b-' || f1, 'b-' || f2, value * 2 FROM c UNION ALL SELECT 'a-size', 'b-size', 0.001::DOUBLE UNION ALL SELECT 'b-size', 'a-size', 0.001::DOUBLE""".replace(
    "FROM c", "FROM (SELECT 'size' AS f1, 'size' AS f2, ROUND(v_ss, 6) AS value FROM cov2 UNION ALL SELECT 'size', 'momentum', ROUND(v_sm, 6) FROM cov2 UNION ALL SELECT 'momentum', 'size', ROUND(v_sm, 6) FROM cov2 UNION ALL SELECT 'momentum', 'momentum', ROUND(v_mm, 6) FROM cov2) c"))
def _(v):
    c = _r(v.cov_long, ["value"])
    link = v.spark.createDataFrame([("a-size", "b-size", 0.001)], "f1 string, f2 string, value double")
    return rk.stack_cov({"a": c, "b": c.withColumn("value", F.col("value") * 2)}, link)


@query("rsk15_linked_specific", "spec_risk", "SELECT asset_id, CASE WHEN asset_id % 2 = 0 THEN 'a' ELSE 'b' END AS model, ROUND(CASE WHEN asset_id % 2 = 0 THEN svar ELSE svar * 2 END, 6) AS spec_var FROM spec_risk")
def _(v):
    s = spec_table(v)
    asg = v.supplier.select(F.col("s_suppkey").alias("asset_id"), F.when(F.col("s_suppkey") % 2 == 0, "a").otherwise("b").alias("model"))
    return _r(rk.linked_specific(asg, {"a": s, "b": s.withColumn("spec_var", F.col("spec_var") * 2)}), ["spec_var"])


@query("rsk16_curve_covariance", "items")
def _(v):
    # node factor returns: mean change of each node's level-log value over curves
    c = v.items.select(F.col("asset_id").alias("curve"), F.col("item").alias("node"), "dt", "qi", (F.col("value") / 1e6).alias("value"))
    r = ts.curve_returns(c, "log", a=0.2)
    node = r.groupBy("node", "qi").agg(F.avg("ret").alias("value"))
    return _r(rk.factor_cov(node, "node", "value", "qi", 8.0, 8.0, annual=4.0), ["value"], 9)


@query("src29_curve_varcovar", "items")
def _(v):
    c = v.items.select(F.col("asset_id").alias("curve"), F.col("item").alias("node"), "dt", "qi", (F.col("value") / 1e6).alias("value"))
    node = ts.curve_returns(c, "log", a=0.2).groupBy("node", "qi").agg(F.avg("ret").alias("value"))
    cov = rk.factor_cov(node, "node", "value", "qi", 8.0, 8.0, annual=4.0)
    return ex.square(_r(cov, ["value"], 9), ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


@query("rsk17_universal_covariance", "factor_ret market items")
def _(v):
    m = v.market.select(F.concat(F.lit("eq-r"), F.col("region")).alias("factor"), "mi", F.col("mret").alias("value"))
    f = factor_long(v).select(F.concat(F.lit("eq-"), F.col("f")).alias("factor"), "mi", F.col("v").alias("value"))
    com = v.sparse.where("ret is not null").groupBy(F.concat(F.lit("com-"), F.col("asset_type")).alias("factor"), "mi").agg(F.avg("ret").alias("value"))
    u = stored(m.unionByName(f).unionByName(com).where((F.col("mi") > END - 60) & (F.col("mi") <= END)))
    return _r(rk.factor_cov(u, step="mi", corr_half_life=36.0, var_half_life=18.0, annual=12.0), ["value"])


@query("rsk18_currency_block", "panel")
def _(v):
    fx = stored(ts.fx_returns(fx_rates(v), rf_rates(v).drop("mi"), 0).select("ccy", "dt", "ret").where("ccy <> 0 and ret is not null"))
    model = fa.currency_model(fx, "ccy", "dt", "ret", 2)
    return _r(rk.currency_block(fx, stored(model["exposures"]), "ccy", "dt", "ret", ["f1", "f2"], annual=12.0)["covariance"], ["value"])


@query("rsk19_parameters", "panel")
def _(v):
    # parameters with the history each model's market has in the panel
    have = v.panel.select(F.concat(F.lit("region-"), F.col("region")).alias("model"), "mi").distinct().groupBy("model").agg(F.count("*").alias("n_periods"))
    return rk.parameters(v.spark, [f"region-{i}" for i in range(5)]).join(have, "model")


@query("src21_asset_risk", "latest_exp cov2 spec_risk", "WITH " + _BETA + ", " + _TR + """
SELECT tr.asset_id, ROUND(sqrt(tr.spec_var), 6) AS spec_risk, ROUND(sqrt(factor_var + spec_var), 6) AS total_risk, ROUND(c_size + c_momentum + c_specific, 6) AS beta, ROUND(h.weight, 6) AS weight FROM tr JOIN bt USING (asset_id) JOIN h USING (asset_id)""")
def _(v):
    x = latest(v)
    spec = stored(spec_table(v))
    mk = _market(v, x)
    tr = rk.total_risk(x, v.cov_long, spec, XS)
    b = rk.predicted_beta(x.withColumn("market", F.col("region")), v.cov_long, spec, mk, XS)
    out = tr.join(b.drop("market"), "asset_id").join(mk.select("asset_id", "weight"), "asset_id")
    return _r(out.select("asset_id", F.sqrt("spec_var").alias("spec_risk"), "total_risk", "beta", "weight"), ["spec_risk", "total_risk", "beta", "weight"])


@query("src27_regression_statistics", "exposures", """
WITH f AS (SELECT dt, COUNT(*) AS n, SUM(root_cap * size * ret) / SUM(root_cap * size * size) AS b, SUM(root_cap * size * ret) AS xy, SUM(root_cap * ret * ret) AS yy FROM exposures GROUP BY dt)
SELECT dt, n, ROUND(b, 6) AS coef, ROUND(b * xy / yy, 6) AS r2 FROM f""")
def _(v):
    s = rg.reg_stats(v.exposures, ["dt"], ["size"], "ret", "root_cap", intercept=False, with_p=False)
    return _r(s.select("dt", "n", "coef", "r2"), ["coef", "r2"])


@query("src27_betas", "panel market", f"""
SELECT p.asset_id, p.country, ROUND(regr_slope(p.ret, m.mret), 6) AS beta, COUNT(*) AS n FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi WHERE p.ret IS NOT NULL AND p.mi > {END} - 60 AND p.mi <= {END} GROUP BY 1, 2""")
def _(v):
    x = v.panel.where((F.col("mi") > END - 60) & (F.col("mi") <= END) & F.col("ret").isNotNull()).join(v.market.select("region", "mi", "mret"), ["region", "mi"])
    return _r(x.groupBy("asset_id", "country").agg(F.regr_slope("ret", "mret").alias("beta"), F.count("*").alias("n")), ["beta"])


@query("src27_total_risk", "latest_exp cov2 spec_risk", "WITH " + _TR + " SELECT country, COUNT(*) AS n, ROUND(AVG(sqrt(factor_var + spec_var)), 6) AS total_risk FROM tr GROUP BY 1")
def _(v):
    tr = rk.total_risk(v.latest_exp, v.cov_long, spec_table(v), XS).join(v.latest_exp.select("asset_id", "country"), "asset_id")
    return _r(tr.groupBy("country").agg(F.count("*").alias("n"), F.avg("total_risk").alias("total_risk")), ["total_risk"])
