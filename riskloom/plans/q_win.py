"""Windows, lags and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import timeseries as ts
from riskloom.plans.q_base import FX_SQL, fx_rates, rf_rates
from riskloom.plans.registry import query

END = 12 * 2000 + 12  # December 2000


def _r(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


@query("win01_latest", "panel", "SELECT asset_id, arg_max(ret, dt) AS ret, MAX(dt) AS dt FROM panel WHERE ret IS NOT NULL GROUP BY 1")
def _(v):
    return ts.latest(v.panel, ["asset_id"], "ret")


_DAYS = """d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem WHERE l_quantity > 49)"""


def _days(v):
    return v.lineitem.where("l_quantity > 49").select(F.col("l_shipdate").cast("date").alias("dt")).distinct()


for _f, _cond in {
    "weekly": "isodow(n) < isodow(dt)",
    "monthly": "date_trunc('month', n) <> date_trunc('month', dt)",
    "rolling": "isodow(dt) = (SELECT isodow(MAX(dt)) FROM d)",
}.items():
    query(f"win02_period_ends_{_f}", "", f"WITH {_DAYS}, l AS (SELECT dt, LEAD(dt) OVER (ORDER BY dt) AS n FROM d) SELECT dt FROM l WHERE {_cond}")(
        lambda v, f=_f: ts.period_ends(_days(v), f)
    )


@query("win03_period_dates_monthly", "", f"WITH {_DAYS}, g AS (SELECT CAST(unnest(generate_series(MIN(dt), MAX(dt), INTERVAL 1 DAY)) AS DATE) AS dt FROM d) SELECT dt FROM g WHERE last_day(dt) = dt")
def _(v):
    return ts.period_dates(_days(v), "monthly")


@query("win03_period_dates_weekly", "", f"WITH {_DAYS}, g AS (SELECT CAST(unnest(generate_series(MIN(dt), MAX(dt), INTERVAL 1 DAY)) AS DATE) AS dt FROM d) SELECT dt FROM g WHERE isodow(dt) = 5")
def _(v):
    return ts.period_dates(_days(v), "weekly")


_Q = "CAST(date_trunc('quarter', dt) + INTERVAL 2 MONTH AS DATE)"


@query("win04_compound", "panel", f"""
SELECT asset_id, {_Q} AS period, ROUND(product(1 + ret) - 1, 6) AS ret FROM panel WHERE {_Q} <= (SELECT MAX(dt) FROM panel) GROUP BY 1, 2""")
def _(v):
    ends = v.panel.where(F.month("dt") % 3 == 0).select("dt")
    return _r(ts.compound(v.panel, ends, ["asset_id"], "ret"), ["ret"])


@query("win04_compound_volume", "panel", f"SELECT asset_id, {_Q} AS period, SUM(volume) AS volume FROM panel WHERE {_Q} <= (SELECT MAX(dt) FROM panel) GROUP BY 1, 2")
def _(v):
    ends = v.panel.where(F.month("dt") % 3 == 0).select("dt")
    return ts.compound(v.panel, ends, ["asset_id"], "volume", mode="sum")


@query("win05_cumulative", "panel", "SELECT asset_id, dt, ROUND(product(1 + COALESCE(ret, 0)) OVER (PARTITION BY asset_id ORDER BY dt), 6) AS cum FROM panel")
def _(v):
    return _r(ts.cumulative(v.panel.select("asset_id", "dt", "ret"), ["asset_id"], "ret"), ["cum"]).select("asset_id", "dt", "cum")


@query("win06_cumulative_risk_free", "panel", "WITH " + FX_SQL + """,
g AS (SELECT ccy, dt, rf, COALESCE(date_diff('day', LAG(dt) OVER (PARTITION BY ccy ORDER BY dt), dt), 0) AS n FROM rf)
SELECT ccy, dt, ROUND(rf, 6) AS rf, ROUND(product(pow(1 + rf, n / 365.0::DOUBLE)) OVER (PARTITION BY ccy ORDER BY dt), 6) AS cum_rf FROM g""")
def _(v):
    return _r(ts.cumulative_risk_free(rf_rates(v)), ["rf", "cum_rf"]).select("ccy", "dt", "rf", "cum_rf")


@query("win07_total_return", "sparse", """
WITH x AS (SELECT asset_id, mi, price, 1 + (mi % 12) / 100.0::DOUBLE AS fx, CASE WHEN (asset_id + mi) % 9 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS split, CASE WHEN mi % 6 = 0 THEN price * 0.01::DOUBLE ELSE 0.0::DOUBLE END AS dividend FROM sparse),
c AS (SELECT *, product(split) OVER w AS cs, SUM(dividend) OVER w AS cd FROM x WINDOW w AS (PARTITION BY asset_id ORDER BY mi)),
p AS (SELECT *, LAG(mi) OVER w AS pm, LAG(price) OVER w AS pp, LAG(fx) OVER w AS pf, LAG(cs) OVER w AS pcs, LAG(cd) OVER w AS pcd FROM c WINDOW w AS (PARTITION BY asset_id ORDER BY mi))
SELECT asset_id, mi, ROUND(CASE WHEN mi - pm <= 5 THEN (price * (cs / pcs) + (cd - pcd)) * fx / (pp * pf) - 1 END, 6) AS ret FROM p""")
def _(v):
    x = v.sparse.select(
        "asset_id", "mi", "price", (1 + (F.col("mi") % 12) / 100.0).alias("fx"), F.when((F.col("asset_id") + F.col("mi")) % 9 == 0, 2.0).otherwise(1.0).alias("split"),
        F.when(F.col("mi") % 6 == 0, F.col("price") * 0.01).otherwise(0.0).alias("dividend"),
    )
    return _r(ts.total_return(x, step="mi").select("asset_id", "mi", "ret"), ["ret"])


@query("win08_cash_return", "panel", "WITH " + FX_SQL + """
SELECT ccy, dt, ROUND(LAG(rf) OVER w / 360.0::DOUBLE * date_diff('day', LAG(dt) OVER w, dt), 9) AS cash_ret FROM rf WINDOW w AS (PARTITION BY ccy ORDER BY dt)""")
def _(v):
    return _r(ts.cash_return(rf_rates(v), rate="rf").select("ccy", "dt", "cash_ret"), ["cash_ret"], 9)


@query("win09_excess", "panel validity", "WITH " + FX_SQL + """
SELECT p.asset_id, p.dt, c.ccy, ROUND(p.ret - COALESCE(r.rf, 0), 6) AS excess FROM panel p
JOIN (SELECT id, CAST(value AS BIGINT) % 25 AS ccy, from_dt, thru_dt FROM (SELECT id, floor(value) AS value, from_dt, thru_dt FROM validity) q) c ON c.id = p.asset_id AND c.from_dt <= p.dt AND p.dt < c.thru_dt
LEFT JOIN rf r ON r.ccy = c.ccy AND r.dt = p.dt""")
def _(v):
    c = v.validity.select(F.col("id").alias("asset_id"), (F.floor("value") % 25).alias("ccy"), "from_dt", "thru_dt")
    rf = rf_rates(v).withColumn("ccy", F.col("ccy").cast("long"))
    return _r(ts.excess(v.panel.select("asset_id", "dt", "ret"), c, rf).select("asset_id", "dt", "ccy", "excess"), ["excess"])


@query("win10_fx_returns", "panel", "WITH " + FX_SQL + """
SELECT r.ccy, r.dt, ROUND(r.rate / LAG(r.rate) OVER (PARTITION BY r.ccy ORDER BY r.dt) - 1 + COALESCE(a.rf, 0) - COALESCE(n.rf, 0), 6) AS ret
FROM rates r LEFT JOIN rf a ON a.ccy = r.ccy AND a.dt = r.dt LEFT JOIN rf n ON n.ccy = 0 AND n.dt = r.dt""")
def _(v):
    return _r(ts.fx_returns(fx_rates(v), rf_rates(v).drop("mi"), 0).select("ccy", "dt", "ret"), ["ret"])


@query("win11_overlap", "panel", """
SELECT asset_id, dt, ROUND(CASE WHEN COUNT(ret) OVER w = 4 THEN product(1 + ret) OVER w - 1 END, 6) AS r4 FROM panel WINDOW w AS (PARTITION BY asset_id ORDER BY dt ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def _(v):
    return _r(ts.overlap(v.panel, ["asset_id"], "ret", 4, "r4").select("asset_id", "dt", "r4"), ["r4"])


@query("win12_volatility_adjustment", "factor_ret")
def _(v):
    long = v.factor_ret.unpivot(["dt"], ["f_size", "f_mom"], "factor", "value")
    return _r(ts.dva(long, "factor", "value", 20), ["scale", "value"])


_KIND = """k AS (SELECT p.asset_id, p.dt, p.mi, p.region AS market, p.volume, CASE WHEN p.volume <= 60 THEN NULL ELSE p.ret END AS ret,
 CASE WHEN f.d IS NOT NULL AND p.dt < f.d THEN 'pre_ipo' WHEN month(p.dt) = 12 AND p.region = 1 THEN 'non_trading' WHEN p.volume <= 60 OR p.ret IS NULL THEN 'illiquid' WHEN p.ret = 0 THEN 'zero' ELSE 'live' END AS kind
FROM panel p LEFT JOIN (SELECT asset_id, MIN(dt) AS d FROM panel WHERE volume > 200 GROUP BY 1) f ON p.asset_id = f.asset_id)"""


def _kinds(v):
    first = v.panel.where("volume > 200").groupBy("asset_id").agg(F.min("dt").alias("from_dt"))
    cal = v.panel.select(F.col("region").alias("market"), "dt").distinct().where("not (month(dt) = 12 and market = 1)")
    # thinly traded months read as zero returns without volume
    p = v.panel.select("asset_id", "dt", "mi", F.col("region").alias("market"), F.when(F.col("volume") <= 60, 0.0).otherwise(F.col("volume")).alias("volume"), F.when(F.col("volume") <= 60, 0.0).otherwise(F.col("ret")).alias("ret"))
    return ts.classify_missing(p, first, cal)


@query("win13_classify_missing", "panel", "WITH " + _KIND + " SELECT asset_id, dt, ROUND(ret, 6) AS ret, kind FROM k")
def _(v):
    return _r(_kinds(v).select("asset_id", "dt", "ret", "kind"), ["ret"])


@query("win14_carry_fx", "panel", """
WITH x AS (SELECT asset_id, mi, CASE WHEN (asset_id + mi) % 3 = 0 THEN ret END AS ret, ret / 10 AS fx FROM panel),
g AS (SELECT *, COUNT(ret) OVER (PARTITION BY asset_id ORDER BY mi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM x)
SELECT asset_id, mi, ROUND(CASE WHEN ret IS NOT NULL THEN (1 + ret) * product(1 + COALESCE(fx, 0)) OVER (PARTITION BY asset_id, g ORDER BY mi) - 1 END, 6) AS ret FROM g""")
def _(v):
    x = v.panel.select("asset_id", "mi", F.when((F.col("asset_id") + F.col("mi")) % 3 == 0, F.col("ret")).alias("ret"), (F.col("ret") / 10).alias("fx"))
    return _r(ts.carry_fx(x, "asset_id", "ret", "fx", "mi").select("asset_id", "mi", "ret"), ["ret"])


_FILL = """x AS (SELECT p.asset_id, p.mi, CASE WHEN (p.asset_id + p.mi) % 4 < 2 THEN p.ret END AS ret, m.mret AS proxy FROM panel p LEFT JOIN market m ON p.region = m.region AND p.mi = m.mi),
g AS (SELECT *, COUNT(ret) OVER (PARTITION BY asset_id ORDER BY mi) AS g FROM x),
c AS (SELECT *, product(CASE WHEN ret IS NULL AND proxy IS NOT NULL THEN 1 + proxy ELSE 1 END) OVER (PARTITION BY asset_id, g ORDER BY mi) AS c FROM g),
b AS (SELECT *, CASE WHEN LAG(ret) OVER w IS NULL THEN COALESCE(LAG(c) OVER w, 1) ELSE 1 END AS back FROM c WINDOW w AS (PARTITION BY asset_id ORDER BY mi))"""


@query("win15_fill_smooth", "panel market", "WITH " + _FILL + " SELECT asset_id, mi, ROUND(CASE WHEN ret IS NOT NULL THEN (1 + ret) / back - 1 ELSE proxy END, 6) AS filled FROM b")
def _(v):
    x = v.panel.join(v.market.select("region", "mi", F.col("mret").alias("proxy")), ["region", "mi"], "left")
    x = x.select("asset_id", "mi", F.when((F.col("asset_id") + F.col("mi")) % 4 < 2, F.col("ret")).alias("ret"), "proxy")
    return _r(ts.fill_smooth(x, "asset_id", "ret", "proxy", "mi").select("asset_id", "mi", "filled"), ["filled"])


_BETA = "beta AS (SELECT p.asset_id, regr_slope(p.ret, m.mret) AS beta FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi WHERE p.asset_id % 5 <> 0 GROUP BY 1)"


def _beta(v):
    j = v.panel.where("asset_id % 5 <> 0").join(v.market.select("region", "mi", "mret"), ["region", "mi"])
    return j.groupBy("asset_id").agg(F.regr_slope("ret", "mret").alias("beta"))


@query("win16_proxy_returns", "panel market", "WITH " + _BETA + """
SELECT p.asset_id, p.dt, ROUND(COALESCE(b.beta, 1) * m.mret, 6) AS proxy FROM panel p LEFT JOIN beta b ON p.asset_id = b.asset_id LEFT JOIN market m ON p.region = m.region AND p.dt = m.dt""")
def _(v):
    mkt = v.market.withColumnRenamed("region", "market")
    out = ts.proxy_returns(v.panel.withColumnRenamed("region", "market"), _beta(v), mkt)
    return _r(out.select("asset_id", "dt", "proxy"), ["proxy"])


def _timing(v):
    gmt = v.region.select(F.col("r_regionkey").alias("market"), (F.col("r_regionkey") * 3.0).alias("offset"))
    return ts.timing_adjust(v.market.withColumnRenamed("region", "market"), gmt, step="mi")


@query("win17_timing_adjustment", "market")
def _(v):
    return _r(_timing(v), ["adjustment"])


_TADJ = "adj AS (SELECT region AS market, mi, mret / 10 AS a FROM market)"


@query("win18_apply_timing", "panel market", "WITH " + _TADJ + """
SELECT p.asset_id, p.mi, ROUND(p.ret + COALESCE(a.a, 0) + CASE WHEN p.region <> (p.country % 5) THEN COALESCE(b.a, 0) ELSE 0 END, 6) AS ret FROM panel p
LEFT JOIN adj a ON a.market = p.region AND a.mi = p.mi LEFT JOIN adj b ON b.market = p.country % 5 AND b.mi = p.mi""")
def _(v):
    adj = v.market.select(F.col("region").alias("market"), "mi", (F.col("mret") / 10).alias("adjustment"))
    x = v.panel.select("asset_id", "mi", "ret", F.col("region").alias("trading"), (F.col("country") % 5).alias("home"))
    return _r(ts.apply_timing(x, adj, "trading", "home", "mi").select("asset_id", "mi", "ret"), ["ret"])


@query("win19_momentum", "panel", """
SELECT asset_id, dt, ROUND(COALESCE(product(1 + COALESCE(ret, 0)) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING), 1) - 1, 6) AS momentum FROM panel""")
def _(v):
    return _r(ts.momentum(v.panel, "asset_id", "ret", 13, 1, "mi").select("asset_id", "dt", "momentum"), ["momentum"])


@query("win19_momentum_log", "panel", """
SELECT asset_id, dt, ROUND(SUM(ln(1 + COALESCE(ret, 0))) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS momentum FROM panel""")
def _(v):
    return _r(ts.momentum(v.panel, "asset_id", "ret", 6, 0, "mi", log_form=True).select("asset_id", "dt", "momentum"), ["momentum"])


@query("win19_momentum_weighted", "panel", f"""
WITH w AS (SELECT asset_id, pow(2.0::DOUBLE, -({END} - mi) / 6.0::DOUBLE) AS w, COALESCE(ret, 0) AS r FROM panel WHERE mi > {END} - 12 AND mi <= {END}),
t AS (SELECT SUM(pow(2.0::DOUBLE, -i / 6.0::DOUBLE)) AS t FROM range(12) r(i))
SELECT asset_id, ROUND(product(pow(1 + r, w / t)) - 1, 6) AS momentum FROM w, t GROUP BY 1""")
def _(v):
    return _r(ts.momentum_weighted(v.panel, "asset_id", "ret", END, 12, lambda pos, age: ts.exp_weight(age, 6), "mi"), ["momentum"])


@query("win20_historic_volatility", "panel", """
SELECT asset_id, dt, ROUND(sqrt(SUM(COALESCE(ret * ret, 0)) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) / 12), 6) AS hist_vol FROM panel""")
def _(v):
    return _r(ts.hist_vol(v.panel, "asset_id", "ret", 12, "mi").select("asset_id", "dt", "hist_vol"), ["hist_vol"])


@query("win20_skewness", "panel", """
WITH m AS (SELECT asset_id, dt, COUNT(*) OVER w AS n, AVG(r) OVER w AS m1, AVG(r * r) OVER w AS m2, AVG(r * r * r) OVER w AS m3 FROM (SELECT *, COALESCE(ret, 0) AS r FROM panel) p WINDOW w AS (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 23 PRECEDING AND CURRENT ROW))
SELECT asset_id, dt, ROUND((m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1) / pow(m2 - m1 * m1, 1.5), 4) AS skew FROM m WHERE n >= 20""")
def _(v):
    x = ts.skew(v.panel, "asset_id", "ret", 24, "mi").withColumn("_n", F.count("*").over(ts.last_steps(["asset_id"], "mi", 24)))
    return _r(x.where("_n >= 20").select("asset_id", "dt", "skew"), ["skew"], 4)


@query("win21_pace_volatility", "panel", f"""
WITH c AS (SELECT mi, stddev_samp(ret) AS csv FROM panel WHERE mi > {END} - 24 AND mi <= {END} GROUP BY mi)
SELECT p.asset_id, ROUND(sqrt(SUM(abs(COALESCE(p.ret, 0)) / c.csv) / 24), 6) AS pace_vol FROM panel p JOIN c ON p.mi = c.mi GROUP BY 1""")
def _(v):
    csv = ts.cross_section_vol(v.panel, "ret", [], "mi")
    return _r(ts.pace_vol(v.panel, csv, "asset_id", END, 24, "mi"), ["pace_vol"])


@query("win22_relative_strength", "panel", f"""
WITH h AS (SELECT -ln(2.0::DOUBLE) / ln(1 - 2.0::DOUBLE / 11) AS h), t AS (SELECT SUM(pow(2.0::DOUBLE, -i / h)) AS t FROM range(24) r(i), h),
x AS (SELECT asset_id, COALESCE(ret, 0) AS r, pow(2.0::DOUBLE, -({END} - mi) / h) / t AS w FROM panel, h, t WHERE mi > {END} - 24 AND mi <= {END})
SELECT asset_id, ROUND(CASE WHEN SUM(CASE WHEN r < 0 THEN r ELSE 0 END) = 0 THEN 1 ELSE 1 - 1 / (1 + product(1 + CASE WHEN r > 0 THEN r * w ELSE 0 END) / product(1 + CASE WHEN r < 0 THEN r * w ELSE 0 END)) END, 6) AS rsi FROM x GROUP BY 1""")
def _(v):
    return _r(ts.relative_strength(v.panel, "asset_id", END, 24, 10, "mi"), ["rsi"])


@query("win23_variance_ratio", "panel", """
WITH x AS (SELECT asset_id, mi, COALESCE(ret, 0) AS r, ROW_NUMBER() OVER (PARTITION BY asset_id ORDER BY mi DESC) AS rn FROM panel),
q AS (SELECT asset_id, r, CASE WHEN COUNT(*) OVER w = 6 THEN product(1 + r) OVER w - 1 END AS q FROM x WHERE rn <= 60 WINDOW w AS (PARTITION BY asset_id ORDER BY mi ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
SELECT asset_id, ROUND(var_samp(q) * (54.0::DOUBLE / (55 * (1 - 5 / 59.0::DOUBLE))) / (5 * var_samp(r) * (59.0::DOUBLE / 58)) - 1, 6) AS variance_ratio FROM q GROUP BY 1 HAVING COUNT(*) = 60""")
def _(v):
    return _r(ts.variance_ratio(v.panel, "asset_id", "ret", 60, 5, "mi"), ["variance_ratio"])


@query("win24_high_low", "panel", """
SELECT asset_id, dt, ROUND(ln(MAX(mcap) OVER w / MIN(mcap) OVER w), 6) AS high_low FROM panel WINDOW w AS (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def _(v):
    return _r(ts.high_low(v.panel, "asset_id", "mcap", 6, "mi").select("asset_id", "dt", "high_low"), ["high_low"])


@query("win25_turnover", "panel", """
SELECT asset_id, dt, ROUND(ln(AVG(volume) OVER w + 1) - ln(mcap), 6) AS turnover FROM panel WINDOW w AS (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def _(v):
    return _r(ts.turnover(v.panel, "asset_id", "volume", "mcap", 12, "mi", "log").select("asset_id", "dt", "turnover"), ["turnover"])


@query("win25_turnover_median", "panel", """
SELECT asset_id, dt, ROUND(median(volume) OVER w / mcap, 9) AS turnover FROM panel WINDOW w AS (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def _(v):
    return _r(ts.turnover(v.panel, "asset_id", "volume", "mcap", 6, "mi", "ratio", True).select("asset_id", "dt", "turnover"), ["turnover"], 9)


@query("win26_amihud", "panel", """
SELECT asset_id, dt, ROUND(1 / (AVG(abs(ret) / volume) OVER w * mcap), 6) AS amihud FROM panel WINDOW w AS (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def _(v):
    return _r(ts.amihud(v.panel, "asset_id", "ret", "volume", "mcap", 12, "mi").select("asset_id", "dt", "amihud"), ["amihud"])


@query("win27_volume_beta", "panel", """
WITH c AS (SELECT asset_id, mi, volume / LAG(volume) OVER (PARTITION BY asset_id ORDER BY mi) - 1 AS c FROM panel), m AS (SELECT mi, AVG(COALESCE(c, 0)) AS m FROM c GROUP BY mi)
SELECT asset_id, ROUND(regr_slope(c, m), 6) AS volume_beta FROM c JOIN m USING (mi) WHERE c IS NOT NULL GROUP BY 1""")
def _(v):
    return _r(ts.volume_beta(v.panel, "asset_id", "volume", "mi"), ["volume_beta"])


@query("win28_return_scores", "panel", "WITH " + _KIND + f""",
s AS (SELECT asset_id, 36 - SUM(CASE WHEN kind IN ('pre_ipo', 'non_trading') THEN 1 ELSE 0 END)::BIGINT AS valid, SUM(CASE WHEN kind = 'illiquid' THEN 1 ELSE 0 END) AS i, SUM(CASE WHEN kind = 'zero' THEN 1 ELSE 0 END) AS z
 FROM k WHERE mi > {END} - 36 AND mi <= {END} GROUP BY 1)
SELECT asset_id, valid, ROUND(CASE WHEN valid < 20 THEN 0 ELSE (valid - i)::DOUBLE / valid END, 6) AS non_missing, ROUND(CASE WHEN valid < 20 THEN 0 ELSE (valid - z)::DOUBLE / valid END, 6) AS non_zero FROM s""")
def _(v):
    return _r(ts.return_scores(_kinds(v), "asset_id", END, 36, 20, "mi"), ["non_missing", "non_zero"])


@query("win29_prop_non_missing", "sparse", """
SELECT asset_id, dt, ROUND(COUNT(ret) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) / 12.0::DOUBLE, 6) AS prop FROM sparse""")
def _(v):
    return _r(ts.prop_non_missing(v.sparse, "asset_id", "ret", 12, "mi").select("asset_id", "dt", "prop"), ["prop"])


@query("win30_grandfather", "panel", """
WITH q AS (SELECT asset_id, mi, mcap > 200000 AS qualified, SUM(CASE WHEN mcap > 200000 THEN 1 ELSE 0 END) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)::BIGINT AS n FROM panel),
t AS (SELECT mi, MAX(n) AS top FROM q GROUP BY mi)
SELECT asset_id, q.mi, qualified, n AS n_qualified, qualified OR n >= LEAST(10, GREATEST(top - 1, 1)) AS member FROM q JOIN t ON q.mi = t.mi""")
def _(v):
    q = v.panel.select("asset_id", "mi", (F.col("mcap") > 200000).alias("qualified"))
    return ts.grandfather(q, "asset_id", 10, 12, "mi").select("asset_id", "mi", "qualified", "n_qualified", "member")


@query("win31_roll_over", "sparse", """
WITH l AS (SELECT asset_id, MIN(mi) AS a, MAX(mi) AS b FROM sparse GROUP BY 1), g AS (SELECT asset_id, unnest(range(a, b + 1)) AS mi FROM l)
SELECT g.asset_id, g.mi, last_value(s.price IGNORE NULLS) OVER (PARTITION BY g.asset_id ORDER BY g.mi RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) AS price FROM g LEFT JOIN sparse s ON s.asset_id = g.asset_id AND s.mi = g.mi""")
def _(v):
    d = ts.densify(v.sparse.select("asset_id", "mi", "price"), "asset_id", "mi")
    return ts.roll_over(d, "asset_id", "price", 3, "mi")


@query("win32_asof_constituents", "portfolio", """
WITH p AS (SELECT name, asset_id, dt, weight FROM portfolio WHERE (name <> 'Brand#3' OR dt < DATE '1998-01-01') AND dt <= DATE '1998-03-15' AND date_diff('day', dt, DATE '1998-03-15') <= 60),
l AS (SELECT name, MAX(dt) AS dt FROM p GROUP BY 1) SELECT p.name, p.asset_id, p.dt, ROUND(p.weight, 9) AS weight FROM p JOIN l ON p.name = l.name AND p.dt = l.dt""")
def _(v):
    m = v.portfolio.where("name <> 'Brand#3' or dt < '1998-01-01'").select("name", "asset_id", "dt", F.round("weight", 9).alias("weight"))
    return ts.asof_constituents(m, "name", "1998-03-15", 60).select("name", "asset_id", "dt", "weight")


_UNITS = {
    "chg": "x - p", "ch1": "x - y", "pch": "(x / p - 1) * 100", "pc1": "(x / y - 1) * 100", "pca": "(pow(x / p, 12) - 1) * 100",
    "cch": "ln(x / p) * 100", "cca": "ln(x / p) * 100 * 12", "log": "ln(x)",
}


@query("win33_unit_transforms", "market", """
WITH s AS (SELECT region, dt, mi, product(1 + mret) OVER (PARTITION BY region ORDER BY dt) AS x FROM market), l AS (SELECT *, LAG(x) OVER w AS p, LAG(x, 12) OVER w AS y FROM s WINDOW w AS (PARTITION BY region ORDER BY dt))
SELECT region, dt, """ + ", ".join(f"ROUND({e}, 4) AS {n}" for n, e in _UNITS.items() if n != "pca") + " FROM l")
def _(v):
    x = ts.cumulative(v.market, ["region"], "mret", "x")
    for n in _UNITS:
        if n != "pca":
            x = ts.units(x, ["region"], "x", n, 12)
    return _r(x.select("region", "dt", *[n for n in _UNITS if n != "pca"]), [n for n in _UNITS if n != "pca"], 4)


@query("win34_stationary_yoy", "market", """
WITH r AS (SELECT region, dt, mret * 10 AS x, ROW_NUMBER() OVER (PARTITION BY region ORDER BY dt) AS rn FROM market),
l AS (SELECT region, dt, product(CASE WHEN rn > 12 THEN 1 + x * 0.01::DOUBLE ELSE 1 END) OVER (PARTITION BY region, rn % 12 ORDER BY dt) AS level FROM r)
SELECT region, dt, ROUND(level, 6) AS level, ROUND(level / LAG(level) OVER (PARTITION BY region ORDER BY dt) - 1, 6) AS change FROM l""")
def _(v):
    x = v.market.select("region", "dt", (F.col("mret") * 10).alias("x"))
    return _r(ts.stationary(x, ["region"], "x", "yoy").select("region", "dt", "level", "change"), ["level", "change"])


@query("win34_stationary_geom2", "panel", """
WITH g AS (SELECT asset_id, dt, price AS level, price / LAG(price) OVER (PARTITION BY asset_id ORDER BY dt) - 1 AS c FROM panel)
SELECT asset_id, dt, level, ROUND(c - LAG(c) OVER (PARTITION BY asset_id ORDER BY dt), 6) AS change FROM g""")
def _(v):
    return _r(ts.stationary(v.panel.select("asset_id", "dt", "price"), ["asset_id"], "price", "geom2").select("asset_id", "dt", "level", "change"), ["change"])


@query("win35_vintage_before", "revisions", """
SELECT id, dt, rev_dt, line, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id, dt ORDER BY rev_dt DESC, line DESC, part DESC, rev_del_flag DESC, value DESC) AS rn FROM revisions WHERE rev_dt < DATE '1998-01-01') r WHERE rn = 1""")
def _(v):
    return ts.vintage(v.revisions, ["id", "dt"], "before", "1998-01-01", "rev_dt", "line").select("id", "dt", "rev_dt", "line", "value")


@query("win35_vintage_initial", "revisions", "SELECT id, dt, rev_dt, line, value FROM revisions WHERE line = 1")
def _(v):
    x = v.revisions.withColumn("change_seq", F.col("line") - 1)
    return ts.vintage(x, ["id", "dt"], "initial").select("id", "dt", "rev_dt", "line", "value")


@query("win36_interpolate", "items", """
WITH a AS (SELECT asset_id, dt, CASE WHEN (asset_id + qi) % 3 <> 0 THEN value END AS v FROM (SELECT asset_id, dt, qi, SUM(value) AS value FROM items GROUP BY 1, 2, 3) s),
n AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN dt END IGNORE NULLS) OVER p AS pd, last_value(v IGNORE NULLS) OVER p AS pv, first_value(CASE WHEN v IS NOT NULL THEN dt END IGNORE NULLS) OVER f AS nd, first_value(v IGNORE NULLS) OVER f AS nv FROM a
 WINDOW p AS (PARTITION BY asset_id ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY asset_id ORDER BY dt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT asset_id, dt, ROUND(COALESCE(v, CASE WHEN nd > pd THEN pv + (nv - pv) * date_diff('day', pd, dt) / date_diff('day', pd, nd) END, pv, nv), 3) AS value FROM n""")
def _(v):
    x = v.items.groupBy("asset_id", "dt", "qi").agg(F.sum("value").alias("value"))
    x = x.select("asset_id", "dt", F.when((F.col("asset_id") + F.col("qi")) % 3 != 0, F.col("value")).alias("value"))
    return _r(ts.interpolate(x, "asset_id", "value"), ["value"], 3)


@query("win36_interpolate_daily", "market", """
WITH b AS (SELECT region, dt, mret, LEAD(dt) OVER w AS nd, LEAD(mret) OVER w AS nv FROM market WINDOW w AS (PARTITION BY region ORDER BY dt)),
g AS (SELECT region, dt AS pd, mret, nd, nv, unnest(generate_series(dt, COALESCE(nd - 1, dt), INTERVAL 1 DAY)) AS d FROM b)
SELECT region, CAST(d AS DATE) AS dt, ROUND(CASE WHEN nd IS NULL THEN mret ELSE mret + (nv - mret) * date_diff('day', pd, CAST(d AS DATE)) / date_diff('day', pd, nd) END, 6) AS mret FROM g""")
def _(v):
    return _r(ts.interpolate(v.market, "region", "mret", daily=True), ["mret"])


@query("win37_trim", "panel", """
WITH b AS (SELECT asset_id, quantile_cont(ret, 0.05) AS lo, quantile_cont(ret, 0.95) AS hi FROM panel GROUP BY 1)
SELECT p.asset_id, p.dt, ROUND(CASE WHEN ret IS NOT NULL THEN GREATEST(lo, LEAST(hi, ret)) END, 6) AS ret FROM panel p JOIN b ON p.asset_id = b.asset_id""")
def _(v):
    return _r(ts.trim(v.panel.select("asset_id", "dt", "ret"), ["asset_id"], "ret", 0.05), ["ret"])


@query("win38_uniform_month", "", f"WITH {_DAYS}, " + """s AS (SELECT dt, ROW_NUMBER() OVER (PARTITION BY date_trunc('month', dt) ORDER BY dt) AS r, COUNT(*) OVER (PARTITION BY date_trunc('month', dt)) AS n FROM d WHERE isodow(dt) <> 6)
SELECT dt FROM s WHERE n >= 8 AND r <= 8""")
def _(v):
    return ts.uniform_month(_days(v), 8)


@query("win39_curve_returns", "items", """
WITH c AS (SELECT asset_id, item, dt, value / 1000000 AS x FROM items), l AS (SELECT *, CASE WHEN x < 0.2::DOUBLE THEN x / 0.2::DOUBLE ELSE 1 + ln(x / 0.2::DOUBLE) END * 0.2::DOUBLE AS y FROM c)
SELECT asset_id AS curve, item AS node, dt, ROUND(y - LAG(y) OVER (PARTITION BY asset_id, item ORDER BY dt), 6) AS ret FROM l""")
def _(v):
    c = v.items.select(F.col("asset_id").alias("curve"), F.col("item").alias("node"), "dt", (F.col("value") / 1000000).alias("value"))
    return _r(ts.curve_returns(c, "log", a=0.2).select("curve", "node", "dt", "ret"), ["ret"])


@query("win39_term_spread", "items", """
WITH l AS (SELECT asset_id, dt, value FROM items WHERE item = '5-LOW'), s AS (SELECT asset_id, dt, value FROM items WHERE item = '1-URGENT'),
j AS (SELECT COALESCE(l.asset_id, s.asset_id) AS asset_id, COALESCE(l.dt, s.dt) AS dt, l.value - s.value AS x FROM l FULL JOIN s ON l.asset_id = s.asset_id AND l.dt = s.dt),
f AS (SELECT asset_id, dt, last_value(x IGNORE NULLS) OVER (PARTITION BY asset_id ORDER BY dt) AS spread FROM j)
SELECT asset_id, dt, ROUND(spread, 2) AS spread, ROUND(spread - LAG(spread) OVER (PARTITION BY asset_id ORDER BY dt), 2) AS ret FROM f""")
def _(v):
    node = lambda i: v.items.where(F.col("item") == i).select("asset_id", "dt", "value")
    return _r(ts.spread_returns(node("5-LOW"), node("1-URGENT"), ["asset_id"]), ["spread", "ret"], 2)


@query("win40_index_return", "panel", """
WITH x AS (SELECT asset_id, dt, CASE WHEN asset_id % 3 = 0 OR month(dt) <> 5 THEN price END AS p FROM panel)
SELECT asset_id, dt, ROUND(p / last_value(p IGNORE NULLS) OVER (PARTITION BY asset_id ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1, 6) AS ret FROM x""")
def _(v):
    x = v.panel.select("asset_id", "dt", F.when((F.col("asset_id") % 3 == 0) | (F.month("dt") != 5), F.col("price")).alias("p"))
    return _r(ts.index_return(x, ["asset_id"], "p").select("asset_id", "dt", "ret"), ["ret"])


@query("win41_roll_actions", "", f"WITH {_DAYS}," + """
a AS (SELECT l_suppkey AS id, CAST(l_shipdate AS DATE) AS dt, 1 + l_discount / 100 AS factor FROM lineitem),
t AS (SELECT x.dt, MIN(d.dt) AS trade_dt FROM (SELECT DISTINCT dt FROM a) x LEFT JOIN d ON d.dt >= x.dt GROUP BY x.dt)
SELECT id, trade_dt, ROUND(product(factor), 6) AS factor, COUNT(*) AS n_actions FROM a JOIN t USING (dt) GROUP BY 1, 2""")
def _(v):
    cal = _days(v).withColumn("market", F.lit(0))
    a = v.lineitem.select(F.lit(0).alias("market"), F.col("l_suppkey").alias("id"), F.col("l_shipdate").cast("date").alias("dt"), (1 + F.col("l_discount") / 100).alias("factor"))
    return _r(ts.roll_actions(a, cal, "market", "id").drop("market"), ["factor"])


@query("win42_convergence", "validity", """
SELECT v.id, v.status AS ccy, 'EUR' AS new_ccy, DATE '1999-01-04' AS conv_dt, CASE v.status WHEN 'F' THEN 6.5::DOUBLE ELSE 1.9::DOUBLE END AS rate FROM validity v WHERE v.status IN ('F', 'O') AND v.from_dt <= DATE '1999-01-04' AND DATE '1999-01-04' < v.thru_dt""")
def _(v):
    conv = v.spark.createDataFrame([("F", "EUR", "1999-01-04", 6.5), ("O", "EUR", "1999-01-04", 1.9)], "ccy string, new_ccy string, d string, rate double")
    conv = conv.select("ccy", "new_ccy", F.col("d").cast("date").alias("conv_dt"), "rate")
    return ts.convergence(v.validity.select("id", F.col("status").alias("ccy"), "from_dt", "thru_dt"), conv, "id")


@query("win44_process_returns", "panel market", "WITH " + _BETA + """,
k AS (SELECT p.asset_id, p.mi, p.region, CASE WHEN p.volume <= 60 THEN NULL ELSE p.ret END AS ret, COALESCE(b.beta, 1) * m.mret AS proxy FROM panel p LEFT JOIN beta b ON p.asset_id = b.asset_id LEFT JOIN market m ON m.region = p.region AND m.mi = p.mi),
l AS (SELECT asset_id, region, MIN(mi) AS a, MAX(mi) AS b FROM panel GROUP BY 1, 2), d AS (SELECT asset_id, region, unnest(range(a, b + 1)) AS mi FROM l),
x AS (SELECT d.asset_id, d.mi, k.ret, COALESCE(b.beta, 1) * m.mret AS proxy FROM d LEFT JOIN k ON d.asset_id = k.asset_id AND d.mi = k.mi LEFT JOIN beta b ON d.asset_id = b.asset_id LEFT JOIN market m ON m.region = d.region AND m.mi = d.mi),
g AS (SELECT *, COUNT(ret) OVER (PARTITION BY asset_id ORDER BY mi) AS g FROM x),
c AS (SELECT *, product(CASE WHEN ret IS NULL AND proxy IS NOT NULL THEN 1 + proxy ELSE 1 END) OVER (PARTITION BY asset_id, g ORDER BY mi) AS c FROM g),
b AS (SELECT *, CASE WHEN LAG(ret) OVER w IS NULL THEN COALESCE(LAG(c) OVER w, 1) ELSE 1 END AS back FROM c WINDOW w AS (PARTITION BY asset_id ORDER BY mi))
SELECT asset_id, mi, ROUND(CASE WHEN ret IS NOT NULL THEN (1 + ret) / back - 1 ELSE proxy END, 6) AS filled FROM b""")
def _(v):
    p = v.panel.select("asset_id", "mi", "volume", F.when(F.col("volume") <= 60, 0.0).otherwise(F.col("ret")).alias("ret"))
    p = p.withColumn("volume", F.when(F.col("volume") <= 60, 0.0).otherwise(F.col("volume")))
    home = v.supplier.join(v.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("asset_id"), F.col("n_regionkey").alias("market"))
    d = ts.densify(p, "asset_id", "mi").join(home, "asset_id")
    d = d.withColumn("dt", F.make_date(F.floor((F.col("mi") - 1) / 12).cast("int"), ((F.col("mi") - 1) % 12 + 1).cast("int"), F.lit(1)))
    mkt = v.market.withColumnRenamed("region", "market")
    first = v.panel.groupBy("asset_id").agg(F.min("dt").alias("from_dt"))
    cal = v.panel.select(F.col("region").alias("market"), "dt").distinct()
    return _r(ts.process_returns(d, mkt, _beta(v), first, cal, step="mi").select("asset_id", "mi", "filled"), ["filled"])
