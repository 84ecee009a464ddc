"""Fundamental descriptors and the user-defined surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import catalogue as ct, descriptors as ds, fundamentals as fu, timeseries as ts
from riskloom.plans.registry import query

AS_OF = "1999-06-30"


def _r(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


def wide_items(v):
    """Quarterly items per customer under the names the ratio tables use."""
    s, i, d = F.col("sales"), F.col("income"), F.col("debt")
    return v.quarters.withColumns(
        {
            "book": i - d * 0.5, "cap": s * 2, "assets": s + d, "cost": s * 0.6, "gross": s * 0.4, "cash_flow": i - s * 0.1, "operating_cash": i * 0.8,
            "accruals": i - d, "ebitda": i + s * 0.05, "current_assets": s * 0.3, "current_liabilities": d * 0.3, "dividends": i * 0.2,
        }
    )


WIDE_SQL = """wide AS (SELECT *, income - debt * 0.5::DOUBLE AS book, sales * 2 AS cap, sales + debt AS assets, sales * 0.6::DOUBLE AS cost, sales * 0.4::DOUBLE AS gross, income - sales * 0.1::DOUBLE AS cash_flow,
 income * 0.8::DOUBLE AS operating_cash, income - debt AS accruals, income + sales * 0.05::DOUBLE AS ebitda, sales * 0.3::DOUBLE AS current_assets, debt * 0.3::DOUBLE AS current_liabilities, income * 0.2::DOUBLE AS dividends FROM quarters)"""

_PROC = {
    "latest": "last_value({c} IGNORE NULLS) OVER (PARTITION BY asset_id ORDER BY qi RANGE BETWEEN 7 PRECEDING AND CURRENT ROW)",
    "average": "AVG({c}) OVER (PARTITION BY asset_id ORDER BY qi RANGE BETWEEN 7 PRECEDING AND CURRENT ROW)",
    "annualise": "CASE WHEN COUNT({c}) OVER (PARTITION BY asset_id ORDER BY qi RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 THEN SUM({c}) OVER (PARTITION BY asset_id ORDER BY qi RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) * 4.0::DOUBLE / COUNT({c}) OVER (PARTITION BY asset_id ORDER BY qi RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) END",
}


def _side(item: str, process: str, negative, zero) -> str:
    e = _PROC[process].format(c=item)
    if negative == "mask":
        e = f"CASE WHEN ROUND({e}, 4) >= 0 THEN {e} END"
    elif negative == "zero":
        e = f"CASE WHEN {e} < 0 THEN 0 ELSE {e} END"
    if zero == "mask":
        e = f"NULLIF({e}, 0)"
    return e


def _ratio_sql(table) -> str:
    cols = []
    for n, r in table.items():
        e = _side(r.num, r.num_process, r.num_negative, None)
        if r.den:
            e = f"({e}) / ({_side(r.den, r.den_process, r.den_negative, r.den_zero)})"
        cols.append(f"ROUND({e}, 6) AS {n}")
    return "WITH " + WIDE_SQL + " SELECT asset_id, qi, " + ", ".join(cols) + " FROM wide"


for _name, _table in {"fun02_price_ratios": fu.PRICE_RATIOS, "fun03_profit_ratios": fu.PROFIT_RATIOS, "fun04_balance_ratios": fu.BALANCE_RATIOS}.items():
    query(_name, "quarters", _ratio_sql(_table))(
        lambda v, t=_table: _r(fu.ratios(wide_items(v), t).select("asset_id", "qi", *t), list(t))
    )


@query("fun05_items", "quarters", _ratio_sql({f"{n}_item": r for n, r in fu.ITEMS.items()}))
def _(v):
    t = {f"{n}_item": r for n, r in fu.ITEMS.items()}
    return _r(fu.ratios(wide_items(v), t).select("asset_id", "qi", *t), list(t))


@query("fun01_mixed_frequency", "quarters", "WITH " + WIDE_SQL + f""",
p AS (SELECT asset_id, qi, {_PROC['annualise'].format(c='income')} AS nq, {_PROC['latest'].format(c='income')} * 4 AS na, CASE WHEN asset_id % 3 <> 0 THEN {_PROC['average'].format(c='sales')} END AS dq, {_PROC['latest'].format(c='sales')} * 4 AS da FROM wide)
SELECT asset_id, qi, ROUND(CASE WHEN nq IS NOT NULL AND dq IS NOT NULL THEN nq / NULLIF(dq, 0) ELSE na / NULLIF(da, 0) END, 6) AS margin FROM p""")
def _(v):
    x = wide_items(v).select(
        "asset_id", "qi", fu.annualised("income").alias("nq"), (fu.latest_of("income") * 4).alias("na"), F.when(F.col("asset_id") % 3 != 0, fu.averaged("sales")).alias("dq"), (fu.latest_of("sales") * 4).alias("da")
    )
    return _r(fu.mixed_frequency(x, "nq", "na", "dq", "da", "margin").select("asset_id", "qi", "margin"), ["margin"])


@query("fun04_payout_with_proxy", "quarters", """
SELECT asset_id, qi, ROUND(income * 0.2::DOUBLE / COALESCE(CASE WHEN income - debt > 0 THEN income - debt END, AVG(CASE WHEN income - debt > 0 THEN income - debt END) OVER (PARTITION BY asset_id ORDER BY qi RANGE BETWEEN 7 PRECEDING AND CURRENT ROW)), 6) AS payout FROM quarters""")
def _(v):
    return _r(fu.payout_with_proxy(wide_items(v), "dividends", "accruals").select("asset_id", "qi", "payout"), ["payout"])


_ANNUAL = """ann AS (SELECT asset_id, make_date(CAST(year(dt) AS BIGINT), 12, 31) AS dt, ROUND(SUM(sales), 2) AS value FROM quarters GROUP BY 1, 2)"""


def _annual(v):
    return v.quarters.groupBy("asset_id", F.make_date(F.year("dt"), F.lit(12), F.lit(31)).alias("dt")).agg(F.round(F.sum("sales"), 2).alias("value"))


def _growth_sql(top: str, n: int, name: str, extra: str = "") -> str:
    return "WITH " + _ANNUAL + f""",
x AS (SELECT * FROM ann WHERE dt <= DATE '{AS_OF}'), l AS (SELECT asset_id, MAX(dt) AS last FROM x GROUP BY 1), k AS (SELECT x.* FROM x JOIN l USING (asset_id) WHERE date_diff('day', x.dt, last) / 365.0::DOUBLE <= 4.05::DOUBLE),
ok AS (SELECT asset_id FROM k GROUP BY 1 HAVING COUNT(DISTINCT value) > {n}), u AS (SELECT k.asset_id, k.dt, k.value FROM k JOIN ok USING (asset_id) {extra})
SELECT asset_id, ROUND({top} / AVG(abs(value)), 6) AS {name} FROM u GROUP BY 1"""


@query("fun06_growth", "quarters", _growth_sql("regr_slope(value, date_diff('day', DATE '2000-01-01', dt) / 365.0::DOUBLE)", 2, "growth"))
def _(v):
    return _r(fu.growth(_annual(v), AS_OF), ["growth"])


@query("fun06_growth_with_forecast", "quarters", _growth_sql(
    "regr_slope(value, date_diff('day', DATE '2000-01-01', dt) / 365.0::DOUBLE)", 2, "growth",
    "UNION ALL SELECT l.asset_id, a.dt, a.value FROM l JOIN ok USING (asset_id) JOIN ann a ON a.asset_id = l.asset_id AND a.dt > l.last AND a.dt < l.last + 400"))
def _(v):
    return _r(fu.growth(_annual(v), AS_OF, forecasts=_annual(v)), ["growth"])


@query("fun06_variability", "quarters", _growth_sql("stddev_samp(value)", 4, "variability").replace(AS_OF, "2000-12-31"))
def _(v):
    return _r(fu.growth(_annual(v), "2000-12-31", variability=True), ["variability"])


@query("fun07_growth_rolling", "quarters", f"""
WITH a AS (SELECT asset_id, qi, {_PROC['annualise'].format(c='sales')} AS a FROM quarters),
p AS (SELECT x.asset_id, x.qi, -y AS t, b.a AS v FROM a x, range(5) r(y), a b WHERE b.asset_id = x.asset_id AND b.qi = x.qi - 4 * y AND b.a IS NOT NULL),
g AS (SELECT asset_id, qi, regr_slope(v, t) / AVG(abs(v)) AS g FROM p GROUP BY 1, 2 HAVING COUNT(*) > 2)
SELECT a.asset_id, a.qi, ROUND(g, 6) AS growth FROM a LEFT JOIN g ON g.asset_id = a.asset_id AND g.qi = a.qi""")
def _(v):
    return _r(fu.growth_rolling(v.quarters, "sales").select("asset_id", "qi", "growth"), ["growth"])


_ESTIMATES = """e AS (SELECT o_custkey AS asset_id, CAST(4 * year(o_orderdate) + quarter(o_orderdate) AS BIGINT) AS made, arg_max(o_totalprice * 4, {'d': CAST(o_orderdate AS DATE), 'v': o_totalprice}) AS v FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2),
known AS (SELECT q.asset_id, q.qi, arg_max(e.v, e.made) AS forecast FROM quarters q JOIN e ON e.asset_id = q.asset_id AND e.made BETWEEN q.qi - 3 AND q.qi GROUP BY 1, 2)"""


def _with_forecast(v):
    q = fu.quarter_index(F.trunc(F.col("o_orderdate").cast("date"), "quarter"))
    e = v.orders.where("o_orderkey % 3 <> 0").select(F.col("o_custkey").alias("asset_id"), F.col("o_orderdate").cast("date").alias("eff_dt"), (F.col("o_totalprice") * 4).alias("value"), q.alias("qi"))
    return fu.as_of_forecast(v.quarters, e)


@query("fun07_as_of_forecast", "quarters", "WITH " + _ESTIMATES + " SELECT q.asset_id, q.qi, ROUND(forecast, 4) AS forecast FROM quarters q LEFT JOIN known k ON k.asset_id = q.asset_id AND k.qi = q.qi")
def _(v):
    return _r(_with_forecast(v).select("asset_id", "qi", "forecast"), ["forecast"], 4)


_POINTS = f"""a AS (SELECT asset_id, qi, {_PROC['annualise'].format(c='sales')} AS a FROM quarters),
p AS (SELECT x.asset_id, x.qi, -y AS t, b.a AS v FROM a x, range(5) r(y), a b WHERE b.asset_id = x.asset_id AND b.qi = x.qi - 4 * y AND b.a IS NOT NULL)"""


@query("fun07_growth_rolling_with_forecast", "quarters", "WITH " + _ESTIMATES + ", " + _POINTS + """,
u AS (SELECT * FROM p UNION ALL SELECT asset_id, qi, 1, forecast FROM known),
g AS (SELECT asset_id, qi, regr_slope(v, t) / AVG(abs(v)) AS g FROM u GROUP BY 1, 2 HAVING COUNT(*) > 2)
SELECT a.asset_id, a.qi, ROUND(g, 6) AS growth FROM a LEFT JOIN g ON g.asset_id = a.asset_id AND g.qi = a.qi""")
def _(v):
    """Realised years and the year ahead as it was forecast at the time."""
    return _r(fu.growth_rolling(_with_forecast(v), "sales", forecast="forecast").select("asset_id", "qi", "growth"), ["growth"])


@query("fun07_earnings_variability", "quarters", "WITH " + _POINTS + """,
g AS (SELECT asset_id, qi, stddev_samp(v) / AVG(abs(v)) AS g FROM p GROUP BY 1, 2 HAVING COUNT(*) > 4)
SELECT a.asset_id, a.qi, ROUND(g, 6) AS variability FROM a LEFT JOIN g ON g.asset_id = a.asset_id AND g.qi = a.qi""")
def _(v):
    return _r(fu.growth_rolling(v.quarters, "sales", variability=True, name="variability").select("asset_id", "qi", "variability"), ["variability"])


_EST = f"""est AS (SELECT o_custkey AS asset_id, 'eps' AS item, make_date(CAST(year(o_orderdate) + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT), 12, 31) AS dt, CAST(o_orderdate AS DATE) AS eff_dt, ROUND(SUM(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2, 3, 4),
cl AS (SELECT asset_id, dt, arg_max(eff_dt, eff_dt) AS eff_dt, arg_max(value, eff_dt) AS value FROM est WHERE eff_dt <= DATE '{AS_OF}' GROUP BY 1, 2),
rep AS (SELECT o_custkey AS asset_id, MAX(make_date(CAST(year(o_orderdate) AS BIGINT), 12, 31)) AS last FROM orders WHERE o_orderstatus = 'F' AND make_date(CAST(year(o_orderdate) AS BIGINT), 12, 31) <= DATE '{AS_OF}' GROUP BY 1),
ce AS (SELECT cl.* FROM cl LEFT JOIN rep USING (asset_id) WHERE last IS NULL OR dt > last + 30)"""


def _estimates(v):
    fy = F.make_date(F.year("o_orderdate") + F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0), F.lit(12), F.lit(31))
    est = v.orders.groupBy(F.col("o_custkey").alias("asset_id"), F.lit("eps").alias("item"), fy.alias("dt"), F.col("o_orderdate").cast("date").alias("eff_dt")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    rep = v.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("asset_id"), F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).alias("dt")).distinct()
    return fu.clean_estimates(est, rep, AS_OF, days=30)


@query("fun08_clean_estimates", "", "WITH " + _EST + " SELECT asset_id, dt, eff_dt, value FROM ce")
def _(v):
    return _estimates(v).select("asset_id", "dt", "eff_dt", "value")


_FWD = f"""cur AS (SELECT asset_id, MIN(dt) AS dt, arg_min(eff_dt, dt) AS eff_dt, arg_min(value, dt) AS value FROM ce WHERE dt > DATE '{AS_OF}' AND date_diff('day', DATE '{AS_OF}', dt) <= 366 GROUP BY 1),
nx AS (SELECT ce.asset_id, arg_min(ce.value, ce.dt) AS value FROM ce JOIN cur ON cur.asset_id = ce.asset_id WHERE ce.dt > DATE '{AS_OF}' AND date_diff('day', cur.dt, ce.dt) BETWEEN 330 AND 400 AND ce.eff_dt >= cur.eff_dt GROUP BY 1),
fwd AS (SELECT cur.asset_id, CASE WHEN nx.value IS NOT NULL THEN t * cur.value + (1 - t) * nx.value ELSE cur.value END AS fwd12 FROM (SELECT *, date_diff('day', DATE '{AS_OF}', dt) / 365.0::DOUBLE AS t FROM cur) cur LEFT JOIN nx USING (asset_id))"""


@query("fun09_forward_12m", "", "WITH " + _EST + ", " + _FWD + " SELECT asset_id, ROUND(fwd12, 4) AS fwd12 FROM fwd")
def _(v):
    return _r(fu.forward_12m(_estimates(v), AS_OF), ["fwd12"], 4)


@query("fun09_est_earnings_yield", "", "WITH " + _EST + ", " + _FWD + """,
e AS (SELECT CAST(floor(asset_id / 4) AS BIGINT) AS issuer, SUM(fwd12) AS e FROM fwd GROUP BY 1), c AS (SELECT CAST(floor(c_custkey / 4) AS BIGINT) AS issuer, SUM(c_acctbal) AS cap FROM customer GROUP BY 1)
SELECT c_custkey AS asset_id, ROUND(CASE WHEN e < 0 THEN NULL ELSE e END / CASE WHEN cap > 0 THEN cap END, 4) AS est_ep FROM customer JOIN e ON e.issuer = CAST(floor(c_custkey / 4) AS BIGINT) JOIN c ON c.issuer = e.issuer""")
def _(v):
    lines = v.customer.select(F.col("c_custkey").alias("asset_id"), F.floor(F.col("c_custkey") / 4).alias("issuer"), "c_acctbal")
    caps = lines.groupBy("issuer").agg(F.sum("c_acctbal").alias("cap"))
    return _r(fu.est_earnings_yield(fu.forward_12m(_estimates(v), AS_OF), lines, caps, negative="mask"), ["est_ep"], 4)


@query("fun10_est_ratios", "quarters", "WITH " + WIDE_SQL + """
SELECT asset_id, qi, ROUND(cash_flow / NULLIF(cap, 0), 6) AS est_cash_flow, ROUND(income / NULLIF(cap, 0), 6) AS est_income, ROUND(CASE WHEN ROUND(book, 6) >= 0 THEN income / NULLIF(book, 0) END, 4) AS est_roe, ROUND(income / NULLIF(assets, 0), 6) AS est_roa FROM wide""")
def _(v):
    x = fu.est_ratios(wide_items(v))
    return _r(_r(x.select("asset_id", "qi", "est_cash_flow", "est_income", "est_roe", "est_roa"), ["est_roe"], 4), ["est_cash_flow", "est_income", "est_roa"])


@query("fun10_est_growth", "quarters", "WITH " + _EST + ", " + _FWD + ", " + _ANNUAL + f""",
r AS (SELECT asset_id, arg_max(value, dt) AS value FROM ann WHERE dt <= DATE '{AS_OF}' GROUP BY 1) SELECT asset_id, ROUND((fwd12 - value) / NULLIF(abs(value), 0), 4) AS est_growth FROM fwd JOIN r USING (asset_id)""")
def _(v):
    real = _annual(v).where(f"dt <= '{AS_OF}'").groupBy("asset_id").agg(F.max_by("value", "dt").alias("value"))
    return _r(fu.est_growth(fu.forward_12m(_estimates(v), AS_OF), real), ["est_growth"], 4)


@query("fun11_short_interest", "items", f"""
WITH s AS (SELECT asset_id, arg_max(value, dt) AS s FROM items WHERE item = '1-URGENT' AND dt <= DATE '{AS_OF}' AND date_diff('day', dt, DATE '{AS_OF}') <= 731 GROUP BY 1),
o AS (SELECT asset_id, arg_max(value, dt) AS o FROM items WHERE item = '5-LOW' AND dt <= DATE '{AS_OF}' AND date_diff('day', dt, DATE '{AS_OF}') <= 731 GROUP BY 1)
SELECT asset_id, ROUND(s / NULLIF(o, 0), 6) AS short_interest FROM s JOIN o USING (asset_id)""")
def _(v):
    item = lambda i: v.items.where(F.col("item") == i)
    return _r(fu.short_interest(item("1-URGENT"), item("5-LOW"), AS_OF), ["short_interest"])


_RNG = "OVER (PARTITION BY asset_id ORDER BY qi RANGE BETWEEN {a} PRECEDING AND {b})"


@query("fun12_share_buyback", "quarters", f"SELECT asset_id, qi, ROUND(SUM(income) {_RNG.format(a=3, b='CURRENT ROW')} * 0.001::DOUBLE / shares, 6) AS share_buyback FROM quarters")
def _(v):
    return _r(fu.share_buyback(v.quarters, "income", "shares", multiplier=0.001).select("asset_id", "qi", "share_buyback"), ["share_buyback"])


@query("fun13_net_issuance", "quarters", f"""
SELECT asset_id, qi, ROUND(ln(shares / (last_value(shares) {_RNG.format(a=7, b='4 PRECEDING')} * exp(SUM(ln(CASE WHEN qi % 3 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END)) {_RNG.format(a=3, b='CURRENT ROW')}))), 6) AS net_equity_issuance,
 ROUND(ln(last_value(CASE WHEN debt > 0 THEN debt END IGNORE NULLS) {_RNG.format(a=3, b='CURRENT ROW')} / last_value(CASE WHEN debt > 0 THEN debt END IGNORE NULLS) {_RNG.format(a=7, b='4 PRECEDING')}), 6) AS net_debt_issuance FROM quarters""")
def _(v):
    x = v.quarters.withColumn("split", F.when(F.col("qi") % 3 == 0, 2.0).otherwise(1.0))
    x = fu.net_debt_issuance(fu.net_equity_issuance(x, "shares", "split"), "debt")
    return _r(x.select("asset_id", "qi", "net_equity_issuance", "net_debt_issuance"), ["net_equity_issuance", "net_debt_issuance"])


@query("fun14_net_payout", "quarters", "WITH " + WIDE_SQL + f"""
SELECT asset_id, qi, ROUND((SUM(income) {_RNG.format(a=19, b='CURRENT ROW')} + book - first_value(book) {_RNG.format(a=20, b='20 PRECEDING')}) / (SUM(sales) {_RNG.format(a=19, b='CURRENT ROW')} - SUM(cost) {_RNG.format(a=19, b='CURRENT ROW')}), 6) AS net_payout FROM wide""")
def _(v):
    return _r(fu.net_payout(wide_items(v), "income", "book", "sales", "cost").select("asset_id", "qi", "net_payout"), ["net_payout"])


@query("fun15_altman_z", "quarters", "WITH " + WIDE_SQL + """
SELECT asset_id, qi, ROUND((1.2::DOUBLE * (current_assets - current_liabilities) + 1.4::DOUBLE * book + 3.3::DOUBLE * ebitda + 0.6::DOUBLE * cap + sales) / assets, 6) AS altman_z FROM wide""")
def _(v):
    return _r(fu.altman_z(wide_items(v)).select("asset_id", "qi", "altman_z"), ["altman_z"])


@query("fun15_roe_variability_and_delta", "quarters", "WITH " + WIDE_SQL + f""", r AS (SELECT asset_id, qi, income / assets AS roa FROM wide)
SELECT asset_id, qi, ROUND(stddev_samp(roa) {_RNG.format(a=19, b='CURRENT ROW')}, 6) AS roe_variability, ROUND(roa - first_value(roa) {_RNG.format(a=4, b='4 PRECEDING')}, 6) AS delta_roa FROM r""")
def _(v):
    x = wide_items(v).withColumn("roa", F.col("income") / F.col("assets"))
    x = fu.delta(fu.roe_variability(x, "roa"), "roa")
    return _r(x.select("asset_id", "qi", "roe_variability", "delta_roa"), ["roe_variability", "delta_roa"])


_NAMES = ["momentum_6", "hist_vol_12", "high_low_6"]


@query("fun17_build_descriptors", "panel", """
WITH d AS (SELECT asset_id, dt, product(1 + COALESCE(ret, 0)) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) - 1 AS momentum_6,
 sqrt(SUM(COALESCE(ret * ret, 0)) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) / 12) AS hist_vol_12,
 ln(MAX(mcap) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) / MIN(mcap) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)) AS high_low_6 FROM panel)
SELECT asset_id, dt, descriptor, ROUND(value, 6) AS value FROM (UNPIVOT d ON momentum_6, hist_vol_12, high_low_6 INTO NAME descriptor VALUE value) u""")
def _(v):
    return _r(ct.build_descriptors(v.panel, _NAMES), ["value"])


@query("fun16_catalogue_coverage", "panel")
def _(v):
    # every return descriptor of the catalogue with its coverage on the panel
    names = [r[1] for r in ct.catalogue_rows() if r[3] > 0]
    long = ct.build_descriptors(v.panel, names)
    n = long.groupBy("descriptor").agg(F.count("*").alias("n_values"), F.round(F.avg("value"), 6).alias("mean"))
    return ct.catalogue(v.spark).join(n, F.col("name") == F.col("descriptor")).select("id", "name", "family", "window", "is_local", "n_values", "mean")


MARKETS, SERIES = ["local", "regional", "world"], ["s0", "s1", "s2", "s3", "s4"]
ALL = ds.catalogue(MARKETS, SERIES, "world")


def with_factors(v):
    """The panel with returns of its country, region and the world, and of each region's market as a series."""
    local = ts.weighted_return(v.panel, ["country", "mi"], "ret", "lag_mcap", "x")
    series = v.market.groupBy("mi").pivot("region", [0, 1, 2, 3, 4]).agg(F.first("mret")).withColumnsRenamed({str(i): f"s{i}" for i in range(5)})
    x = ds.factor_columns(v.panel, {"local": (local, ["country", "mi"], "x"), "regional": (v.market, ["region", "mi"], "mret"), "world": (v.world, ["mi"], "wret")})
    return x.join(series, "mi", "left")


def _descriptor_sql(d) -> str:
    """The same descriptor in SQL, from its name's parts."""
    w = f"OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN {d.window - 1} PRECEDING AND " + (f"{d.gap} PRECEDING)" if d.gap else "CURRENT ROW)")
    n, a, k = d.window, d.against, ds.least(d.window)
    if d.net:
        y, x, m = (f"CASE WHEN ret IS NOT NULL AND {a} IS NOT NULL AND {d.net} IS NOT NULL THEN {c} END" for c in ("ret", a, d.net))
        xx, mm, xm = f"covar_pop({x}, {x}) {w}", f"covar_pop({m}, {m}) {w}", f"covar_pop({x}, {m}) {w}"
        det = f"({xx} * {mm} - {xm} * {xm})"
        return f"CASE WHEN COUNT({y}) {w} >= {k + 1} AND {det} > {xx} * {mm} * 1e-6 THEN (covar_pop({y}, {x}) {w} * {mm} - covar_pop({y}, {m}) {w} * {xm}) / {det} END"
    fit = f"CASE WHEN regr_count(ret, {a}) {w} >= {k} THEN " + "{} END"
    return {
        "momentum": f"CASE WHEN COUNT(ret) {w} > 0 THEN exp(SUM(ln(1 + GREATEST(COALESCE(ret, 0), -0.999))) {w}) - 1 END", "hist_vol": f"sqrt(SUM(COALESCE(ret * ret, 0)) {w} / {n})",
        "mean_return": f"CASE WHEN COUNT(ret) {w} >= {k} THEN AVG(ret) {w} END",
        "skewness": f"CASE WHEN COUNT(ret) {w} >= {k} AND var_pop(ret) {w} > 1e-12 THEN (AVG(ret ** 3) {w} - 3 * AVG(ret) {w} * AVG(ret ** 2) {w} + 2 * (AVG(ret) {w}) ** 3) / (var_pop(ret) {w}) ** 1.5 END",
        "high_low": f"ln(MAX(mcap) {w} / NULLIF(MIN(mcap) {w}, 0))", "turnover": f"ln(NULLIF(AVG(volume) {w} / NULLIF(AVG(mcap) {w}, 0), 0))", "dollar_volume": f"AVG(volume * price) {w}",
        "amihud": f"AVG(abs(ret) / NULLIF(volume * price, 0)) {w}", "traded": f"COUNT(ret) {w} / {n}.0::DOUBLE", "nonzero": f"COALESCE(SUM(CASE WHEN ret <> 0 THEN 1 ELSE 0 END) {w}, 0) / {n}.0::DOUBLE",
        "beta": fit.format(f"regr_slope(ret, {a}) {w}"), "alpha": fit.format(f"regr_intercept(ret, {a}) {w}"), "correlation": fit.format(f"sqrt(regr_r2(ret, {a}) {w})"), "sensitivity": fit.format(f"regr_slope(ret, {a}) {w}"),
        "residual_vol": fit.format(f"sqrt(GREATEST(regr_syy(ret, {a}) {w} - (regr_sxy(ret, {a}) {w}) ** 2 / NULLIF(regr_sxx(ret, {a}) {w}, 0), 0) / NULLIF(regr_count(ret, {a}) {w} - 2, 0))"),
    }[d.family]


_WITH_FACTORS = """f AS (SELECT p.*, l.x AS local, m.mret AS regional, w.wret AS world, """ + ", ".join(f"s{i}.mret AS s{i}" for i in range(5)) + """ FROM panel p
 LEFT JOIN (SELECT country, mi, SUM(lag_mcap * ret) / SUM(lag_mcap) AS x FROM panel WHERE ret IS NOT NULL GROUP BY 1, 2) l ON l.country = p.country AND l.mi = p.mi
 LEFT JOIN market m ON m.region = p.region AND m.mi = p.mi LEFT JOIN world w ON w.mi = p.mi """ + " ".join(f"LEFT JOIN market s{i} ON s{i}.region = {i} AND s{i}.mi = p.mi" for i in range(5)) + ")"


def _family(families: list[str]):
    """A query with every descriptor of some families, as columns."""
    mine = [d for d in ALL if d.family in families]
    sql = "WITH " + _WITH_FACTORS + " SELECT asset_id, dt, " + ", ".join(f"ROUND({_descriptor_sql(d)}, 5) AS {d.name}" for d in mine) + " FROM f"

    @query(f"fun16_descriptors_{families[0]}", "panel market world", sql)
    def _(v):
        return _r(ds.build(with_factors(v), mine).select("asset_id", "dt", *[d.name for d in mine]), [d.name for d in mine], 5)


for _group in (["momentum", "hist_vol", "mean_return", "skewness"], ["turnover", "high_low", "dollar_volume", "amihud", "traded", "nonzero"], ["beta", "alpha", "residual_vol", "correlation"], ["sensitivity"]):
    _family(_group)


@query("fun16_catalogue", "panel market world")
def _(v):
    """The catalogue with how many values each return descriptor has on the panel."""
    names = [d.name for d in ALL]
    n = ds.build(with_factors(v), ALL).agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "name", "n_values")
    return ds.table(v.spark, ALL).join(n, "name", "left")


@query("udx01_registered_descriptor", "panel", """
SELECT asset_id, dt, descriptor, ROUND(value, 6) AS value FROM (SELECT asset_id, dt, 'range3' AS descriptor, MAX(price) OVER w / MIN(price) OVER w - 1 AS value FROM panel WINDOW w AS (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 2 PRECEDING AND CURRENT ROW))""")
def _(v):
    reg = ct.Registry()
    w = lambda n: ts.last_steps(["asset_id"], "mi", n)
    reg.register("range3", lambda d, p: d.withColumn("range3", F.max("price").over(w(p["n"])) / F.min("price").over(w(p["n"])) - 1), n=3)
    return _r(ct.build_descriptors(v.panel, ["range3"], reg), ["value"])


@query("udx02_source_logic", "items", """
WITH u AS (SELECT asset_id, dt, value FROM items WHERE item IN ('1-URGENT', '2-HIGH')) SELECT asset_id, dt, MAX(value) AS value FROM u GROUP BY 1, 2""")
def _(v):
    src = lambda i: v.items.where(F.col("item") == i).select("asset_id", "dt", "value")
    return ct.choose([src("1-URGENT"), src("2-HIGH")], ["asset_id", "dt"], "value", "max")


CONFIG = """
[DEFAULT]
keys = asset_id, dt
value = value

[urgent-first]
sources = item:items:item=1-URGENT, item:items:item=2-HIGH, item:items:item=5-LOW
logic = first

[both-agree]
sources = item:items:item=1-URGENT, scaled:items:item=1-URGENT:by=1
logic = agree

[least]
sources = item:items:item=3-MEDIUM, scaled:items:item=2-HIGH:by=0.5
logic = min
"""


@query("udx02_configured", "items", """
WITH u AS (SELECT asset_id, dt, MAX(CASE WHEN item = '1-URGENT' THEN value END) AS u, MAX(CASE WHEN item = '2-HIGH' THEN value END) AS h, MAX(CASE WHEN item = '5-LOW' THEN value END) AS l, MAX(CASE WHEN item = '3-MEDIUM' THEN value END) AS m FROM items GROUP BY 1, 2)
SELECT 'urgent-first' AS section, asset_id, dt, COALESCE(u, h, l) AS value FROM u WHERE COALESCE(u, h, l) IS NOT NULL UNION ALL SELECT 'both-agree', asset_id, dt, u FROM u WHERE u IS NOT NULL
UNION ALL SELECT 'least', asset_id, dt, LEAST(m, h * 0.5) FROM u WHERE COALESCE(m, h) IS NOT NULL""")
def _(v):
    reg = ct.Registry()
    of = lambda d, p: d.where(F.col("item") == p["item"]).select("asset_id", "dt", "value")
    reg.register("item", of)
    reg.register("scaled", lambda d, p: of(d, p).withColumn("value", F.col("value") * float(p["by"])), by="2")
    return ct.configured(CONFIG, reg, {"items": v.items})


@query("udx03_expression", "panel", "SELECT asset_id, dt, ROUND(GREATEST(exp(-(volume * 0.001::DOUBLE)), cos(price) + 0.5::DOUBLE), 6) AS value FROM panel")
def _(v):
    nodes = {1: ("max", 2, 6), 2: ("exp", 3), 3: ("uminus", 4), 4: ("times", 5, 10), 5: ("var", "t"), 10: ("const", 0.001), 6: ("plus", 7, 9), 7: ("cos", 8), 8: ("var", "tau"), 9: ("const", 0.5)}
    col = ct.expression(nodes, 1, {"t": F.col("volume"), "tau": F.col("price")})
    return v.panel.select("asset_id", "dt", F.round(col, 6).alias("value"))


@query("udx04_report", "panel", """
SELECT 'counts' AS section, CAST(region AS VARCHAR) AS row, 'n' AS "column", CAST(COUNT(*) AS VARCHAR) AS text FROM panel GROUP BY region
UNION ALL SELECT 'markets', CAST(country AS VARCHAR), 'assets', CAST(COUNT(DISTINCT asset_id) AS VARCHAR) FROM panel GROUP BY country""")
def _(v):
    a = v.panel.groupBy("region").agg(F.count("*").alias("n"))
    b = v.panel.select("country", "asset_id").distinct().groupBy("country").agg(F.count("*").alias("assets"))
    return ct.report({"counts": a, "markets": b})
