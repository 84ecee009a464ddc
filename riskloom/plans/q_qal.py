"""Quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import aggregates as ag, digests as dg, quality as ql
from riskloom.plans.q_agg import factor_long
from riskloom.plans.q_base import scratch
from riskloom.plans.q_risk import linked_cov
from riskloom.plans.registry import query
from riskloom.session import stored

M = 12 * 2000 + 6


def _r(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


def _exp(v):
    return stored(v.exposures.where(F.col("mi").isin(M - 1, M)).select("asset_id", "mi", "country", "region", "mcap", "size", "momentum"))


_PC = f"p AS (SELECT * FROM exposures WHERE mi = {M - 1}), c AS (SELECT * FROM exposures WHERE mi = {M})"


@query("qal01_exposure_changes", "exposures", "WITH " + _PC + """,
j AS (SELECT p.asset_id, c.size - p.size AS ds, c.momentum - p.momentum AS dm, p.mcap > 200000 AS g0, c.mcap > 200000 AS g1 FROM p JOIN c USING (asset_id))
SELECT asset_id, 'size' AS item, ROUND(ds, 6) AS change FROM j WHERE abs(ds) > 0.5::DOUBLE UNION ALL SELECT asset_id, 'momentum', ROUND(dm, 6) FROM j WHERE abs(dm) > 0.5::DOUBLE UNION ALL SELECT asset_id, 'band', NULL FROM j WHERE g0 <> g1""")
def _(v):
    x = _exp(v).withColumn("band", F.col("mcap") > 200000)
    return _r(ql.check_exposures(x.where(F.col("mi") == M - 1), x.where(F.col("mi") == M), "asset_id", ["size", "momentum"], 0.5, "band"), ["change"])


_CC = """h AS (SELECT *, mi < 23988 AS early FROM factor_ret), k AS (SELECT early, var_samp(f_size) AS ss, covar_samp(f_size, f_mom) AS sm, var_samp(f_mom) AS mm FROM h GROUP BY 1), a AS (SELECT * FROM k WHERE early), b AS (SELECT * FROM k WHERE NOT early)"""


@query("qal02_covariance_changes", "factor_ret", "WITH " + _CC + """
SELECT 'size' AS f1, 'size' AS f2, 'risk' AS "check", ROUND(sqrt(b.ss / a.ss) - 1, 6) AS change FROM a, b WHERE abs(sqrt(b.ss / a.ss) - 1) > 0.01::DOUBLE
UNION ALL SELECT 'momentum', 'momentum', 'risk', ROUND(sqrt(b.mm / a.mm) - 1, 6) FROM a, b WHERE abs(sqrt(b.mm / a.mm) - 1) > 0.01::DOUBLE
UNION ALL SELECT 'momentum', 'size', 'correlation', ROUND(b.sm / sqrt(b.ss * b.mm) - a.sm / sqrt(a.ss * a.mm), 6) FROM a, b WHERE abs(b.sm / sqrt(b.ss * b.mm) - a.sm / sqrt(a.ss * a.mm)) > 0.01::DOUBLE""")
def _(v):
    x = factor_long(v)
    prev, curr = (ag.covariance(x.where(c), "f", "v", "mi") for c in ("mi < 23988", "mi >= 23988"))
    return _r(ql.check_cov(prev, curr, 0.01, 0.01), ["change"])


@query("qal02_min_eigenvalue", "cov2", """
SELECT ROUND((v_ss + v_mm) / 2 - sqrt((v_ss - v_mm)^2 / 4 + v_sm * v_sm), 6) AS min_eigenvalue FROM cov2""")
def _(v):
    return _r(ql.min_eigenvalue(v.cov_long), ["min_eigenvalue"])


@query("qal03_return_checks", "panel", """
WITH x AS (SELECT dt, asset_id, ret, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY ret DESC, asset_id) AS a, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY ret, asset_id) AS b FROM panel WHERE ret IS NOT NULL)
SELECT dt, asset_id, ROUND(ret, 6) AS ret, 'top' AS "check", CAST(a AS DOUBLE) AS rank FROM x WHERE a <= 5 UNION ALL SELECT dt, asset_id, ROUND(ret, 6), 'bottom', CAST(b AS DOUBLE) FROM x WHERE b <= 5 UNION ALL SELECT dt, asset_id, ROUND(ret, 6), 'bound', NULL FROM x WHERE abs(ret) > 0.8::DOUBLE""")
def _(v):
    return _r(ql.check_returns(v.panel, "asset_id", "ret", 0.8, 5, ["dt"]), ["ret"])


@query("qal03_year_to_date", "market", "SELECT region, dt, ROUND(product(1 + mret) OVER (PARTITION BY region, year(dt) ORDER BY dt) - 1, 6) AS ytd FROM market")
def _(v):
    return _r(ql.year_to_date(v.market, "region", "dt", "mret").select("region", "dt", "ytd"), ["ytd"])


@query("qal03_large_moves", "panel", "SELECT asset_id, dt, ROUND(abs(log10(1 + ret)), 6) AS log_move FROM panel WHERE abs(log10(1 + ret)) > CASE WHEN country = 3 THEN 0.04::DOUBLE ELSE 0.15::DOUBLE END")
def _(v):
    return _r(ql.large_moves(v.panel, "ret", "country", 0.15, {3: 0.04}).select("asset_id", "dt", "log_move"), ["log_move"])


_RK = """k AS (SELECT asset_id, mi > 23988 AS late, sqrt(12 * AVG(sret * sret)) AS risk FROM specific GROUP BY 1, 2), a AS (SELECT * FROM k WHERE NOT late), b AS (SELECT * FROM k WHERE late)"""


def _two_risks(v):
    x = stored(v.specific.select("asset_id", "mi", "sret"))
    r = lambda c: x.where(c).groupBy("asset_id").agg(F.sqrt(12 * F.avg(F.col("sret") * F.col("sret"))).alias("risk"))
    return r("mi <= 23988"), r("mi > 23988")


@query("qal04_risk_changes", "specific", "WITH " + _RK + """
SELECT asset_id, CASE WHEN abs(b.risk - a.risk) > 0.3::DOUBLE THEN 'absolute' ELSE 'relative' END AS "check", ROUND(a.risk, 6) AS risk_prev, ROUND(b.risk, 6) AS risk_curr, ROUND(b.risk - a.risk, 6) AS change FROM a JOIN b USING (asset_id)
WHERE abs(b.risk - a.risk) > 0.3::DOUBLE OR abs(b.risk - a.risk) > 0.2::DOUBLE * a.risk""")
def _(v):
    return _r(ql.check_risk(*_two_risks(v), "asset_id", "risk", 0.3, 0.2), ["risk_prev", "risk_curr", "change"])


@query("qal05_low_linked_correlation", "specific")
def _(v):
    return _r(ql.low_correlations(linked_cov(v)["pairs"], 0.9).select("issuer", "id1", "id2", "corr"), ["corr"])


_B2 = "SELECT p.asset_id, regr_slope(p.ret, m.mret) AS beta FROM panel p JOIN market m ON p.region = m.region AND p.mi = m.mi WHERE p.mi {c} 23988 GROUP BY 1"


@query("qal05_beta_discrepancies", "panel market", "WITH a AS (" + _B2.format(c="<=") + "), b AS (" + _B2.format(c=">") + ") SELECT asset_id, ROUND(a.beta, 6) AS beta_a, ROUND(b.beta, 6) AS beta_b, ROUND(a.beta - b.beta, 6) AS difference FROM a JOIN b USING (asset_id) WHERE abs(a.beta - b.beta) > 0.5::DOUBLE")
def _(v):
    x = stored(v.panel.select("asset_id", "region", "mi", "ret").join(v.market.select("region", "mi", "mret"), ["region", "mi"]))
    b = lambda c: x.where(c).groupBy("asset_id").agg(F.regr_slope("ret", "mret").alias("beta"))
    return _r(ql.beta_discrepancies(b("mi <= 23988"), b("mi > 23988"), "asset_id", 0.5), ["beta_a", "beta_b", "difference"])


@query("qal06_basic_checks", "spec_risk", """
SELECT 'no specific risk' AS "check", CAST(s_suppkey AS VARCHAR) AS item FROM supplier WHERE s_suppkey NOT IN (SELECT asset_id FROM spec_risk WHERE nobs > 75) UNION ALL SELECT 'no factor return', 'value'""")
def _(v):
    u = v.supplier.select(F.col("s_suppkey").alias("asset_id"))
    f = v.spark.createDataFrame([("size",), ("momentum",), ("value",)], "factor string")
    return ql.check_basic(u, v.spec_risk.where("nobs > 75"), f, factor_long(v).withColumnRenamed("f", "factor"))


@query("qal06_date_gaps", "sparse", """
WITH l AS (SELECT asset_id, mi, LAG(mi) OVER (PARTITION BY asset_id ORDER BY mi) AS prev FROM sparse) SELECT asset_id, prev AS after, mi AS before, mi - prev - 1 AS n_missing FROM l WHERE mi - prev > 6""")
def _(v):
    return ql.date_gaps(v.sparse, ["asset_id"], "mi").where("n_missing > 5")


@query("qal07_qa_bounds", "market", """
WITH s AS (SELECT region AS code, dt, mret AS value, AVG(mret) OVER w AS mean, stddev_samp(mret) OVER w AS std FROM market WINDOW w AS (PARTITION BY region ORDER BY dt ROWS BETWEEN 36 PRECEDING AND 1 PRECEDING))
SELECT code, dt, ROUND(value, 6) AS value, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, CAST(floor(CASE WHEN code = 1 THEN GREATEST((value - mean) / std, 0) ELSE abs((value - mean) / std) END) AS BIGINT) AS level FROM s WHERE std > 0""")
def _(v):
    x = v.market.select(F.col("region").alias("code"), "dt", F.col("mret").alias("value"))
    return _r(ql.qa_bounds(x, "code", "dt", "value", 36, [1]).where("std > 0"), ["value", "mean", "std"])


_UC = f"""a AS (SELECT asset_id, industry, mcap / SUM(mcap) OVER (PARTITION BY industry) AS w FROM sparse WHERE mi = {M - 1}), b AS (SELECT asset_id, industry, mcap / SUM(mcap) OVER (PARTITION BY industry) AS w FROM sparse WHERE mi = {M})"""


@query("qal08_universe_correlation", "sparse", "WITH " + _UC + """
SELECT COALESCE(a.industry, b.industry) AS industry, ROUND(corr(COALESCE(a.w, 0), COALESCE(b.w, 0)), 6) AS corr, SUM(CASE WHEN a.w IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_joined, SUM(CASE WHEN b.w IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_left FROM a FULL JOIN b ON a.asset_id = b.asset_id AND a.industry = b.industry GROUP BY 1""")
def _(v):
    x = stored(v.sparse.where(F.col("mi").isin(M - 1, M)).select("asset_id", "industry", "mi", "mcap"))
    return _r(ql.universe_correlation(x.where(F.col("mi") == M - 1), x.where(F.col("mi") == M), ["asset_id"], "mcap", ["industry"]), ["corr"])


@query("qal09_descriptor_jumps", "panel")
def _(v):
    x = stored(v.panel.select("asset_id", "mi", "price", "mcap"))
    return _r(ql.descriptor_jumps(x, "asset_id", "mi", "price", "mcap", 0.5, 2.0), ["prev", "price"])


@query("qal10_change_attribution", "panel", f"""
WITH p AS (SELECT * FROM panel WHERE mi = {M - 1}), c AS (SELECT * FROM panel WHERE mi = {M})
SELECT asset_id, ROUND(c.mcap / c.volume - p.mcap / p.volume, 4) AS change, ROUND((c.mcap - p.mcap) / p.volume, 4) AS from_num, ROUND(c.mcap / c.volume - c.mcap / p.volume, 4) AS from_den FROM p JOIN c USING (asset_id)""")
def _(v):
    x = stored(v.panel.where(F.col("mi").isin(M - 1, M)).select("asset_id", "mi", "mcap", "volume"))
    return _r(ql.attribute_change(x.where(F.col("mi") == M - 1), x.where(F.col("mi") == M), ["asset_id"], "mcap", "volume"), ["change", "from_num", "from_den"], 4)


@query("qal11_source_report", "items", """
WITH a AS (SELECT asset_id, dt, value FROM items WHERE item = '1-URGENT'), b AS (SELECT asset_id, dt, value FROM items WHERE item = '2-HIGH')
SELECT CASE WHEN b.value IS NULL THEN 'only_a' WHEN a.value IS NULL THEN 'only_b' WHEN abs(a.value - b.value) > 0.5::DOUBLE * abs(a.value) THEN 'mismatch' ELSE 'match' END AS kind, COUNT(*) AS n FROM a FULL JOIN b ON a.asset_id = b.asset_id AND a.dt = b.dt GROUP BY 1""")
def _(v):
    src = lambda i: v.items.where(F.col("item") == i)
    return ql.source_report(src("1-URGENT"), src("2-HIGH"), ["asset_id", "dt"], "value", 0.5)


@query("qal11_stale_items", "items", "SELECT asset_id, item, MAX(dt) AS last_dt, date_diff('day', MAX(dt), DATE '2001-08-01') AS age FROM items GROUP BY 1, 2 HAVING date_diff('day', MAX(dt), DATE '2001-08-01') > 365")
def _(v):
    return ql.stale_items(v.items, ["asset_id", "item"], "2001-08-01", 365)


@query("qal11_age_distribution", "items", "WITH g AS (SELECT asset_id, item, MAX(dt) AS d FROM items GROUP BY 1, 2) SELECT CAST(floor(date_diff('day', d, DATE '2001-08-01') / 90) AS BIGINT) AS bucket, COUNT(*) AS n FROM g GROUP BY 1")
def _(v):
    return ql.age_distribution(v.items, ["asset_id", "item"], "2001-08-01", 90)


@query("qal12_market_portfolio_report", "panel", f"""
WITH w AS (SELECT mi, region, asset_id, mcap / SUM(mcap) OVER (PARTITION BY mi, region) AS w FROM panel WHERE mi IN ({M - 1}, {M}) AND (mi = {M} OR asset_id % 10 <> 1)), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY mi, region ORDER BY w DESC, asset_id) AS rank FROM w),
j AS (SELECT COALESCE(a.region, b.region) AS region, COALESCE(a.asset_id, b.asset_id) AS asset_id, a.w AS w0, b.w AS w1, a.rank AS r0, b.rank AS r1, COALESCE(b.w, 0) - COALESCE(a.w, 0) AS d FROM (SELECT * FROM r WHERE mi = {M - 1}) a FULL JOIN (SELECT * FROM r WHERE mi = {M}) b ON a.region = b.region AND a.asset_id = b.asset_id),
k AS (SELECT *, CASE WHEN w0 IS NULL AND r1 <= 5 THEN 'joined top' WHEN w0 IS NULL THEN 'joined' WHEN w1 IS NULL THEN 'left' WHEN abs(d) > 0.02::DOUBLE THEN 'jump' WHEN r1 <= 5 THEN 'top' END AS finding FROM j)
SELECT region, asset_id, finding, CAST(r0 - r1 AS DOUBLE) AS rank_change, ROUND(d, 6) AS weight_change FROM k WHERE finding IS NOT NULL""")
def _(v):
    x = v.panel.where(F.col("mi").isin(M - 1, M) & ((F.col("mi") == M) | (F.col("asset_id") % 10 != 1)))
    t = x.groupBy("mi", "region").agg(F.sum("mcap").alias("_t"))
    x = stored(x.join(t, ["mi", "region"]).select("mi", "region", "asset_id", (F.col("mcap") / F.col("_t")).alias("w")))
    return _r(ql.market_portfolio_report(x.where(F.col("mi") == M - 1), x.where(F.col("mi") == M), ["region"], "asset_id", "w", 5, 0.02), ["weight_change"])


@query("qal13_exposure_autocorrelation", "exposures", """
WITH j AS (SELECT a.mi, corr(a.size, b.size) AS size, corr(a.momentum, b.momentum) AS momentum FROM exposures a JOIN exposures b ON a.asset_id = b.asset_id AND a.mi = b.mi + 1 GROUP BY 1)
SELECT mi, factor, ROUND(corr, 6) AS corr FROM (SELECT mi, 'size' AS factor, size AS corr FROM j UNION ALL SELECT mi, 'momentum', momentum FROM j) u""")
def _(v):
    x = stored(v.exposures.select("asset_id", "mi", "size", "momentum"))
    return _r(ql.exposure_autocorrelation(x, "asset_id", "mi", ["size", "momentum"]), ["corr"])


@query("qal14_bias_statistic", "market", """
WITH f AS (SELECT region AS name, mi, sqrt(12 * AVG(mret * mret) OVER (PARTITION BY region ORDER BY mi ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)) AS risk, COUNT(*) OVER k AS n, stddev_samp(mret) OVER k * sqrt(12::DOUBLE) AS realised FROM market WINDOW k AS (PARTITION BY region ORDER BY mi ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING))
SELECT name, mi, ROUND(risk, 6) AS risk, ROUND(realised, 6) AS realised, ROUND(risk / realised, 6) AS ratio FROM f WHERE n = 12""")
def _(v):
    from pyspark.sql import Window as W

    m = v.market.select(F.col("region").alias("name"), "mi", F.col("mret").alias("ret"))
    w = W.partitionBy("name").orderBy("mi").rowsBetween(-23, 0)
    f = m.select("name", "mi", F.sqrt(12 * F.avg(F.col("ret") * F.col("ret")).over(w)).alias("risk"))
    return _r(ql.bias_statistic(f, m, "name", "mi", 12, 12), ["risk", "realised", "ratio"])


@query("qal15_stability", "specific", "WITH " + _RK + " SELECT ROUND(MIN(abs(b.risk / a.risk - 1)), 6) AS min_change, ROUND(AVG(abs(b.risk / a.risk - 1)), 6) AS mean_change, ROUND(MAX(abs(b.risk / a.risk - 1)), 6) AS max_change, COUNT(*) AS n FROM a JOIN b USING (asset_id) WHERE a.risk <> 0")
def _(v):
    return _r(ql.stability(*_two_risks(v), ["asset_id"], "risk"), ["min_change", "mean_change", "max_change"])


@query("qal16_compare_libraries", "exposures", """
SELECT COALESCE(a.mi, b.mi) AS mi, ROUND(corr(a.size, b.turnover), 6) AS size, SUM(CASE WHEN b.mi IS NULL THEN 1 ELSE 0 END)::BIGINT AS only_a, SUM(CASE WHEN a.mi IS NULL THEN 1 ELSE 0 END)::BIGINT AS only_b
FROM (SELECT * FROM exposures WHERE asset_id % 7 <> 0) a FULL JOIN (SELECT * FROM exposures WHERE asset_id % 5 <> 0) b ON a.asset_id = b.asset_id AND a.mi = b.mi GROUP BY 1""")
def _(v):
    x = stored(v.exposures.select("asset_id", "mi", "size", "turnover"))
    return _r(ql.compare_libraries(x.where("asset_id % 7 <> 0"), x.where("asset_id % 5 <> 0"), ["asset_id", "mi"], {"size": "turnover"}, ["mi"]), ["size"])


@query("qal17_id_report", "", """
SELECT 'no industry' AS "check", CAST(p_partkey AS VARCHAR) AS item FROM part WHERE p_size >= 45 UNION ALL SELECT 'no market', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)
UNION ALL SELECT 'ticker clash', p_name FROM part GROUP BY p_name HAVING COUNT(*) > 1""")
def _(v):
    sold = v.lineitem.where("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return ql.id_report(v.part.select("p_partkey", "p_name"), "p_partkey", v.part.where("p_size < 45"), sold, "p_name")


@query("qal18_infer_actions", "", """
WITH m AS (SELECT c_custkey AS id, CAST(floor(c_custkey / 5) AS BIGINT) AS old, CAST(floor(c_custkey / 7) AS BIGINT) AS new FROM customer), e AS (SELECT old, GREATEST(SUM(c_acctbal), 0) AS equity FROM m JOIN customer ON id = c_custkey GROUP BY 1),
k AS (SELECT DISTINCT old, new FROM m), r AS (SELECT k.new, k.old, e.equity, ROW_NUMBER() OVER (PARTITION BY new ORDER BY e.equity DESC, k.old DESC) AS rn, COUNT(*) OVER (PARTITION BY new) AS n FROM k JOIN e USING (old))
SELECT 'merger' AS action, a.new AS company, a.n, CASE WHEN b.equity < 0.75::DOUBLE * a.equity THEN CAST(a.old AS DOUBLE) END AS survivor FROM r a JOIN r b ON a.new = b.new AND a.rn = 1 AND b.rn = 2
UNION ALL SELECT 'spin-off', old, COUNT(*), NULL FROM k GROUP BY old HAVING COUNT(*) > 1""")
def _(v):
    c = v.customer.select(F.col("c_custkey").alias("id"), F.floor(F.col("c_custkey") / 5).alias("company"), "c_acctbal")
    eq = c.groupBy("company").agg(F.greatest(F.sum("c_acctbal"), F.lit(0.0)).alias("equity"))
    now = c.select("id", F.floor(F.col("id") / 7).alias("company"))
    return ql.infer_actions(c, now, "id", "company", eq).withColumn("survivor", F.col("survivor").cast("double"))


@query("qal19_identifier_gaps", "validity", """
WITH l AS (SELECT id, MIN(from_dt) AS a, MAX(CASE WHEN thru_dt < DATE '9999-01-01' THEN thru_dt END) AS b FROM validity GROUP BY id HAVING MAX(CASE WHEN thru_dt < DATE '9999-01-01' THEN thru_dt END) IS NOT NULL),
v AS (SELECT id, from_dt, thru_dt FROM validity WHERE status <> 'O'), g AS (SELECT v.*, MAX(thru_dt) OVER (PARTITION BY id ORDER BY from_dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v),
e AS (SELECT l.id, COALESCE(g.reach, l.a) AS f, g.from_dt AS t, l.b FROM l JOIN g ON l.id = g.id UNION ALL SELECT l.id, COALESCE(MAX(v.thru_dt), l.a), l.b, l.b FROM l LEFT JOIN v ON v.id = l.id GROUP BY l.id, l.a, l.b)
SELECT id, f AS from_dt, LEAST(t, b) AS thru_dt FROM e WHERE f < LEAST(t, b)""")
def _(v):
    life = v.validity.groupBy("id").agg(F.min("from_dt").alias("from_dt"), F.max(F.when(F.col("thru_dt") < F.lit("9999-01-01").cast("date"), F.col("thru_dt"))).alias("thru_dt"))
    return ql.id_gaps(v.validity.where("status <> 'O'"), life.where("thru_dt is not null"), "id")


@query("qal19_identifier_duplicates", "validity", """
WITH i AS (SELECT id - id % 3 AS ticker, id, from_dt, LEAST(thru_dt, from_dt + 60) AS thru_dt FROM validity), e AS (SELECT ticker, d, SUM(s) AS s FROM (SELECT ticker, from_dt AS d, 1 AS s FROM i UNION ALL SELECT ticker, thru_dt, -1 FROM i) u GROUP BY 1, 2 HAVING SUM(s) <> 0),
r AS (SELECT ticker, d AS from_dt, LEAD(d) OVER w AS thru_dt, SUM(s) OVER w AS n FROM e WINDOW w AS (PARTITION BY ticker ORDER BY d)),
k AS (SELECT ticker, from_dt, thru_dt, n, LAG(n) OVER (PARTITION BY ticker ORDER BY from_dt) AS pn FROM r) SELECT ticker, from_dt, thru_dt, CAST(n AS BIGINT) AS n_assets FROM k WHERE n > 1 AND from_dt < thru_dt""")
def _(v):
    ids = v.validity.select((F.col("id") - F.col("id") % 3).alias("ticker"), "id", "from_dt", F.least("thru_dt", F.date_add("from_dt", 60)).alias("thru_dt"))
    return ql.id_duplicates(ids, "ticker", "id")


@query("qal20_benchmark_coverage", "portfolio", f"""
WITH b AS (SELECT name, asset_id, weight FROM portfolio WHERE mi = {M}), u AS (SELECT p_partkey AS asset_id, p_size > 20 AS e FROM part WHERE p_size > 5)
SELECT name, COUNT(*) AS n, SUM(CASE WHEN e IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_outside, ROUND(SUM(CASE WHEN e IS NULL THEN weight ELSE 0 END) / SUM(weight), 6) AS share_outside, SUM(CASE WHEN e IS NULL OR NOT e THEN 1 ELSE 0 END)::BIGINT AS n_not_estu, ROUND(SUM(CASE WHEN e IS NULL OR NOT e THEN weight ELSE 0 END) / SUM(weight), 6) AS share_not_estu FROM b LEFT JOIN u USING (asset_id) GROUP BY 1""")
def _(v):
    u = v.part.where("p_size > 5").select(F.col("p_partkey").alias("asset_id"), (F.col("p_size") > 20).alias("estu"))
    return _r(ql.benchmark_coverage(v.portfolio.where(F.col("mi") == M), u, "name", "asset_id", "weight", "estu"), ["share_outside", "share_not_estu"])


@query("qal21_series_checks", "market", f"""
WITH x AS (SELECT region, mi, mret, abs(mret - LAG(mret) OVER (PARTITION BY region ORDER BY mi)) AS j FROM market WHERE region < 4 AND (region <> 2 OR mi < 23990)), g AS (SELECT region, MAX(mi) AS last, MIN(mret) AS lo, MAX(mret) AS hi, MAX(j) AS j FROM x GROUP BY 1)
SELECT r_regionkey AS region, f AS finding FROM (SELECT r_regionkey, CASE WHEN last IS NULL THEN 'absent' WHEN {M} - last > 3 THEN 'old' WHEN lo < -0.2::DOUBLE OR hi > 0.4::DOUBLE THEN 'range' WHEN j > 0.3::DOUBLE THEN 'jump' END AS f FROM region LEFT JOIN g ON r_regionkey = g.region) q WHERE f IS NOT NULL""")
def _(v):
    s = v.market.where("region < 4 and (region <> 2 or mi < 23990)")
    return ql.check_series(s, "region", "mi", "mret", v.region.select(F.col("r_regionkey").alias("region")), M, 3, -0.2, 0.4, 0.3)


@query("qal22_recheck", "panel", """
SELECT asset_id, dt, 'volume' AS "column" FROM panel WHERE (asset_id + mi) % 50 = 0 AND volume <> 0 UNION ALL SELECT asset_id, dt, 'mcap' FROM panel WHERE asset_id % 40 = 7""")
def _(v):
    x = stored(v.panel.select("asset_id", "dt", "mi", "price", "volume", "mcap"))
    kept = x.withColumn("volume", F.when((F.col("asset_id") + F.col("mi")) % 50 == 0, F.lit(0.0)).otherwise(F.col("volume"))).withColumn("mcap", F.when(F.col("asset_id") % 40 != 7, F.col("mcap")))
    return ql.recheck(kept, x, ["asset_id", "dt"], ["price", "volume", "mcap"])


@query("qal22_recheck_by_digest", "panel", """
SELECT asset_id, dt, 'volume' AS "column" FROM panel WHERE asset_id % 25 = 3 AND volume <> 0""")
def _(v):
    """The panel against one in which some assets' volumes were lost: only their ranges are read again."""
    x = v.panel.select("asset_id", "dt", "price", "volume", "mcap")
    kept = x.withColumn("volume", F.when(F.col("asset_id") % 25 == 3, F.lit(0.0)).otherwise(F.col("volume").cast("double")))
    a, b = scratch(v, "kept"), scratch(v, "source")
    for rows, path in ((kept, a), (x.withColumn("volume", F.col("volume").cast("double")), b)):
        dg.write_digested(rows, ["asset_id"], ["dt", "price", "volume", "mcap"], path)
    found = dg.differing_ranges(v.spark, a, b)
    return ql.recheck(dg.read_ranges(v.spark, a, found), dg.read_ranges(v.spark, b, found), ["asset_id", "dt"], ["price", "volume", "mcap"])
