"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import aggregates as ag, ranks as rk, timeseries as ts
from riskloom.plans.q_base import hazen_sql
from riskloom.plans.registry import query

# Factor series in long form: both factors, every month.
_FS = """fs AS (SELECT mi, 'size' AS f, f_size AS v FROM factor_ret UNION ALL SELECT mi, 'momentum', f_mom FROM factor_ret),
cal AS (SELECT mi, ROW_NUMBER() OVER (ORDER BY mi) AS t, COUNT(*) OVER () AS n FROM (SELECT DISTINCT mi FROM fs) c),
cw AS (SELECT mi, t, n, pow(2.0::DOUBLE, -(n - t) / 24.0::DOUBLE) * n / SUM(pow(2.0::DOUBLE, -(n - t) / 24.0::DOUBLE)) OVER () AS w FROM cal),
mu AS (SELECT f, SUM(w * v) / MAX(n) AS m FROM fs JOIN cw USING (mi) GROUP BY f),
z AS (SELECT f, t, n, sqrt(w) * (v - m) / sqrt(n - 1) AS v FROM fs JOIN cw USING (mi) JOIN mu USING (f)),
c0 AS (SELECT a.f AS f1, b.f AS f2, SUM(a.v * b.v) AS value FROM z a JOIN z b ON a.t = b.t GROUP BY 1, 2),
c1 AS (SELECT a.f AS f1, b.f AS f2, SUM(a.v * b.v) AS value FROM z a JOIN z b ON a.t + 1 = b.t GROUP BY 1, 2)"""


def factor_long(v):
    """Factor returns as rows (mi, f, v)."""
    x = v.factor_ret.select("mi", F.col("f_size").alias("size"), F.col("f_mom").alias("momentum"))
    return x.unpivot(["mi"], ["size", "momentum"], "f", "v")


def _r(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


@query("agg01_weighted_covariance", "factor_ret", "WITH " + _FS + " SELECT f1, f2, ROUND(value, 9) AS value FROM c0")
def _(v):
    return _r(ag.covariance(factor_long(v), "f", "v", "mi", 24.0), ["value"], 9)


@query("agg01_lagged_covariance", "factor_ret", "WITH " + _FS + " SELECT f1, f2, ROUND(value, 9) AS value FROM c1")
def _(v):
    return _r(ag.covariance(factor_long(v), "f", "v", "mi", 24.0, lag=1), ["value"], 9)


@query("agg02_newey_west", "factor_ret", "WITH " + _FS + """ SELECT c0.f1, c0.f2, ROUND(c0.value + 0.5 * (a.value + b.value), 9) AS value FROM c0
JOIN c1 a ON a.f1 = c0.f1 AND a.f2 = c0.f2 JOIN c1 b ON b.f1 = c0.f2 AND b.f2 = c0.f1""")
def _(v):
    return _r(ag.newey_west(factor_long(v), "f", "v", "mi", 1, 24.0), ["value"], 9)


@query("agg03_cov_to_corr", "cov2", """
SELECT 'size' AS f1, 'size' AS f2, 1.0::DOUBLE AS corr UNION ALL SELECT 'momentum', 'momentum', 1.0 UNION ALL SELECT 'size', 'momentum', ROUND(v_sm / sqrt(v_ss * v_mm), 6) FROM cov2 UNION ALL SELECT 'momentum', 'size', ROUND(v_sm / sqrt(v_ss * v_mm), 6) FROM cov2""")
def _(v):
    return _r(ag.to_correlation(v.cov_long), ["corr"])


@query("agg04_time_weights", "panel", """
WITH d AS (SELECT dt, ROW_NUMBER() OVER (ORDER BY dt) AS pos, COUNT(*) OVER () AS n FROM (SELECT DISTINCT dt FROM panel WHERE dt >= DATE '1995-01-01' AND dt < DATE '2000-01-01') q)
SELECT dt, ROUND(pow(2.0::DOUBLE, -(n - pos) / 12.0::DOUBLE), 6) AS w_exp, ROUND(CASE WHEN pos <= 40 THEN pos / 41.0::DOUBLE ELSE (61 - pos) / 20.0::DOUBLE END, 6) AS w_tri,
 ROUND(CASE WHEN pos <= 50 THEN LEAST(1.0::DOUBLE, pos / 9.0::DOUBLE) ELSE (61 - pos) / 10.0::DOUBLE END, 6) AS w_pyr FROM d""")
def _(v):
    from pyspark.sql import Window as W

    d = v.panel.select("dt").distinct().where("dt >= '1995-01-01' and dt < '2000-01-01'")
    d = d.withColumn("pos", F.row_number().over(W.orderBy("dt")))
    w = {"w_exp": ts.exp_weight(F.lit(60) - F.col("pos"), 12), "w_tri": ts.triangle_weight(F.col("pos"), 60, 20), "w_pyr": ts.pyramid_weight(F.col("pos"), 60, 10, 8)}
    return d.select("dt", *[F.round(c, 6).alias(n) for n, c in w.items()])


@query("agg05_hazen_percentiles", "panel", "WITH src AS (SELECT dt, mcap AS x FROM panel), " + hazen_sql({"p5": 5, "p25": 25, "p50": 50, "p95": 95}) + """
SELECT dt, n, ROUND(p5, 4) AS p5, ROUND(p25, 4) AS p25, ROUND(p50, 4) AS p50, ROUND(p95, 4) AS p95 FROM hp""")
def _(v):
    out = rk.percentiles(v.panel, ["dt"], "mcap", {"p5": 5.0, "p25": 25.0, "p50": 50.0, "p95": 95.0})
    return _r(out, ["p5", "p25", "p50", "p95"], 4)


@query("agg05_hazen_of_lines", "", "WITH src AS (SELECT l_returnflag AS k, l_extendedprice AS x FROM lineitem), " + hazen_sql({"p10": 10, "p50": 50, "p90": 90}, "k") + " SELECT k, n, p10, p50, p90 FROM hp")
def _(v):
    x = v.lineitem.select(F.col("l_returnflag").alias("k"), "l_extendedprice")
    return rk.percentiles(x, ["k"], "l_extendedprice", {"p10": 10.0, "p50": 50.0, "p90": 90.0})


@query("agg06_sample_std", "panel", "SELECT asset_id, ROUND(stddev_samp(ret), 6) AS std FROM panel GROUP BY 1")
def _(v):
    return _r(ag.sample_std(v.panel, ["asset_id"], "ret"), ["std"])


_MAD = """med AS (SELECT dt, median(x) AS centre FROM src GROUP BY dt), mad AS (SELECT s.dt, MAX(centre) AS centre, median(abs(x - centre)) / 0.67449::DOUBLE AS scale FROM src s JOIN med USING (dt) GROUP BY s.dt)"""


@query("agg07_mad", "panel", "WITH src AS (SELECT dt, ret AS x FROM panel WHERE ret IS NOT NULL AND ret <> 0), " + _MAD + """
SELECT dt, ROUND(centre, 6) AS centre, ROUND(scale, 6) AS scale, ROUND(centre - 3 * scale, 6) AS lower, ROUND(centre + 3 * scale, 6) AS upper FROM mad""")
def _(v):
    return _r(rk.mad_bounds(v.panel, ["dt"], "ret", 3.0, 0.0), ["centre", "scale", "lower", "upper"])


@query("agg08_iqr_bounds", "panel", "WITH src AS (SELECT dt, ret AS x FROM panel), " + hazen_sql({"q_lo": 25, "q_hi": 75}) + """
SELECT dt, ROUND(q_lo, 6) AS q_lo, ROUND(q_hi, 6) AS q_hi, ROUND(q_lo - 1.5::DOUBLE * (q_hi - q_lo), 6) AS lower, ROUND(q_hi + 1.5::DOUBLE * (q_hi - q_lo), 6) AS upper FROM hp""")
def _(v):
    return _r(ag.iqr_bounds(v.panel, ["dt"], "ret", 1.5), ["q_lo", "q_hi", "lower", "upper"])


@query("agg09_effective_n", "panel", "SELECT dt, region, ROUND(SUM(mcap) * SUM(mcap) / SUM(mcap * mcap), 6) AS eff_n FROM panel GROUP BY 1, 2")
def _(v):
    return _r(ag.effective_n(v.panel, ["dt", "region"], "mcap"), ["eff_n"])


_LOCATION = """x AS (SELECT region, ret AS v, mcap AS w FROM panel WHERE ret IS NOT NULL AND mcap > 0),
c0 AS (SELECT region, SUM(w * v) / SUM(w) AS c, COUNT(*) AS n FROM x GROUP BY 1),
e0 AS (SELECT region, v, w, n, sqrt(w) * (v - c) AS e FROM x JOIN c0 USING (region)), m0 AS (SELECT region, median(e) AS m FROM e0 GROUP BY 1),
s0 AS (SELECT region, median(abs(e - m)) / 0.67449 AS s FROM e0 JOIN m0 USING (region) GROUP BY 1),
c1 AS (SELECT region, n, SUM(w * v * LEAST(1, 1.345 * s / GREATEST(abs(e), 1e-300))) / SUM(w * LEAST(1, 1.345 * s / GREATEST(abs(e), 1e-300))) AS c FROM e0 JOIN s0 USING (region) GROUP BY 1, 2),
e1 AS (SELECT region, v, w, sqrt(w) * (v - c) AS e FROM x JOIN c1 USING (region)), m1 AS (SELECT region, median(e) AS m FROM e1 GROUP BY 1),
s1 AS (SELECT region, median(abs(e - m)) / 0.67449 AS s FROM e1 JOIN m1 USING (region) GROUP BY 1),
b AS (SELECT region, v - c - 1.345 * s / sqrt(w) AS p, -w AS d FROM x JOIN s1 USING (region) JOIN c1 USING (region) UNION ALL SELECT region, v - c + 1.345 * s / sqrt(w), w FROM x JOIN s1 USING (region) JOIN c1 USING (region)),
f AS (SELECT region, SUM(sqrt(w)) * 1.345 * ANY_VALUE(s) AS f FROM x JOIN s1 USING (region) GROUP BY 1),
t AS (SELECT region, p, f + p * SUM(d) OVER r - SUM(d * p) OVER r AS total, SUM(d) OVER r AS fall FROM b JOIN f USING (region) WINDOW r AS (PARTITION BY region ORDER BY p)),
z AS (SELECT region, MAX(p) AS p, arg_max(total, p) AS total, arg_max(fall, p) AS fall FROM t WHERE total >= 0 GROUP BY 1)"""


@query("agg10_robust_average", "panel", "WITH " + _LOCATION + """
SELECT region, ROUND(CASE WHEN n < 2 THEN 0 ELSE c + p - total / fall END, 6) AS average FROM c1 JOIN z USING (region)""")
def _(v):
    return _r(ag.robust_average(v.panel, ["region"], "ret", "mcap"), ["average"])


@query("agg11_average_cap", "sparse", """
SELECT asset_id, dt, ROUND(COALESCE(AVG(c) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), AVG(c) OVER (PARTITION BY asset_id ORDER BY mi RANGE BETWEEN 5 PRECEDING AND 3 PRECEDING)), 4) AS avg_cap
FROM (SELECT *, CASE WHEN volume > 10 THEN mcap END AS c FROM sparse) s""")
def _(v):
    x = v.sparse.withColumn("mcap", F.when(F.col("volume") > 10, F.col("mcap")))
    return _r(ag.average_cap(x, "asset_id", "mcap", 3, "mi").select("asset_id", "dt", "avg_cap"), ["avg_cap"], 4)


_MP = """r AS (SELECT asset_id, dt, c, ROW_NUMBER() OVER w AS rank, SUM(c) OVER w AS run, SUM(c) OVER (PARTITION BY dt) AS tot FROM x WINDOW w AS (PARTITION BY dt ORDER BY c DESC, asset_id ROWS UNBOUNDED PRECEDING))"""


@query("agg12_market_portfolio", "panel", "WITH x AS (SELECT asset_id, dt, CASE WHEN country > 12 THEN mcap * 0.5::DOUBLE ELSE mcap END AS c FROM panel), " + _MP + """
SELECT dt, asset_id, rank, ROUND(c / SUM(c) OVER (PARTITION BY dt), 6) AS weight, c / SUM(c) OVER (PARTITION BY dt) > 0.3::DOUBLE AS heavy FROM r WHERE run - c < 0.85::DOUBLE * tot""")
def _(v):
    x = v.panel.withColumn("foreign", F.col("country") > 12)
    return _r(ag.market_portfolio(x, ["dt"], "asset_id", "mcap", coverage=0.85, foreign="foreign"), ["weight"])


@query("agg12_market_portfolio_top_n", "panel", "WITH x AS (SELECT asset_id, dt, mcap AS c FROM panel), " + _MP + """
SELECT dt, asset_id, rank, ROUND(sqrt(c) / SUM(sqrt(c)) OVER (PARTITION BY dt), 6) AS weight, sqrt(c) / SUM(sqrt(c)) OVER (PARTITION BY dt) > 0.3::DOUBLE AS heavy FROM r WHERE rank <= 10""")
def _(v):
    return _r(ag.market_portfolio(v.panel, ["dt"], "asset_id", "mcap", top_n=10, root=True), ["weight"])


@query("agg13_eligible_market", "", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'type' WHEN p_size < 10 THEN 'exchange' WHEN p_retailprice > 950 AND p_brand = 'Brand#3' THEN 'class' ELSE 'eligible' END AS status FROM part""")
def _(v):
    rules = [("type", F.col("p_type") == "PROMO"), ("exchange", F.col("p_size") < 10), ("class", (F.col("p_retailprice") > 950) & (F.col("p_brand") == "Brand#3"))]
    return ag.eligible_market(v.part, rules).select("p_partkey", "status")


@query("agg14_market_return", "panel", """
SELECT region, dt, ROUND(SUM(lag_mcap * ret) / SUM(lag_mcap), 6) AS mret FROM panel WHERE ret IS NOT NULL GROUP BY region, dt""")
def _(v):
    return v.market.select("region", "dt", F.round("mret", 6).alias("mret"))


@query("agg14_market_return_of_portfolio", "panel", """
WITH w AS (SELECT asset_id, mi + 1 AS mi, region, mcap AS weight FROM panel)
SELECT w.region, w.mi, ROUND(SUM(weight * COALESCE(p.ret, 0)) / SUM(CASE WHEN p.ret IS NOT NULL THEN weight END), 6) AS mret, COUNT(p.ret) AS n FROM w LEFT JOIN panel p ON p.asset_id = w.asset_id AND p.mi = w.mi GROUP BY 1, 2""")
def _(v):
    w = v.panel.select("asset_id", (F.col("mi") + 1).alias("mi"), "region", F.col("mcap").alias("weight"))
    out = ag.market_return(w, v.panel.select("asset_id", "mi", "region", "ret"), ["region", "mi"], "asset_id")
    return _r(out, ["mret"])


@query("agg15_region_return", "panel", "SELECT region, dt, ROUND(SUM(mcap * ret) / SUM(mcap), 6) AS ret FROM panel WHERE ret IS NOT NULL GROUP BY 1, 2")
def _(v):
    return _r(ts.weighted_return(v.panel, ["region", "dt"], "ret", "mcap", "ret"), ["ret"])


@query("agg15_industry_return", "sparse", "SELECT industry, dt, ROUND(SUM(mcap * ret) / SUM(mcap), 6) AS ret FROM sparse WHERE ret IS NOT NULL GROUP BY 1, 2")
def _(v):
    return _r(ts.weighted_return(v.sparse, ["industry", "dt"], "ret", "mcap", "ret"), ["ret"])


@query("agg16_market_vol", "panel", "WITH src AS (SELECT dt, ret AS x FROM panel WHERE ret IS NOT NULL AND ret <> 0), " + _MAD + """
SELECT p.dt, ROUND(CASE WHEN CAST(SUM(CASE WHEN ret <> 0 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) >= 0.1::DOUBLE THEN stddev_samp(CASE WHEN ret IS NOT NULL THEN GREATEST(centre - 3 * scale, LEAST(centre + 3 * scale, ret)) END) END, 6) AS mvol
FROM panel p LEFT JOIN mad ON p.dt = mad.dt GROUP BY p.dt""")
def _(v):
    return _r(ag.market_vol(v.panel, ["dt"], "ret", 3.0), ["mvol"])


@query("agg17_replicate_index", "panel", """
WITH l AS (SELECT asset_id, dt, mcap, volume, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY volume DESC, asset_id) AS liq_rank FROM panel),
c AS (SELECT *, CASE WHEN liq_rank <= 60 THEN ROW_NUMBER() OVER (PARTITION BY dt, liq_rank <= 60 ORDER BY mcap DESC, asset_id) END AS cap_rank FROM l)
SELECT asset_id, dt, liq_rank, CAST(cap_rank AS DOUBLE) AS cap_rank, CASE WHEN cap_rank <= 10 THEN 'core' WHEN cap_rank <= 30 THEN 'large' WHEN cap_rank <= 50 THEN 'mid' ELSE 'small' END AS sub_index FROM c""")
def _(v):
    out = ag.replicate_index(v.panel, ["dt"], "asset_id", "mcap", "volume", 60, [("core", 10), ("large", 30), ("mid", 50)])
    return out.select("asset_id", "dt", "liq_rank", F.col("cap_rank").cast("double").alias("cap_rank"), "sub_index")


#: Name, members, cap pool and volume pool of each stage, scaled to the small market of the panel.
STAGES = [("core", 4, None, 12), ("core", 4, 10, 12), ("large", 10, 20, 30), ("mid", 25, 45, 60), ("broad", 15, 70, 70)]


def _stages_sql() -> str:
    out = ["""b AS (SELECT asset_id, dt, asset_id % 11 <> 0 AS base, CASE WHEN asset_id % 11 <> 0 THEN mcap * (1 + asset_id % 3) ELSE 0 END AS worth, volume FROM panel),
s0 AS (SELECT asset_id, dt, base, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY worth DESC, asset_id) AS c, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY volume DESC, asset_id) AS v, CAST(NULL AS VARCHAR) AS s FROM b)"""]
    for i, (name, n, caps, volumes) in enumerate(STAGES):
        free = f"s IS NULL AND v <= {volumes}"
        both = free + (f" AND c <= {caps}" if caps else "")
        out.append(f"t{i} AS (SELECT *, {both} AS e, ({both}) AND ROW_NUMBER() OVER (PARTITION BY dt, {both} ORDER BY c) <= {n} AS take FROM s{i})")
        out.append(f"u{i} AS (SELECT *, {n} - SUM(CAST(take AS INT)) OVER (PARTITION BY dt) AS short, {free} AND NOT take AS alt FROM t{i})")
        out.append(f"s{i + 1} AS (SELECT asset_id, dt, base, c, v, CASE WHEN take OR (alt AND ROW_NUMBER() OVER (PARTITION BY dt, alt ORDER BY v) <= short) THEN '{name}' ELSE s END AS s FROM u{i})")
    return "WITH " + ",\n".join(out) + f" SELECT asset_id, dt, c AS cap_rank, v AS vol_rank, COALESCE(s, CASE WHEN base THEN 'small' END) AS sub_index FROM s{len(STAGES)}"


@query("agg17_subindexes", "panel", _stages_sql())
def _(v):
    x = v.panel.select("asset_id", "dt", "mcap", "volume", (F.col("asset_id") % 11 != 0).alias("base"), (F.col("mcap") * (1 + F.col("asset_id") % 3)).alias("float_cap"))
    out = ag.replicate_subindexes(x, ["dt"], "asset_id", "mcap", "volume", STAGES, "base", "float_cap")
    return out.select("asset_id", "dt", "cap_rank", "vol_rank", "sub_index")


@query("agg18_annual_dividends", "", """
WITH x AS (SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS d, SUM(o_totalprice) AS a FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-30' AND CAST(o_orderdate AS DATE) >= DATE '1998-06-30' - 440 GROUP BY 1, 2),
l AS (SELECT id, MAX(d) AS last FROM x GROUP BY id),
s AS (SELECT x.id, CASE WHEN date_diff('day', l.last, DATE '1998-06-30') > 60 THEN DATE '1998-06-30' - 380
 WHEN MAX(CASE WHEN date_diff('day', d, l.last) BETWEEN 350 AND 380 OR date_diff('day', d, l.last) BETWEEN 290 AND 320 THEN 1 ELSE 0 END) = 1 THEN GREATEST(DATE '1998-06-30' - 380, l.last - 350) ELSE l.last - 320 END AS f
 FROM x JOIN l ON x.id = l.id GROUP BY x.id, l.last)
SELECT x.id, ROUND(SUM(a), 2) AS dividends FROM x JOIN s ON x.id = s.id WHERE d >= f GROUP BY 1""")
def _(v):
    div = v.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("date").alias("ex_dt"), F.col("o_totalprice").alias("amount"))
    div = div.groupBy("id", "ex_dt").agg(F.sum("amount").alias("amount"))
    return _r(ag.annual_dividends(div, "id", "1998-06-30"), ["dividends"], 2)


@query("agg19_descriptor_stats", "descr", "WITH src AS (SELECT dt, CASE WHEN asset_id % 6 <> 0 THEN mom_raw END AS x FROM descr), " + hazen_sql({"p5": 5, "p95": 95}) + """,
a AS (SELECT dt, COUNT(*) AS n_assets, COUNT(x) AS n_values, CAST(COUNT(x) AS DOUBLE) / COUNT(*) AS share, SUM(CASE WHEN x IS NOT NULL THEN mcap ELSE 0 END) / SUM(mcap) AS cap_share, AVG(x) AS mean, stddev_samp(x) AS std
 FROM (SELECT dt, mcap, CASE WHEN asset_id % 6 <> 0 THEN mom_raw END AS x FROM descr) d GROUP BY dt)
SELECT a.dt, n_assets, n_values, ROUND(share, 6) AS share, ROUND(cap_share, 6) AS cap_share, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, ROUND(p5, 6) AS p5, ROUND(p95, 6) AS p95 FROM a LEFT JOIN hp ON a.dt = hp.dt""")
def _(v):
    x = v.descr.withColumn("x", F.when(F.col("asset_id") % 6 != 0, F.col("mom_raw")))
    return _r(ag.descriptor_stats(x, ["dt"], "x", "mcap", {"p5": 5.0, "p95": 95.0}), ["share", "cap_share", "mean", "std", "p5", "p95"])


@query("agg19_churn_correlation", "exposures", """
SELECT a.mi, ROUND(corr(a.momentum, b.momentum), 6) AS corr, COUNT(*) AS n FROM exposures a JOIN exposures b ON a.asset_id = b.asset_id AND a.mi = b.mi + 1 GROUP BY 1""")
def _(v):
    return _r(ag.churn_correlation(v.exposures, "asset_id", "momentum", "mi"), ["corr"])


@query("agg20_dual_histogram", "panel", """
WITH u AS (SELECT mcap AS x, region < 2 AS s FROM panel WHERE region < 2 OR region > 2), l AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM u),
b AS (SELECT LEAST(19, CAST(floor((x - lo) / (hi - lo) * 20) AS BIGINT)) AS bin, s FROM u, l)
SELECT bin, SUM(CASE WHEN s THEN 1 ELSE 0 END)::BIGINT AS n_a, SUM(CASE WHEN s THEN 0 ELSE 1 END)::BIGINT AS n_b FROM b GROUP BY 1""")
def _(v):
    return ag.dual_histogram(v.panel.where("region < 2"), v.panel.where("region > 2"), "mcap", 20)


@query("agg21_demographics", "panel", """
WITH g AS (SELECT dt, country, COUNT(*) AS n, SUM(mcap) AS cap, SUM(mcap * mcap) AS c2 FROM panel GROUP BY GROUPING SETS ((dt, country), (dt)))
SELECT g.dt, CAST(g.country AS DOUBLE) AS country, g.n, ROUND(g.cap, 2) AS cap, ROUND(g.cap / t.cap, 6) AS share, ROUND(g.cap * g.cap / g.c2, 6) AS eff_n FROM g JOIN (SELECT dt, SUM(mcap) AS cap FROM panel GROUP BY dt) t ON g.dt = t.dt""")
def _(v):
    out = ag.demographics(v.panel.withColumn("country", F.col("country").cast("double")), ["dt"], ["country"], "mcap")
    return _r(_r(out, ["share", "eff_n"]), ["cap"], 2)


@query("agg22_dummies", "panel", "SELECT asset_id, dt, " + ", ".join(f"CASE WHEN region = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS r{i}" for i in range(5)) + " FROM panel")
def _(v):
    return ag.dummies(v.panel, "region", list(range(5)), "r").select("asset_id", "dt", *[f"r{i}" for i in range(5)])


@query("agg23_top_n_weights", "sparse", """
WITH i AS (SELECT dt, issuer, ROUND(SUM(mcap), 2) AS cap FROM sparse GROUP BY 1, 2), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY cap DESC, issuer) AS rank FROM i)
SELECT dt, issuer, rank, ROUND(sqrt(cap) / SUM(sqrt(cap)) OVER (PARTITION BY dt), 6) AS weight FROM r WHERE rank <= 25""")
def _(v):
    i = v.sparse.groupBy("dt", "issuer").agg(F.round(F.sum("mcap"), 2).alias("cap"))
    return _r(ag.top_n_weights(i, ["dt"], "issuer", "cap", 25), ["weight"])


@query("agg24_free_float", "panel", """
SELECT p.asset_id, p.dt, p.mcap * COALESCE(ff, 1.0::DOUBLE) * CASE WHEN p.country = 3 THEN 0.2::DOUBLE WHEN p.country = 7 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS mcap
FROM panel p LEFT JOIN (SELECT s_suppkey, (s_suppkey % 10 + 1) / 10.0::DOUBLE AS ff FROM supplier WHERE s_acctbal > 0) s ON p.asset_id = s.s_suppkey""")
def _(v):
    ff = v.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("asset_id"), ((F.col("s_suppkey") % 10 + 1) / 10.0).alias("free_float"))
    out = ag.down_weight(ag.free_float(v.panel, ff, "asset_id", "mcap"), {3: 0.2, 7: 0.5}, "country", "mcap")
    return out.select("asset_id", "dt", "mcap")


@query("agg25_asset_age", "validity", "SELECT id, MIN(from_dt) AS first_dt, CAST(date_diff('day', MIN(from_dt), DATE '2001-12-31') AS INTEGER) AS age FROM validity GROUP BY 1")
def _(v):
    return ag.asset_age(v.validity, "id", "2001-12-31")
