"""Sources, sinks, projections and cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.functions import columns as fc
from riskloom.operators import bitemporal as bt, digests as dg, cleaning as cl, timeseries as ts
from riskloom.plans.registry import query
from riskloom.plans.views import Views
from riskloom.session import shared_dir
from riskloom.sources import extracts as ex, flatfiles as ff

STYLES = ["size", "momentum", "volatility", "turnover"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def scratch(v: Views, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{shared_dir(v.spark)}/{name}-{uuid.uuid4().hex}"


@query("src01_active", "revisions", """
SELECT id, dt, rev_dt, line, part, value FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY id, dt ORDER BY rev_dt DESC, line DESC, part DESC, value DESC, rev_del_flag DESC) AS rn FROM revisions) r
WHERE rn = 1 AND rev_del_flag = 'N'""")
def _(v):
    return bt.active(v.revisions, ["id", "dt"], then=["line", "part", "value"]).drop("rev_del_flag")


@query("src02_as_of_item", "revisions", """
SELECT id, dt, rev_dt, value FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY id, dt ORDER BY rev_dt DESC, line DESC, part DESC, rev_del_flag DESC, value DESC) AS rn
 FROM revisions WHERE rev_dt <= DATE '1998-06-30') r WHERE rn = 1 AND rev_del_flag = 'N'""")
def _(v):
    return bt.as_of_item(v.revisions, ["id", "dt"], "1998-06-30", "rev_dt", "rev_del_flag").select("id", "dt", "rev_dt", "value")


@query("src03_active_classification", "revisions", """
SELECT id, dt, scheme, r_name, rev_dt, value FROM (
 SELECT *, part % 5 AS scheme, ROW_NUMBER() OVER (PARTITION BY id, dt, part % 5 ORDER BY rev_dt DESC, line DESC, part DESC, rev_del_flag DESC, value DESC) AS rn
 FROM revisions) r JOIN region ON scheme = r_regionkey WHERE rn = 1 AND rev_del_flag = 'N'""")
def _(v):
    const = v.revisions.withColumn("scheme", F.col("part") % 5)
    ref = v.region.select(F.col("r_regionkey").alias("scheme"), "r_name")
    return bt.active_classification(const, ref, ["id", "dt"], "scheme").select("id", "dt", "scheme", "r_name", "rev_dt", "value")


@query("src04_to_intervals", "", """
SELECT id, status, from_dt, thru_dt FROM (
 SELECT *, COALESCE(LEAD(from_dt) OVER (PARTITION BY id ORDER BY from_dt), DATE '9999-12-31') AS thru_dt FROM (
  SELECT o_custkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS from_dt, MAX(o_orderstatus) AS status FROM orders GROUP BY 1, 2) o) i
WHERE status <> 'P'""")
def _(v):
    m = F.trunc(F.col("o_orderdate").cast("date"), "month")
    o = v.orders.groupBy(F.col("o_custkey").alias("id"), m.alias("change_dt")).agg(F.max("o_orderstatus").alias("status"))
    o = o.withColumn("del", F.when(F.col("status") == "P", "Y").otherwise("N"))
    return bt.to_intervals(o, ["id"], "change_dt", "del").select("id", "status", "from_dt", "thru_dt")


@query("src05_valid_on", "items validity", """
SELECT i.asset_id AS id, i.item, i.dt, v.status, v.from_dt, v.thru_dt FROM items i JOIN validity v
ON i.asset_id = v.id AND v.from_dt <= i.dt AND i.dt < v.thru_dt""")
def _(v):
    d = v.items.select(F.col("asset_id").alias("id"), "item", "dt")
    return bt.valid_on(d, v.validity.drop("value"), ["id"], first_year=1990, last_year=2010)


@query("src06_id_history", "validity", """
SELECT v.id, v.status, s.nation, GREATEST(v.from_dt, s.from_dt) AS from_dt, LEAST(v.thru_dt, s.thru_dt) AS thru_dt
FROM validity v JOIN (SELECT o_custkey AS id, MIN(CAST(o_orderdate AS DATE)) AS from_dt, MAX(CAST(o_orderdate AS DATE)) AS thru_dt, MAX(c_nationkey) AS nation
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) s ON v.id = s.id
WHERE GREATEST(v.from_dt, s.from_dt) < LEAST(v.thru_dt, s.thru_dt)""")
def _(v):
    d = F.col("o_orderdate").cast("date")
    life = v.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.min(d).alias("from_dt"), F.max(d).alias("thru_dt"))
    home = v.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    return bt.id_history(v.validity.drop("value"), life.join(home, "id"), "id")


@query("src07_find_updates", "revisions", """
WITH life AS (SELECT id, MIN(rev_dt) AS from_dt, MAX(rev_dt) AS thru_dt FROM revisions GROUP BY id)
SELECT DISTINCT r.id, r.dt, r.rev_dt, r.line, r.part, r.value, r.rev_del_flag FROM revisions r JOIN life l ON r.id = l.id
WHERE r.rev_dt = DATE '1998-03-02' OR l.from_dt = DATE '1998-03-02' OR (l.thru_dt = DATE '1998-03-02' AND r.dt >= DATE '1998-03-02')""")
def _(v):
    life = v.revisions.groupBy("id").agg(F.min("rev_dt").alias("from_dt"), F.max("rev_dt").alias("thru_dt"))
    return bt.find_updates(v.revisions, life, "id", "dt", "rev_dt", "1998-03-02")


_TWO_YEARS = """
WITH s AS (SELECT asset_id, item, ROUND(SUM(value), 2) AS value FROM items WHERE year(dt) = 1997 GROUP BY 1, 2),
t AS (SELECT asset_id, item, ROUND(SUM(value), 2) AS value FROM items WHERE year(dt) = 1996 GROUP BY 1, 2)"""


def _year(v, y) -> DataFrame:
    return v.items.where(F.year("dt") == y).groupBy("asset_id", "item").agg(F.round(F.sum("value"), 2).alias("value"))


@query("src08_table_diff", "items", _TWO_YEARS + """
SELECT COALESCE(s.asset_id, t.asset_id) AS asset_id, COALESCE(s.item, t.item) AS item,
 CASE WHEN t.asset_id IS NULL THEN 'insert' WHEN s.asset_id IS NULL THEN 'terminate' ELSE 'update' END AS action,
 t.value AS old_value, s.value AS new_value
FROM s FULL JOIN t ON s.asset_id = t.asset_id AND s.item = t.item WHERE s.value IS DISTINCT FROM t.value""")
def _(v):
    return bt.table_diff(_year(v, 1997), _year(v, 1996), ["asset_id", "item"], "value")


@query("src08_digest_diff", "items", _TWO_YEARS + """
SELECT COALESCE(s.asset_id, t.asset_id) AS asset_id, COALESCE(s.item, t.item) AS item,
 CASE WHEN t.asset_id IS NULL THEN 'insert' WHEN s.asset_id IS NULL THEN 'terminate' ELSE 'update' END AS action,
 t.value AS old_value, s.value AS new_value
FROM s FULL JOIN t ON s.asset_id = t.asset_id AND s.item = t.item WHERE s.value IS DISTINCT FROM t.value""")
def _(v):
    src, tgt = scratch(v, "digest-src"), scratch(v, "digest-tgt")
    for y, path in ((1997, src), (1996, tgt)):
        dg.write_digested(_year(v, y), ["asset_id", "item"], ["value"], path, ranges=32, fan=4)
    return dg.digest_diff(v.spark, src, tgt, ["asset_id", "item"], "value", fan=4)


@query("src09_revisions_to_write", "items", _TWO_YEARS + """
SELECT COALESCE(s.asset_id, t.asset_id) AS asset_id, COALESCE(s.item, t.item) AS item, s.value, DATE '1998-01-02' AS rev_dt,
 CASE WHEN s.asset_id IS NULL THEN 'Y' ELSE 'N' END AS rev_del_flag
FROM s FULL JOIN t ON s.asset_id = t.asset_id AND s.item = t.item WHERE s.value IS DISTINCT FROM t.value""")
def _(v):
    stored = _year(v, 1996).withColumn("rev_dt", F.lit("1997-01-02").cast("date")).withColumn("rev_del_flag", F.lit("N"))
    return bt.revisions_to_write(_year(v, 1997), stored, ["asset_id", "item"], "value", "1998-01-02")


@query("src09_write_revisions", "items", """
WITH y AS (SELECT asset_id, item, year(dt) AS y, ROUND(SUM(value), 2) AS value FROM items WHERE year(dt) BETWEEN 1995 AND 1997 GROUP BY 1, 2, 3),
a AS (SELECT asset_id, item, MAX(CASE WHEN y = 1995 THEN value END) AS a, MAX(CASE WHEN y = 1996 THEN value END) AS b, MAX(CASE WHEN y = 1997 THEN value END) AS c FROM y GROUP BY 1, 2)
SELECT asset_id, item, a AS value, DATE '1995-01-02' AS rev_dt, 'N' AS rev_del_flag FROM a WHERE a IS NOT NULL
UNION ALL SELECT asset_id, item, b, DATE '1996-01-02', CASE WHEN b IS NULL THEN 'Y' ELSE 'N' END FROM a WHERE b IS DISTINCT FROM a
UNION ALL SELECT asset_id, item, c, DATE '1997-01-02', CASE WHEN c IS NULL THEN 'Y' ELSE 'N' END FROM a WHERE c IS DISTINCT FROM b""")
def _(v):
    """Three years written one after another, each twice as by a job that runs again."""
    fields = v.items.schema
    table = bt.revision_table(v.spark, scratch(v, "revision-table"), [fields["asset_id"], fields["item"]], T.StructField("value", T.DoubleType()))
    for y in (1995, 1996, 1997):
        for _ in range(2):
            bt.write_revisions(_year(v, y), table, ["asset_id", "item"], "value", f"{y}-01-02", dt="rev_dt")
    return table.read().drop("year")


@query("src10_sync_cumulative", "panel", """
SELECT p.asset_id, p.dt, p.price * (s.mcap / s.price) AS price FROM panel p JOIN panel s ON p.asset_id = s.asset_id AND s.dt = DATE '1998-06-01'
WHERE p.dt <= DATE '1998-06-01' AND abs(s.mcap / s.price - 1) >= 1e-9""")
def _(v):
    src = v.panel.select("asset_id", "dt", F.col("mcap").alias("price"))
    return bt.sync_cumulative(src, v.panel.select("asset_id", "dt", "price"), "asset_id", "dt", "price", "1998-06-01")


@query("src11_flat_file", "", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(v):
    path = scratch(v, "flat")
    df = v.supplier.select("s_suppkey", "s_name", "s_acctbal")
    ff.write_flat(df, path, {"s_suppkey": "INTEGER", "s_acctbal": "NUMBER"})
    return ff.read_flat(v.spark, path)


@query("src11_flat_text", "", r"""
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '' WHEN doc_id % 7 = 2 THEN '#' || text ELSE text END AS text, n_chars FROM documents""")
def _(v):
    """Whole texts with line ends and separators, null and empty, written and read back."""
    path = scratch(v, "flat-text")
    i = F.col("doc_id") % 7
    text = F.when(i == 0, None).when(i == 1, "").when(i == 2, F.concat(F.lit("#"), "text")).otherwise(F.col("text"))
    ff.write_flat(v.documents.select("doc_id", text.alias("text"), "n_chars"), path, {"doc_id": "INTEGER", "n_chars": "INTEGER"})
    return ff.read_flat(v.spark, path)


@query("src12_exposure_triplets", "exposures", """
SELECT asset_id, dt, factor, value FROM (UNPIVOT exposures ON size, momentum, volatility, turnover INTO NAME factor VALUE value) u WHERE value IS NOT NULL""")
def _(v):
    return ex.exposure_triplets(v.exposures, ["asset_id", "dt"], STYLES)


@query("src12_exposure_wide", "exposures", """
SELECT asset_id, dt, size, momentum, volatility, turnover FROM exposures""")
def _(v):
    path = scratch(v, "triplets")
    long = ex.exposure_triplets(v.exposures, ["asset_id", "dt"], STYLES)
    long.write.parquet(path)
    return ex.exposure_wide(v.spark.read.parquet(path), ["asset_id", "dt"], STYLES)


@query("src12_exposure_compact", "exposures", """
SELECT asset_id, dt, 'style' AS factor_type, CASE GREATEST(size, momentum, turnover, volatility)
 WHEN volatility THEN 'volatility' WHEN turnover THEN 'turnover' WHEN size THEN 'size' ELSE 'momentum' END AS factor FROM exposures""")
def _(v):
    long = ex.exposure_triplets(v.exposures, ["asset_id", "dt"], STYLES).withColumn("factor_type", F.lit("style"))
    return ex.exposure_compact(long, ["asset_id", "dt"])


@query("src13_covariance_square", "cov2", """
SELECT 'momentum' AS f1, ROUND(v_mm, 6) AS momentum, ROUND(v_sm, 6) AS size FROM cov2 UNION ALL SELECT 'size', ROUND(v_sm, 6), ROUND(v_ss, 6) FROM cov2""")
def _(v):
    return ex.square(v.cov_long.withColumn("value", F.round("value", 6)), ["momentum", "size"])


@query("src14_correlation", "cov2", """
SELECT f1, f2, ROUND(c / sqrt(a * b), 6) AS corr, ROUND(a, 6) AS variance, ROUND(sqrt(a), 6) AS risk FROM (
 SELECT 'size' AS f1, 'size' AS f2, v_ss AS c, v_ss AS a, v_ss AS b FROM cov2 UNION ALL SELECT 'size', 'momentum', v_sm, v_ss, v_mm FROM cov2
 UNION ALL SELECT 'momentum', 'size', v_sm, v_mm, v_ss FROM cov2 UNION ALL SELECT 'momentum', 'momentum', v_mm, v_mm, v_mm FROM cov2) x""")
def _(v):
    return ex.correlation(v.cov_long).select("f1", "f2", *[F.round(c, 6).alias(c) for c in ("corr", "variance", "risk")])


@query("src15_identifier_map", "validity", """
SELECT c.c_custkey AS id, a.status AS status_id, b.status AS seg_id FROM customer c
LEFT JOIN validity a ON a.id = c.c_custkey AND a.from_dt <= DATE '1998-01-15' AND DATE '1998-01-15' < a.thru_dt
LEFT JOIN (SELECT id, concat(status, '-', CAST(floor(value) AS BIGINT)) AS status, from_dt, thru_dt FROM validity) b ON b.id = c.c_custkey AND b.from_dt <= DATE '1998-01-15' AND DATE '1998-01-15' < b.thru_dt""")
def _(v):
    h1 = v.validity.select("id", F.col("status").alias("value"), "from_dt", "thru_dt")
    h2 = v.validity.select("id", F.concat_ws("-", "status", F.floor("value")).alias("value"), "from_dt", "thru_dt")
    return ex.identifier_map(v.customer.select(F.col("c_custkey").alias("id")), {"status_id": h1, "seg_id": h2}, "id", "1998-01-15")


def _on(v, d):
    d = F.lit(d).cast("date")
    return v.validity.where((F.col("from_dt") <= d) & (d < F.col("thru_dt"))).select("id", "status", "value")


@query("src16_identifier_updates", "validity", """
SELECT id, status, value FROM validity WHERE from_dt <= DATE '1998-02-15' AND DATE '1998-02-15' < thru_dt
EXCEPT SELECT id, status, value FROM validity WHERE from_dt <= DATE '1998-01-15' AND DATE '1998-01-15' < thru_dt""")
def _(v):
    return ex.identifier_updates(_on(v, "1998-01-15"), _on(v, "1998-02-15"), "id", ["status", "value"])


FX_SQL = """fx AS (SELECT country AS ccy, dt, mi, SUM(mcap) / SUM(volume) AS px FROM panel GROUP BY 1, 2, 3),
rates AS (SELECT f.ccy, f.dt, f.mi, f.px / n.px AS rate FROM fx f JOIN fx n ON n.dt = f.dt AND n.ccy = 0),
rf AS (SELECT country AS ccy, dt, mi, ROUND(AVG(ret) / 20, 9) AS rf FROM panel WHERE ret IS NOT NULL GROUP BY 1, 2, 3)"""


def fx_rates(v) -> DataFrame:
    """Country price levels against country 0 as currency rates."""
    fx = v.panel.groupBy(F.col("country").alias("ccy"), "dt", "mi").agg((F.sum("mcap") / F.sum("volume")).alias("px"))
    num = fx.where("ccy = 0").select("dt", F.col("px").alias("_n"))
    return fx.join(num, "dt").select("ccy", "dt", "mi", (F.col("px") / F.col("_n")).alias("rate"))


def rf_rates(v) -> DataFrame:
    """A small rate per country and month, a twentieth of its mean return."""
    return v.panel.where("ret is not null").groupBy(F.col("country").alias("ccy"), "dt", "mi").agg(F.round(F.avg("ret") / 20, 9).alias("rf"))


@query("src17_currency_rates", "panel", "WITH " + FX_SQL + """
SELECT r.ccy, r.dt, ROUND(r.rate, 6) AS rate, ROUND(f.rf, 6) AS rf, ROUND(EXP(SUM(ln(1 + f.rf)) OVER (PARTITION BY r.ccy ORDER BY r.dt)), 6) AS cum_rf
FROM rates r LEFT JOIN rf f ON r.ccy = f.ccy AND r.dt = f.dt""")
def _(v):
    rf = ts.cumulative(rf_rates(v).drop("mi"), ["ccy"], "rf", "cum_rf")
    out = ex.currency_rates(fx_rates(v).drop("mi"), rf)
    # months before the first rate have none
    return out.select("ccy", "dt", *[F.round(c, 6).alias(c) for c in ("rate", "rf", "cum_rf")])


@query("src18_factor_history", "factor_ret", "SELECT dt, ROUND(f_size, 6) AS size, ROUND(f_mom, 6) AS momentum FROM factor_ret")
def _(v):
    long = v.factor_ret.withColumnsRenamed({"f_size": "size", "f_mom": "momentum"}).unpivot(["dt"], ["size", "momentum"], "factor", "value")
    return ex.factor_history(long.withColumn("value", F.round("value", 6)), ["size", "momentum"])


@query("src19_hierarchy", "", """
SELECT n_name AS leaf, r_name AS level_1, 'WORLD' AS level_2 FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _(v):
    n = v.nation.join(v.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
    r = v.region.select(F.col("r_name").alias("child"), F.lit("WORLD").alias("parent"))
    return ex.hierarchy(n.unionByName(r), 2)


@query("src20_asset_attributes", "panel", """
SELECT asset_id, dt, price, mcap, ROUND(AVG(volume) OVER (PARTITION BY asset_id ORDER BY dt ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS adv,
 ROUND(ret, 6) AS ret, COALESCE(price = LAG(price) OVER (PARTITION BY asset_id ORDER BY dt), false) AS rolled FROM panel""")
def _(v):
    return ex.asset_attributes(v.panel, 3).withColumn("adv", F.round("adv", 6)).withColumn("ret", F.round("ret", 6))


@query("src23_complete_composites", "portfolio", """
SELECT issuer, asset_id FROM (SELECT DISTINCT issuer, asset_id FROM sparse) s
WHERE issuer NOT IN (SELECT CAST(floor(p_partkey / 4) AS BIGINT) FROM part WHERE p_size > 40)""")
def _(v):
    members = v.sparse.select("issuer", "asset_id").distinct()
    mapped = v.part.where("p_size <= 40").select(F.col("p_partkey").alias("asset_id"))
    return ex.complete_composites(members, mapped, "issuer", "asset_id").select("issuer", "asset_id")


@query("src24_benchmark", "portfolio", """
SELECT p.name, p.asset_id, p.dt, ROUND(CASE WHEN p.asset_id % 7 = 0 THEN 0.01 ELSE p.weight END, 9) AS weight FROM portfolio p WHERE p.asset_id % 11 <> 0
UNION ALL SELECT p_brand, 1000000000 + p_partkey, DATE '1998-01-01', 0.005 FROM part WHERE p_partkey % 11 = 1""")
def _(v):
    p = v.portfolio.select("name", "asset_id", "dt", "weight")
    rep = p.where("asset_id % 7 = 0 and asset_id % 11 <> 0").select("name", "asset_id", "dt", F.lit("replace").alias("action"), F.lit(0.01).alias("weight"))
    rem = p.where("asset_id % 11 = 0").select("name", "asset_id", "dt", F.lit("remove").alias("action"), F.lit(None).cast("double").alias("weight"))
    add = v.part.where("p_partkey % 11 = 1").select(
        F.col("p_brand").alias("name"), (F.col("p_partkey") + 1000000000).alias("asset_id"), F.lit("1998-01-01").cast("date").alias("dt"), F.lit("add").alias("action"), F.lit(0.005).alias("weight")
    )
    return ex.benchmark(p, rep.unionByName(rem).unionByName(add), ["name", "asset_id", "dt"]).withColumn("weight", F.round("weight", 9))


@query("src25_trading_calendar", "", """
SELECT r.r_regionkey AS region, CAST(d.dt AS DATE) AS dt, t.dt IS NOT NULL AS trading FROM region r, (SELECT unnest(generate_series(DATE '1998-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS dt) d
LEFT JOIN (SELECT DISTINCT n_regionkey AS region, CAST(l_shipdate AS DATE) AS dt FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity > 45) t
 ON t.region = r.r_regionkey AND t.dt = CAST(d.dt AS DATE)""")
def _(v):
    place = v.supplier.join(v.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_regionkey").alias("region"))
    day = F.col("l_shipdate").cast("date").alias("dt")
    # one row per supplier and day before the join: the join carries distinct days only
    sold = v.lineitem.where("l_quantity > 45").select(F.col("l_suppkey").alias("s_suppkey"), day).distinct()
    return ex.trading_calendar(v.region.select(F.col("r_regionkey").alias("region")), sold.join(place, "s_suppkey"), "region", "1998-01-01", "1998-12-31")


@query("src26_period_returns", "panel", """
WITH q AS (SELECT asset_id, dt, price FROM panel WHERE month(dt) IN (3, 6, 9, 12)),
r AS (SELECT asset_id, dt, price / LAG(price) OVER (PARTITION BY asset_id ORDER BY dt) - 1 AS ret FROM q)
SELECT asset_id, dt, ROUND(ret, 6) AS ret FROM r WHERE ret IS NOT NULL""")
def _(v):
    cum = ts.cumulative(v.panel.select("asset_id", "dt", "ret"), ["asset_id"], "ret", "cum")
    dates = v.panel.where(F.month("dt").isin(3, 6, 9, 12)).select("dt")
    return ex.period_returns(cum, dates).withColumn("ret", F.round("ret", 6))


@query("src27_market_caps", "panel", """
SELECT country, dt, ROUND(SUM(mcap), 2) AS mcap, COUNT(*) AS n, ROUND(SUM(mcap * ret) / SUM(CASE WHEN ret IS NOT NULL THEN mcap END), 6) AS ret FROM panel GROUP BY country, dt""")
def _(v):
    live = F.when(F.col("ret").isNotNull(), F.col("mcap"))
    return v.panel.groupBy("country", "dt").agg(
        F.round(F.sum("mcap"), 2).alias("mcap"), F.count("*").alias("n"), F.round(F.sum(F.col("mcap") * F.col("ret")) / F.sum(live), 6).alias("ret")
    )


@query("src29_curve_exposures", "items", """
SELECT asset_id, dt, ROUND(SUM(CASE WHEN item = '1-URGENT' THEN value ELSE 0 END) / SUM(value), 6) AS n1, ROUND(SUM(CASE WHEN item = '3-MEDIUM' THEN value ELSE 0 END) / SUM(value), 6) AS n3,
 ROUND(SUM(CASE WHEN item = '5-LOW' THEN value ELSE 0 END) / SUM(value), 6) AS n5 FROM items GROUP BY asset_id, dt""")
def _(v):
    # cash-flow share of each curve node as its exposure
    share = lambda k, n: F.round(F.sum(F.when(F.col("item") == k, F.col("value")).otherwise(0.0)) / F.sum("value"), 6).alias(n)
    return v.items.groupBy("asset_id", "dt").agg(share("1-URGENT", "n1"), share("3-MEDIUM", "n3"), share("5-LOW", "n5"))


for _name, _layout in ex.LAYOUTS.items():
    query(f"src30_layout_{_name}", "panel", "SELECT " + ", ".join(f'{"ROUND(ret, 6)" if c == "ret" else c} AS "{h}"' for c, h in _layout) + " FROM panel")(
        lambda v, lay=_layout: ex.with_layout(v.panel.withColumn("ret", F.round("ret", 6)), lay)
    )


@query("src31_factor_library", "exposures", """
SELECT asset_id, dt, format('{:,.4f}', size) AS "Size", format('{:,.4f}', momentum * 100) AS "Momentum pct" FROM exposures""")
def _(v):
    return ex.factor_library(v.exposures, {"size": "Size", "momentum": "Momentum pct"}, ["momentum"])


@query("src32_fundamental_extract", "items", """
SELECT asset_id, MAX(CASE WHEN item = '1-URGENT' THEN value END) AS "1-URGENT", MAX(CASE WHEN item = '2-HIGH' THEN value END) AS "2-HIGH", MAX(CASE WHEN item = '3-MEDIUM' THEN value END) AS "3-MEDIUM",
 MAX(CASE WHEN item = '4-NOT SPECIFIED' THEN value END) AS "4-NOT SPECIFIED", MAX(CASE WHEN item = '5-LOW' THEN value END) AS "5-LOW"
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY asset_id, item ORDER BY eff_dt DESC) AS rn FROM items WHERE eff_dt <= DATE '1998-01-01') i WHERE rn = 1 GROUP BY asset_id""")
def _(v):
    return ex.fundamental_extract(v.items, PRIORITIES, "1998-01-01")


@query("src33_table_extract", "panel", "SELECT asset_id, dt, price, volume, mcap, country FROM panel WHERE dt = DATE '1998-05-01' AND country = 3")
def _(v):
    return ex.table_extract(v.panel.select("asset_id", "dt", "price", "volume", "mcap", "country"), "1998-05-01", "country", 3)


@query("src34_rekey", "items validity", """
SELECT i.item, i.dt, i.value, concat(v.status, '-', v.id) AS model_id FROM items i JOIN validity v ON i.asset_id = v.id AND v.from_dt <= i.dt AND i.dt < v.thru_dt""")
def _(v):
    m = v.validity.select(F.col("id").alias("asset_id"), F.concat_ws("-", "status", "id").alias("model_id"), "from_dt", "thru_dt")
    return ex.rekey(v.items.select("asset_id", "item", "dt", "value"), m, "asset_id", "model_id")


@query("src35_curve_history", "items", """
SELECT asset_id AS curve, dt, MAX(CASE WHEN item = '1-URGENT' THEN value END) AS "1-URGENT", MAX(CASE WHEN item = '5-LOW' THEN value END) AS "5-LOW"
FROM items WHERE item IN ('1-URGENT', '5-LOW') GROUP BY 1, 2""")
def _(v):
    return ex.curve_history(v.items.select(F.col("asset_id").alias("curve"), "dt", F.col("item").alias("node"), "value"), ["1-URGENT", "5-LOW"])


# --- projections, filters, cleaning -------------------------------------------------------


@query("fil01_screen", "", "SELECT event_id, CASE WHEN value >= 5 AND value <= 90 THEN value END AS value FROM events")
def _(v):
    x = v.events.select("event_id", F.when(F.col("value") < 5, F.lit(float("nan"))).when(F.col("value") > 90, F.lit(float("inf"))).otherwise(F.col("value")).alias("value"))
    return cl.screen(x, ["value"])


@query("fil02_mask_by_from", "panel", """
SELECT p.asset_id, p.dt, CASE WHEN p.dt <= f.d THEN NULL ELSE ROUND(COALESCE(p.ret, 0), 6) END AS ret FROM panel p
JOIN (SELECT asset_id, MIN(dt) AS d FROM panel WHERE volume > 100 GROUP BY 1) f ON p.asset_id = f.asset_id""")
def _(v):
    first = v.panel.where("volume > 100").groupBy("asset_id").agg(F.min("dt").alias("from_dt"))
    x = v.panel.join(first, "asset_id", "left_semi").select("asset_id", "dt", F.round("ret", 6).alias("ret"))
    return cl.mask_by_from(x, first, "asset_id", "ret", mask_first=True)


@query("fil03_ipo_dates", "validity", """
SELECT id, CASE WHEN id % 10 = 0 THEN GREATEST(MIN(from_dt), DATE '1996-06-01') ELSE MIN(from_dt) END AS from_dt FROM validity GROUP BY id""")
def _(v):
    spac = v.customer.where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("id"), F.lit("1996-06-01").cast("date").alias("eff_dt"))
    return cl.ipo_dates(v.validity, "id", spac)


@query("fil04_clip_extrema", "panel", """
WITH s AS (SELECT dt, COALESCE(ret, 0) AS x, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY COALESCE(ret, 0)) - 1 AS rn, COUNT(*) OVER (PARTITION BY dt) AS n FROM panel),
b AS (SELECT dt, MAX(CASE WHEN rn = c THEN x END) AS lo, MAX(CASE WHEN rn = n - c - 1 THEN x END) AS hi FROM (SELECT *, LEAST(100, CAST(round_even(n * CAST(0.05 AS DOUBLE), 0) AS BIGINT)) AS c FROM s) t GROUP BY dt)
SELECT asset_id, p.dt, ROUND(CASE WHEN ret IS NOT NULL THEN GREATEST(lo, LEAST(hi, ret)) END, 6) AS ret FROM panel p JOIN b ON p.dt = b.dt""")
def _(v):
    return cl.clip_extrema(v.panel.select("asset_id", "dt", "ret"), "ret", 0.05, ["dt"]).withColumn("ret", F.round("ret", 6))


@query("fil05_symmetric_clip", "panel", """
SELECT asset_id, dt, ROUND(EXP(GREATEST(-(ln(CAST(11 AS DOUBLE)) - 1), LEAST(ln(CAST(11 AS DOUBLE)) - 1, ln(1 + ret) - 1)) + 1) - 1, 6) AS ret FROM panel""")
def _(v):
    return v.panel.select("asset_id", "dt", F.round(fc.symmetric_clip(F.col("ret"), 10.0), 6).alias("ret"))


@query("fil06_round_half_away", "panel", """
SELECT asset_id, dt, CASE WHEN abs(CASE WHEN abs(ret) < CAST(0.1 AS DOUBLE) THEN 0 ELSE sign(ret) * floor(abs(ret) * 100 + 0.5) / 100 END) < CAST(0.1 AS DOUBLE) THEN 0
 ELSE sign(ret) * floor(abs(ret) * 100 + 0.5) / 100 END AS ret FROM panel WHERE ret IS NOT NULL""")
def _(v):
    return v.panel.where("ret is not null").select("asset_id", "dt", fc.round_half_away(F.col("ret"), 2).alias("ret"))


@query("fil07_blend", "panel", """
WITH a AS (SELECT * FROM panel WHERE asset_id % 3 <> 0), b AS (SELECT * FROM panel WHERE asset_id % 5 <> 0),
j AS (SELECT COALESCE(a.asset_id, b.asset_id) AS asset_id, COALESCE(a.dt, b.dt) AS dt, a.price AS o, b.price * 2 AS n FROM a FULL JOIN b ON a.asset_id = b.asset_id AND a.dt = b.dt),
k AS (SELECT *, 1.0::DOUBLE - date_diff('day', DATE '1996-01-01', dt)::DOUBLE / date_diff('day', DATE '1996-01-01', DATE '1998-01-01') AS r FROM j)
SELECT asset_id, dt, CASE WHEN dt < DATE '1996-01-01' THEN o WHEN dt > DATE '1998-01-01' THEN n ELSE COALESCE(o, n) * r + (1 - r) * COALESCE(n, o) END AS price FROM k""")
def _(v):
    p = v.panel.select("asset_id", "dt", "price")
    new = p.where("asset_id % 5 <> 0").withColumn("price", F.col("price") * 2)
    return cl.blend(p.where("asset_id % 3 <> 0"), new, ["asset_id", "dt"], "price", "dt", "1996-01-01", "1998-01-01")


@query("fil08_is_binary", "", "SELECT l_returnflag AS factor, COUNT(DISTINCT l_linestatus) <= 2 AS is_binary FROM lineitem GROUP BY 1")
def _(v):
    return cl.is_binary(v.lineitem.select(F.col("l_returnflag").alias("factor"), "l_linestatus"), ["factor"], "l_linestatus")


@query("fil09_non_empty", "sparse", "SELECT asset_id, CAST(SUM(CASE WHEN ret IS NOT NULL AND ret <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_values FROM sparse GROUP BY 1 HAVING SUM(CASE WHEN ret IS NOT NULL AND ret <> 0 THEN 1 ELSE 0 END) > 0")
def _(v):
    return cl.non_empty(v.sparse, ["asset_id"], "ret", zeros_missing=True)


@query("fil10_by_asset_type", "", "SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'S%' OR p_type LIKE 'PRO%'")
def _(v):
    return cl.by_type(v.part.select("p_partkey", "p_type"), "p_type", include=["S", "PRO"], prefix=True)


@query("fil11_by_market_type", "", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def _(v):
    return cl.by_type(v.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", exclude=["BUILDING", "MACHINERY"])


@query("fil12_by_home_country", "", """
SELECT s_suppkey AS asset_id FROM supplier WHERE s_acctbal < 1000 OR s_nationkey IN (1, 2, 3)""")
def _(v):
    s = v.supplier.select(F.col("s_suppkey").alias("asset_id"), F.col("s_nationkey").alias("code"), "s_acctbal")
    return cl.by_classification(s.select("asset_id"), s.where("s_acctbal >= 1000"), "asset_id", "code", [1, 2, 3])


@query("fil13_apply_exclusions", "panel validity", """
SELECT p.asset_id, p.dt, p.mcap FROM panel p WHERE NOT EXISTS (SELECT 1 FROM validity v WHERE v.id = p.asset_id AND v.status = 'P' AND v.from_dt <= p.dt AND p.dt < v.thru_dt)""")
def _(v):
    x = v.validity.where("status = 'P'").select(F.col("id").alias("asset_id"), "from_dt", "thru_dt")
    return cl.apply_exclusions(v.panel.select("asset_id", "dt", "mcap"), x, "asset_id", "dt")


_SCORES = """sc AS (SELECT asset_id, CAST(COUNT(ret) AS DOUBLE) / 83 AS nm, CAST(SUM(CASE WHEN ret > 0 THEN 1 ELSE 0 END) AS DOUBLE) / 15 AS nz FROM sparse GROUP BY 1)"""


def _scores(v):
    return v.sparse.groupBy("asset_id").agg(
        (F.count("ret").cast("double") / 83).alias("nm"), (F.sum(F.when(F.col("ret") > 0, 1).otherwise(0)).cast("double") / 15).alias("nz")
    )


@query("fil14_drop_sparse", "sparse", "WITH " + _SCORES + " SELECT asset_id, nm, nz FROM sc WHERE GREATEST(0, LEAST(1, nm + nz - 1)) >= CAST(0.05 AS DOUBLE)")
def _(v):
    return cl.drop_sparse(_scores(v), "nm", "nz", 0.05)


@query("fil14_drop_sparse_two_floors", "sparse", "WITH " + _SCORES + " SELECT asset_id FROM sc WHERE nm >= CAST(0.2 AS DOUBLE) AND nz >= CAST(0.25 AS DOUBLE)")
def _(v):
    return cl.drop_sparse_two_floors(_scores(v), "nm", "nz", 0.2, 0.25).select("asset_id")


HAZEN_SQL = """hz AS (SELECT dt, x, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY x) - 1 AS rn, COUNT(*) OVER (PARTITION BY dt) AS n FROM src WHERE x IS NOT NULL)"""


def hazen_sql(points: dict[str, float], key: str = "dt") -> str:
    """SQL for Hazen percentiles of the CTE ``src(key, x)``: CTEs ``hz`` and ``hp``."""
    cols = []
    for name, p in points.items():
        pos = f"GREATEST(0, LEAST({p}::DOUBLE * n / 100 - 0.5, n - 1))"
        lo, hi = f"floor({pos})", f"LEAST(floor({pos}) + 1, n - 1)"
        cols.append(
            f"MAX(CASE WHEN rn = {lo} THEN x END) + MAX({pos} - {lo}) * (MAX(CASE WHEN rn = {hi} THEN x END) - MAX(CASE WHEN rn = {lo} THEN x END)) AS {name}"
        )
    return HAZEN_SQL.replace("dt", key) + f", hp AS (SELECT {key}, MAX(n) AS n, {', '.join(cols)} FROM hz GROUP BY {key})"


@query("fil15_filter_by_score", "panel", "WITH src AS (SELECT dt, mcap AS x FROM panel), " + hazen_sql({"lo": 25, "hi": 95}) + """
SELECT asset_id, p.dt, mcap FROM panel p JOIN hp ON p.dt = hp.dt WHERE mcap BETWEEN lo AND hi""")
def _(v):
    return cl.filter_by_score(v.panel.select("asset_id", "dt", "mcap"), "mcap", 25.0, 95.0, ["dt"]).select("asset_id", "dt", "mcap")


@query("fil16_exclude_rows", "panel", "SELECT asset_id, dt, price FROM panel WHERE NOT (asset_id % 5 = 0 AND month(dt) = 6)")
def _(v):
    bad = v.panel.where("asset_id % 5 = 0 and month(dt) = 6").select("asset_id", "dt")
    return cl.exclude_rows(v.panel.select("asset_id", "dt", "price"), bad, ["dt", "asset_id"])


@query("fil17_prune", "", "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'FURNITURE'))")
def _(v):
    use = v.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("kind"))
    return cl.prune(v.orders.select("o_custkey", "o_orderkey"), use, "o_custkey", ["AUTOMOBILE", "FURNITURE"])


@query("fil18_is_cash", "", "SELECT p_partkey, starts_with(p_name, 'small') AS is_cash FROM part")
def _(v):
    return v.part.select("p_partkey", fc.is_cash(F.col("p_name"), "small").alias("is_cash"))


@query("fil19_rmg_status", "panel", """
WITH m AS (SELECT country, dt, DATE '1996-01-01' + CAST(country * 30 AS INTEGER) AS full_dt, DATE '2000-06-01' + CAST(country * 20 AS INTEGER) AS fade_dt FROM panel GROUP BY country, dt),
d AS (SELECT *, date_diff('day', dt, full_dt) AS a, date_diff('day', fade_dt, dt) AS b FROM m)
SELECT country, dt, ROUND(CASE WHEN a > 0 AND a <= abs(b) THEN pow(2.0::DOUBLE, -LEAST(a, 480) / 30.0::DOUBLE) WHEN b >= 0 AND abs(a) > b THEN pow(2.0::DOUBLE, -b / 60.0::DOUBLE) ELSE 1 END, 6) AS weight FROM d""")
def _(v):
    m = v.panel.select("country", "dt").distinct()
    m = m.withColumn("full_dt", F.date_add(F.lit("1996-01-01").cast("date"), F.col("country") * 30)).withColumn("fade_dt", F.date_add(F.lit("2000-06-01").cast("date"), F.col("country") * 20))
    return cl.rmg_status(m, "dt").select("country", "dt", F.round("weight", 6).alias("weight"))


@query("fil19_cap_market_share", "panel", """
WITH m AS (SELECT dt, country, SUM(mcap) AS m FROM panel GROUP BY 1, 2), t AS (SELECT dt, SUM(mcap) AS t FROM panel GROUP BY 1)
SELECT p.asset_id, p.dt, ROUND(p.mcap * LEAST(1, 0.05::DOUBLE * (t.t - m.m) / (m.m * (1.0::DOUBLE - 0.05::DOUBLE))), 2) AS mcap FROM panel p JOIN m ON p.dt = m.dt AND p.country = m.country JOIN t ON p.dt = t.dt""")
def _(v):
    return cl.cap_market_share(v.panel.select("asset_id", "dt", "country", "mcap"), "country", "mcap", 0.05, 1.0, ["dt"]).select("asset_id", "dt", F.round("mcap", 2).alias("mcap"))


@query("fil20_factors_on", "validity", """
WITH live AS (SELECT DISTINCT id FROM validity WHERE status = 'F' AND from_dt <= DATE '1998-01-15' AND DATE '1998-01-15' < thru_dt), used AS (SELECT DISTINCT l_suppkey AS id FROM lineitem)
SELECT COALESCE(l.id, u.id) AS id, CASE WHEN l.id IS NULL THEN 'dead' WHEN u.id IS NULL THEN 'unused' ELSE 'ok' END AS status FROM live l FULL JOIN used u ON l.id = u.id""")
def _(v):
    used = v.lineitem.select(F.col("l_suppkey").alias("id"))
    return cl.factors_on(v.validity.where("status = 'F'"), used, "id", "1998-01-15")
