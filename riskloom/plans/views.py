"""Views that the queries start from, as DataFrames and as matching SQL text.

Every view first reduces the fact table to one row per business key with map-side
aggregation, so a hot supplier, part or order cannot overload a task, and so each key's
series holds at most one row per month.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from riskloom.operators import fundamentals as fu, timeseries as ts
from riskloom.session import cut
from riskloom.functions.columns import div

SQL_VIEWS: dict[str, tuple[str, str]] = {
    # name: (views it needs, text)
    "panel": (
        "",
        """SELECT asset_id, dt, mi, mcap, volume, n, price, country, region,
  price / LAG(price) OVER (PARTITION BY asset_id ORDER BY dt) - 1 AS ret,
  LAG(mcap) OVER (PARTITION BY asset_id ORDER BY dt) AS lag_mcap
FROM (SELECT l_suppkey AS asset_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS dt,
    CAST(12 * year(date_trunc('month', l_shipdate)) + month(date_trunc('month', l_shipdate)) AS BIGINT) AS mi,
    ROUND(SUM(l_extendedprice), 2) AS mcap, SUM(l_quantity) AS volume, COUNT(*) AS n,
    ROUND(SUM(l_extendedprice), 2) / SUM(l_quantity) AS price
  FROM lineitem GROUP BY 1, 2, 3) p
JOIN (SELECT s_suppkey, s_nationkey AS country, n_regionkey AS region
      FROM supplier JOIN nation ON s_nationkey = n_nationkey) s ON p.asset_id = s.s_suppkey""",
    ),
    "sparse": (
        "",
        """SELECT asset_id, dt, mi, mcap, volume, price, p_brand AS industry, p_type AS asset_type,
  CAST(floor(asset_id / 4) AS BIGINT) AS issuer,
  price / LAG(price) OVER (PARTITION BY asset_id ORDER BY dt) - 1 AS ret
FROM (SELECT l_partkey AS asset_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS dt,
    CAST(12 * year(date_trunc('month', l_shipdate)) + month(date_trunc('month', l_shipdate)) AS BIGINT) AS mi,
    ROUND(SUM(l_extendedprice), 2) AS mcap, SUM(l_quantity) AS volume,
    ROUND(SUM(l_extendedprice), 2) / SUM(l_quantity) AS price
  FROM lineitem GROUP BY 1, 2, 3) p JOIN part ON p.asset_id = p_partkey""",
    ),
    "market": (
        "panel",
        """SELECT region, dt, mi, SUM(lag_mcap * ret) / SUM(lag_mcap) AS mret
FROM panel WHERE ret IS NOT NULL GROUP BY region, dt, mi""",
    ),
    "world": (
        "panel",
        """SELECT dt, mi, SUM(lag_mcap * ret) / SUM(lag_mcap) AS wret
FROM panel WHERE ret IS NOT NULL GROUP BY dt, mi""",
    ),
    "revisions": (
        "",
        """SELECT l_orderkey AS id, CAST(o_orderdate AS DATE) AS dt, CAST(l_shipdate AS DATE) AS rev_dt,
  l_linenumber AS line, l_partkey AS part, l_extendedprice AS value,
  CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS rev_del_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "items": (
        "",
        """SELECT o_custkey AS asset_id, o_orderpriority AS item,
  CAST(date_trunc('quarter', o_orderdate) AS DATE) AS dt,
  CAST(4 * year(o_orderdate) + quarter(o_orderdate) AS BIGINT) AS qi,
  ROUND(SUM(o_totalprice), 2) AS value,
  CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL 135 DAY AS DATE) AS eff_dt
FROM orders GROUP BY 1, 2, 3, 4""",
    ),
    "quarters": (
        "",
        """SELECT o_custkey AS asset_id, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS dt,
  CAST(4 * year(o_orderdate) + quarter(o_orderdate) AS BIGINT) AS qi,
  ROUND(SUM(o_totalprice), 2) AS sales, ROUND(SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS income,
  ROUND(SUM(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS debt,
  CAST(COUNT(*) AS DOUBLE) AS shares
FROM orders GROUP BY 1, 2, 3""",
    ),
    "validity": (
        "",
        """SELECT id, from_dt, COALESCE(LEAD(from_dt) OVER (PARTITION BY id ORDER BY from_dt), DATE '9999-12-31') AS thru_dt, status, value
FROM (SELECT o_custkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS from_dt,
        MAX(o_orderstatus) AS status, ROUND(SUM(o_totalprice), 2) AS value
      FROM orders GROUP BY 1, 2) o""",
    ),
    "descr": (
        "panel",
        """SELECT asset_id, dt, mi, mcap, country, region, ret, size_raw, mom_raw, vol_raw, turn_raw FROM (
 SELECT asset_id, dt, mi, mcap, country, region, ret,
  ROUND(ln(mcap), 12) AS size_raw,
  ROUND(price / LAG(price, 6) OVER w - 1, 12) AS mom_raw,
  ROUND(sqrt(AVG(ret * ret) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)), 12) AS vol_raw,
  ROUND(ln(volume / AVG(volume) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)), 12) AS turn_raw
 FROM panel WINDOW w AS (PARTITION BY asset_id ORDER BY dt)) d
WHERE mom_raw IS NOT NULL AND ret IS NOT NULL""",
    ),
    "exposures": (
        "descr",
        """SELECT d.asset_id, d.dt, d.mi, d.mcap, sqrt(d.mcap) AS root_cap, d.country, d.region, d.ret,
 ROUND((size_raw - m1) / s1, 12) AS size, ROUND((mom_raw - m2) / s2, 12) AS momentum,
 ROUND((vol_raw - m3) / s3, 12) AS volatility, ROUND((turn_raw - m4) / s4, 12) AS turnover
FROM descr d JOIN (
 SELECT d.dt, m1, m2, m3, m4, sqrt(SUM((size_raw - m1)^2) / (COUNT(*) - 1)) AS s1,
  sqrt(SUM((mom_raw - m2)^2) / (COUNT(*) - 1)) AS s2, sqrt(SUM((vol_raw - m3)^2) / (COUNT(*) - 1)) AS s3,
  sqrt(SUM((turn_raw - m4)^2) / (COUNT(*) - 1)) AS s4
 FROM descr d JOIN (SELECT dt, SUM(mcap * size_raw) / SUM(mcap) AS m1, SUM(mcap * mom_raw) / SUM(mcap) AS m2,
   SUM(mcap * vol_raw) / SUM(mcap) AS m3, SUM(mcap * turn_raw) / SUM(mcap) AS m4 FROM descr GROUP BY dt) m ON d.dt = m.dt
 GROUP BY d.dt, m1, m2, m3, m4 HAVING COUNT(*) > 1) s ON d.dt = s.dt""",
    ),
    "factor_ret": (
        "exposures",
        """SELECT dt, mi, (sxy * syy_ - syz * sxz) / (sxx * syy_ - sxz * sxz) AS f_size,
  (syz * sxx - sxy * sxz) / (sxx * syy_ - sxz * sxz) AS f_mom
FROM (SELECT dt, mi, SUM(root_cap * size * size) AS sxx, SUM(root_cap * momentum * momentum) AS syy_,
  SUM(root_cap * size * momentum) AS sxz, SUM(root_cap * size * ret) AS sxy, SUM(root_cap * momentum * ret) AS syz
  FROM exposures GROUP BY dt, mi HAVING COUNT(*) > 2) c""",
    ),
    "specific": (
        "exposures factor_ret",
        """SELECT e.asset_id, e.dt, e.mi, e.mcap, e.country, e.region, e.size, e.momentum, e.root_cap, e.ret,
  e.ret - e.size * f.f_size - e.momentum * f.f_mom AS sret
FROM exposures e JOIN factor_ret f ON e.dt = f.dt""",
    ),
    "cov2": (
        "factor_ret",
        """SELECT 12 * var_samp(f_size) AS v_ss, 12 * covar_samp(f_size, f_mom) AS v_sm, 12 * var_samp(f_mom) AS v_mm FROM factor_ret""",
    ),
    "spec_risk": (
        "specific",
        """SELECT asset_id, 12 * SUM(sret * sret) / COUNT(*) AS svar, COUNT(*) AS nobs FROM specific GROUP BY asset_id HAVING COUNT(*) > 2""",
    ),
    "latest_exp": (
        "exposures",
        """SELECT e.* FROM exposures e WHERE e.dt = (SELECT MAX(dt) FROM exposures)""",
    ),
    "portfolio": (
        "sparse",
        """SELECT industry AS name, asset_id, dt, mi, mcap,
  mcap / SUM(mcap) OVER (PARTITION BY industry, dt) AS weight FROM sparse""",
    ),
    "holdings": (
        "latest_exp",
        """SELECT country AS name, region, asset_id, mcap / SUM(mcap) OVER (PARTITION BY country) AS weight FROM latest_exp""",
    ),
}


def with_views(names: list[str], body: str) -> str:
    """``WITH`` text holding the named views and whatever they need, then ``body``."""
    done: dict[str, str] = {}

    def visit(n: str) -> None:
        if n in done:
            return
        needs, text = SQL_VIEWS[n]
        for d in needs.split():
            visit(d)
        done[n] = f"{n} AS MATERIALIZED ({text})"

    for n in names:
        visit(n)
    body = body.strip()
    if not done:
        return body
    head = "WITH " + ",\n".join(done.values())
    if body[:5].upper() == "WITH ":
        return head + ",\n" + body[5:]
    return head + "\n" + body


class Views:
    """The views of one data folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        """A stored table, timestamps without zone."""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in {
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        }:
            return self.table(name)
        raise AttributeError(name)

    def _monthly(self, key: str) -> DataFrame:
        month = F.trunc(F.col("l_shipdate").cast("date"), "month")
        return (
            self.table("lineitem")
            .groupBy(F.col(key).alias("asset_id"), month.alias("dt"))
            .agg(
                F.round(F.sum("l_extendedprice"), 2).alias("mcap"),
                F.sum("l_quantity").alias("volume"),
                F.count("*").alias("n"),
                (div(F.round(F.sum("l_extendedprice"), 2), F.sum("l_quantity"))).alias("price"),
            )
            .withColumn("mi", ts.month_index("dt"))
        )

    @cached_property
    def panel(self) -> DataFrame:
        """One row per supplier and month."""
        places = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select(F.col("s_suppkey").alias("asset_id"), F.col("s_nationkey").alias("country"), F.col("n_regionkey").alias("region"))
        w = W.partitionBy("asset_id").orderBy("dt")
        return (
            self._monthly("l_suppkey")
            .join(places, "asset_id")
            .withColumn("ret", div(F.col("price"), F.lag("price").over(w)) - 1)
            .withColumn("lag_mcap", F.lag("mcap").over(w))
        )

    @cached_property
    def sparse(self) -> DataFrame:
        """One row per part and month, with gaps; four parts make an issuer."""
        kinds = self.table("part").select(
            F.col("p_partkey").alias("asset_id"), F.col("p_brand").alias("industry"), F.col("p_type").alias("asset_type")
        )
        w = W.partitionBy("asset_id").orderBy("dt")
        return (
            self._monthly("l_partkey")
            .drop("n")
            .join(kinds, "asset_id")
            .withColumn("issuer", F.floor(F.col("asset_id") / 4))
            .withColumn("ret", div(F.col("price"), F.lag("price").over(w)) - 1)
        )

    @cached_property
    def market(self) -> DataFrame:
        """Regional market return."""
        return ts.weighted_return(self.panel, ["region", "dt", "mi"], "ret", "lag_mcap", "mret")

    @cached_property
    def world(self) -> DataFrame:
        """Return over all regions."""
        return ts.weighted_return(self.panel, ["dt", "mi"], "ret", "lag_mcap", "wret")

    @cached_property
    def revisions(self) -> DataFrame:
        """Order lines as revisions of a value per order and order date."""
        o = self.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("dt"))
        li = self.table("lineitem").select(
            F.col("l_orderkey").alias("id"),
            F.col("l_shipdate").cast("date").alias("rev_dt"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("part"),
            F.col("l_extendedprice").alias("value"),
            F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("rev_del_flag"),
        )
        return li.join(o, "id")

    @cached_property
    def items(self) -> DataFrame:
        """Quarterly item values per customer, known 135 days after the quarter starts."""
        q = F.trunc(F.col("o_orderdate").cast("date"), "quarter")
        return (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("asset_id"), F.col("o_orderpriority").alias("item"), q.alias("dt"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
            .withColumn("qi", fu.quarter_index("dt"))
            .withColumn("eff_dt", F.date_add("dt", 135))
        )

    @cached_property
    def quarters(self) -> DataFrame:
        """Quarterly sales, income, debt and share count per customer."""
        q = F.trunc(F.col("o_orderdate").cast("date"), "quarter")
        v, s = F.col("o_totalprice"), F.col("o_orderstatus")
        return (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("asset_id"), q.alias("dt"))
            .agg(
                F.round(F.sum(v), 2).alias("sales"),
                F.round(F.sum(F.when(s == "F", v).otherwise(0.0)), 2).alias("income"),
                F.round(F.sum(F.when(s == "O", v).otherwise(0.0)), 2).alias("debt"),
                F.count("*").cast("double").alias("shares"),
            )
            .withColumn("qi", fu.quarter_index("dt"))
        )

    @cached_property
    def validity(self) -> DataFrame:
        """Half-open intervals per customer from the months with an order."""
        m = F.trunc(F.col("o_orderdate").cast("date"), "month")
        o = self.table("orders").groupBy(F.col("o_custkey").alias("id"), m.alias("from_dt")).agg(
            F.max("o_orderstatus").alias("status"), F.round(F.sum("o_totalprice"), 2).alias("value")
        )
        w = W.partitionBy("id").orderBy("from_dt")
        return o.withColumn("thru_dt", F.coalesce(F.lead("from_dt").over(w), F.lit("9999-12-31").cast("date")))

    @cached_property
    def descr(self) -> DataFrame:
        """Raw descriptors on the supplier panel."""
        w = W.partitionBy("asset_id").orderBy("dt")
        year = w.rowsBetween(-11, 0)
        return (
            self.panel.select(
                "asset_id", "dt", "mi", "mcap", "country", "region", "ret",
                F.round(F.log("mcap"), 12).alias("size_raw"),
                F.round(div(F.col("price"), F.lag("price", 6).over(w)) - 1, 12).alias("mom_raw"),
                F.round(F.sqrt(F.avg(F.col("ret") * F.col("ret")).over(year)), 12).alias("vol_raw"),
                F.round(F.log(div(F.col("volume"), F.avg("volume").over(year))), 12).alias("turn_raw"),
            )
            .where("mom_raw is not null and ret is not null")
        )

    @cached_property
    def exposures(self) -> DataFrame:
        """Descriptors standardised per month, cap-weighted mean and equal-weighted scale."""
        raw = {"size": "size_raw", "momentum": "mom_raw", "volatility": "vol_raw", "turnover": "turn_raw"}
        # sums of squares about the weighted mean need the mean first: two small aggregates
        mean = self.descr.groupBy("dt").agg(
            *[(div(F.sum(F.col("mcap") * F.col(c)), F.sum("mcap"))).alias(f"m_{n}") for n, c in raw.items()]
        )
        d = self.descr.join(mean, "dt")
        std = d.groupBy("dt").agg(
            F.count("*").alias("_n"),
            *[
                F.sqrt(div(F.sum((F.col(c) - F.col(f"m_{n}")) * (F.col(c) - F.col(f"m_{n}"))), F.count("*") - 1)).alias(f"s_{n}")
                for n, c in raw.items()
            ],
        ).where("_n > 1")
        return d.join(std, "dt").select(
            "asset_id", "dt", "mi", "mcap", F.sqrt("mcap").alias("root_cap"), "country", "region", "ret",
            *[F.round(div(F.col(c) - F.col(f"m_{n}"), F.col(f"s_{n}")), 12).alias(n) for n, c in raw.items()],
        )

    @cached_property
    def factor_ret(self) -> DataFrame:
        """Two-factor cross-sectional regression per month in closed form.

        One small row per month; stored once, as later steps read it many times.
        """
        x, z, r, w = (F.col(c) for c in ("size", "momentum", "ret", "root_cap"))
        s = self.exposures.groupBy("dt", "mi").agg(
            F.count("*").alias("n"),
            F.sum(w * x * x).alias("xx"), F.sum(w * z * z).alias("zz"), F.sum(w * x * z).alias("xz"),
            F.sum(w * x * r).alias("xr"), F.sum(w * z * r).alias("zr"),
        ).where("n > 2")
        det = F.col("xx") * F.col("zz") - F.col("xz") * F.col("xz")
        out = s.select(
            "dt", "mi",
            (div(F.col("xr") * F.col("zz") - F.col("zr") * F.col("xz"), det)).alias("f_size"),
            (div(F.col("zr") * F.col("xx") - F.col("xr") * F.col("xz"), det)).alias("f_mom"),
        )
        return cut(out)

    @cached_property
    def specific(self) -> DataFrame:
        """Residual of the two-factor regression for every asset."""
        return self.exposures.join(self.factor_ret.drop("mi"), "dt").select(
            "asset_id", "dt", "mi", "mcap", "country", "region", "size", "momentum", "root_cap", "ret",
            (F.col("ret") - F.col("size") * F.col("f_size") - F.col("momentum") * F.col("f_mom")).alias("sret"),
        )

    @cached_property
    def cov_long(self) -> DataFrame:
        """Annual covariance of the two factor returns as rows (f1, f2, value)."""
        one = self.factor_ret.agg(
            (12 * F.var_samp("f_size")).alias("ss"), (12 * F.covar_samp("f_size", "f_mom")).alias("sm"), (12 * F.var_samp("f_mom")).alias("mm")
        )
        return one.selectExpr(
            "stack(4, 'momentum', 'momentum', mm, 'momentum', 'size', sm, 'size', 'momentum', sm, 'size', 'size', ss) as (f1, f2, value)"
        )

    @cached_property
    def spec_risk(self) -> DataFrame:
        """Annual specific variance per asset, assets with three returns or more."""
        return self.specific.groupBy("asset_id").agg(
            (div(12 * F.sum(F.col("sret") * F.col("sret")), F.count("*"))).alias("svar"), F.count("*").alias("nobs")
        ).where("nobs > 2")

    @cached_property
    def latest_exp(self) -> DataFrame:
        """Exposures of the last month."""
        last = self.exposures.agg(F.max("dt").alias("dt"))
        return self.exposures.join(last, "dt", "left_semi")

    @cached_property
    def portfolio(self) -> DataFrame:
        """Brand portfolios: part weights by value inside a brand and month."""
        total = self.sparse.groupBy("industry", "dt").agg(F.sum("mcap").alias("_t"))
        return self.sparse.join(total, ["industry", "dt"]).select(
            F.col("industry").alias("name"), "asset_id", "dt", "mi", "mcap", (div(F.col("mcap"), F.col("_t"))).alias("weight")
        )

    @cached_property
    def holdings(self) -> DataFrame:
        """Country portfolios of suppliers in the last month."""
        total = self.latest_exp.groupBy("country").agg(F.sum("mcap").alias("_t"))
        return self.latest_exp.join(total, "country").select(
            F.col("country").alias("name"), "region", "asset_id", (div(F.col("mcap"), F.col("_t"))).alias("weight")
        )
