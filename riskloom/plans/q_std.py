"""Outliers, standardisation, missing data, estimation universe."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import standardize as sd, universe as un
from riskloom.plans.q_base import hazen_sql
from riskloom.plans.registry import query


def _r(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


_MAD = """med AS (SELECT {k}, median(x) AS c FROM src GROUP BY {k}), {n} AS (SELECT {k}, MAX(c) - {b} * median(abs(x - c)) / 0.67449::DOUBLE AS lo, MAX(c) + {b} * median(abs(x - c)) / 0.67449::DOUBLE AS up FROM src JOIN med USING ({k}) GROUP BY {k})"""


@query("std01_clip_mad", "panel", "WITH src AS (SELECT dt, ret AS x FROM panel WHERE ret IS NOT NULL AND ret <> 0), " + _MAD.format(k="dt", n="b", b=3) + """
SELECT asset_id, p.dt, ROUND(CASE WHEN ret IS NOT NULL AND lo IS NOT NULL THEN GREATEST(lo, LEAST(up, ret)) ELSE ret END, 6) AS ret FROM panel p LEFT JOIN b ON p.dt = b.dt""")
def _(v):
    return _r(sd.clip_outliers(v.panel.select("asset_id", "dt", "ret"), ["dt"], "ret", 3.0, zero_tolerance=0.0), ["ret"])


@query("std01_clip_idr", "panel", "WITH src AS (SELECT dt, ret AS x FROM panel), " + hazen_sql({"a": 10, "b": 90}) + """
SELECT asset_id, p.dt, ROUND(CASE WHEN ret IS NOT NULL AND hp.n > 1 THEN GREATEST(a - 0.2::DOUBLE * (b - a), LEAST(b + 0.2::DOUBLE * (b - a), ret)) ELSE ret END, 6) AS ret FROM panel p LEFT JOIN hp ON p.dt = hp.dt""")
def _(v):
    return _r(sd.clip_outliers(v.panel.select("asset_id", "dt", "ret"), ["dt"], "ret", 0.2, "idr", 1.0), ["ret"])


@query("std02_clip_2d", "panel", "WITH src AS (SELECT dt, ret AS x FROM panel WHERE ret IS NOT NULL AND ret <> 0), " + _MAD.format(k="dt", n="bc", b=2) + """,
src2 AS (SELECT asset_id, ret AS x FROM panel WHERE ret IS NOT NULL AND ret <> 0), med2 AS (SELECT asset_id, median(x) AS c FROM src2 GROUP BY 1),
br AS (SELECT asset_id, MAX(c) - 2 * median(abs(x - c)) / 0.67449::DOUBLE AS lo, MAX(c) + 2 * median(abs(x - c)) / 0.67449::DOUBLE AS up FROM src2 JOIN med2 USING (asset_id) GROUP BY 1)
SELECT p.asset_id, p.dt, ROUND(CASE WHEN (ret < bc.lo OR ret > bc.up) AND (ret < br.lo OR ret > br.up) THEN GREATEST(LEAST(bc.lo, br.lo), LEAST(GREATEST(bc.up, br.up), ret)) ELSE ret END, 6) AS ret
FROM panel p LEFT JOIN bc ON p.dt = bc.dt LEFT JOIN br ON p.asset_id = br.asset_id""")
def _(v):
    return _r(sd.clip_2d(v.panel.select("asset_id", "dt", "ret"), "asset_id", "dt", "ret", 2.0, zero_tolerance=0.0), ["ret"])


@query("std03_clip_bucketed", "panel", """
WITH n AS (SELECT dt, region, country, COUNT(*) AS n FROM panel GROUP BY 1, 2, 3), pl AS (SELECT dt, region, SUM(n) AS pn FROM n WHERE n < 6 GROUP BY 1, 2),
k AS (SELECT p.asset_id, p.dt, p.ret, CASE WHEN n.n >= 6 THEN concat_ws('|', p.region, p.country) WHEN pl.pn >= 4 THEN concat_ws('|', p.region, '*') END AS bucket FROM panel p JOIN n ON p.dt = n.dt AND p.region = n.region AND p.country = n.country LEFT JOIN pl ON pl.dt = p.dt AND pl.region = p.region),
s AS (SELECT dt, bucket, ret AS x FROM k WHERE ret IS NOT NULL AND ret <> 0 AND bucket IS NOT NULL), m AS (SELECT dt, bucket, median(x) AS c FROM s GROUP BY 1, 2 HAVING COUNT(*) > 1),
b AS (SELECT dt, bucket, MAX(c) - 2 * median(abs(x - c)) / 0.67449::DOUBLE AS lo, MAX(c) + 2 * median(abs(x - c)) / 0.67449::DOUBLE AS up FROM s JOIN m USING (dt, bucket) GROUP BY 1, 2)
SELECT asset_id, k.dt, ROUND(CASE WHEN ret IS NOT NULL AND lo IS NOT NULL THEN GREATEST(lo, LEAST(up, ret)) ELSE ret END, 6) AS ret FROM k LEFT JOIN b ON k.dt = b.dt AND k.bucket = b.bucket""")
def _(v):
    x = v.panel.select("asset_id", "dt", "region", "country", "ret")
    return _r(sd.clip_bucketed(x, "dt", "region", "country", "ret", 2.0, 0.0, 6, 4).select("asset_id", "dt", "ret"), ["ret"])


_LONG = """lg AS (SELECT asset_id, dt, region, country, mcap, mcap > 150000 AS estu, factor, CASE WHEN asset_id % 9 = 0 AND factor = 'mom_raw' THEN NULL ELSE value END AS value
 FROM (UNPIVOT (SELECT asset_id, dt, region, country, mcap, size_raw, mom_raw, vol_raw FROM descr) ON size_raw, mom_raw, vol_raw INTO NAME factor VALUE value) u)"""


def descr_long(v):
    """Raw descriptors as rows with estimation flags and a hole in momentum."""
    x = v.descr.unpivot(["asset_id", "dt", "mi", "region", "country", "mcap"], ["size_raw", "mom_raw", "vol_raw"], "factor", "value")
    hole = (F.col("asset_id") % 9 == 0) & (F.col("factor") == "mom_raw")
    return x.withColumn("estu", F.col("mcap") > 150000).withColumn("value", F.when(~hole, F.col("value")))


def _stats_sql(keys: str) -> str:
    return f"""m AS (SELECT {keys}, SUM(CASE WHEN estu THEN value * mcap END) / SUM(CASE WHEN estu AND value IS NOT NULL THEN mcap END) AS mean, SUM(CASE WHEN estu THEN 1 ELSE 0 END) AS n FROM lg GROUP BY {keys}),
s AS (SELECT {keys}, MAX(mean) AS mean, CASE WHEN MAX(n) >= 3 THEN sqrt(SUM(CASE WHEN estu THEN COALESCE(value - mean, 0)^2 END) / (MAX(n) - 1)) END AS std FROM lg JOIN m USING ({keys}) GROUP BY {keys})"""


def _z_sql(keys: str) -> str:
    return f"SELECT asset_id, dt, factor, ROUND(CASE WHEN std > 0 THEN CASE WHEN value IS NOT NULL THEN GREATEST(-2.5::DOUBLE, LEAST(2.5::DOUBLE, (value - mean) / std)) END ELSE value END, 6) AS value FROM lg LEFT JOIN s USING ({keys})"


@query("std04_standardize", "descr", "WITH " + _LONG + ", " + _stats_sql("dt, factor") + " " + _z_sql("dt, factor"))
def _(v):
    z = sd.standardize(descr_long(v), ["dt", "factor"], "value", "estu", "mcap", 2.5)
    return _r(z.select("asset_id", "dt", "factor", "value"), ["value"])


for _scope in ("region", "country"):
    query(f"std05_standardize_{_scope}", "descr", "WITH " + _LONG + ", " + _stats_sql(f"dt, factor, {_scope}") + " " + _z_sql(f"dt, factor, {_scope}"))(
        lambda v, s=_scope: _r(sd.standardize(descr_long(v), ["dt", "factor", s], "value", "estu", "mcap", 2.5, skip_binary=False).select("asset_id", "dt", "factor", "value"), ["value"])
    )


@query("std04_standardize_with_clip", "descr")
def _(v):
    z = sd.standardize(descr_long(v), ["dt", "factor"], "value", "estu", "mcap", 5.5, mad=3.0)
    return _r(z.select("asset_id", "dt", "factor", "value"), ["value"])


@query("std06_style_composite", "exposures", """
SELECT asset_id, dt, style, ROUND(value, 6) AS value FROM (
 SELECT asset_id, dt, 'trend' AS style, (0.7::DOUBLE * COALESCE(CASE WHEN asset_id % 9 <> 0 THEN momentum END, 0) + 0.3::DOUBLE * turnover) / (CASE WHEN asset_id % 9 <> 0 THEN 0.7::DOUBLE + 0.3::DOUBLE ELSE 0.3::DOUBLE END) AS value FROM exposures
 UNION ALL SELECT asset_id, dt, 'size', size FROM exposures)""")
def _(v):
    x = v.exposures.withColumn("momentum", F.when(F.col("asset_id") % 9 != 0, F.col("momentum"))).unpivot(["asset_id", "dt"], ["size", "momentum", "turnover"], "factor", "value")
    recipe = v.spark.createDataFrame([("momentum", "trend", 0.7), ("turnover", "trend", 0.3), ("size", "size", 1.0)], "factor string, style string, weight double")
    return _r(sd.style_composite(x, recipe, ["asset_id", "dt"]), ["value"])


_PX = """x AS (SELECT asset_id, dt, region, country, mcap, size, sqrt(mcap) AS w, CASE WHEN asset_id % 7 <> 0 THEN momentum END AS y FROM exposures),
g AS (SELECT dt, region, country, SUM(w) AS sw, SUM(w * size) AS sx, SUM(w * y) AS sy, SUM(w * size * size) AS sxx, SUM(w * size * y) AS sxy FROM x WHERE y IS NOT NULL GROUP BY 1, 2, 3),
r AS (SELECT dt, region, SUM(sxy - sx * sy / sw) / SUM(sxx - sx * sx / sw) AS slope FROM g GROUP BY 1, 2),
c AS (SELECT g.dt, g.region, country, slope, (sy - slope * sx) / sw AS level FROM g JOIN r ON g.dt = r.dt AND g.region = r.region)"""


@query("std07_proxy_exposure", "exposures", "WITH " + _PX + """
SELECT x.asset_id, x.dt, ROUND(COALESCE(y, CASE WHEN level IS NOT NULL THEN GREATEST(-2, LEAST(2, level + slope * size)) END), 6) AS momentum, y IS NULL AND level IS NOT NULL AS is_proxy
FROM x LEFT JOIN c ON x.dt = c.dt AND x.region = c.region AND x.country = c.country""")
def _(v):
    x = v.exposures.withColumn("momentum", F.when(F.col("asset_id") % 7 != 0, F.col("momentum"))).withColumn("estu", F.lit(True))
    out = sd.proxy_exposure(x, "dt", "region", "country", "momentum", "size", "mcap", "estu")
    return _r(out.select("asset_id", "dt", "momentum", "is_proxy"), ["momentum"])


@query("std08_proxy_data", "exposures", "WITH src AS (SELECT dt, mcap AS x FROM exposures), " + hazen_sql({"lo": 5, "hi": 95}) + """,
x AS (SELECT asset_id, e.dt, size, CASE WHEN asset_id % 7 <> 0 THEN momentum END AS y, sqrt(GREATEST(lo, LEAST(hi, mcap))) AS w FROM exposures e JOIN hp ON e.dt = hp.dt),
f AS (SELECT dt, (SUM(w) * SUM(w * size * y) - SUM(w * size) * SUM(w * y)) / (SUM(w) * SUM(w * size * size) - SUM(w * size) * SUM(w * size)) AS b, SUM(w * size) / SUM(w) AS mx, SUM(w * y) / SUM(w) AS my FROM x WHERE y IS NOT NULL GROUP BY dt)
SELECT asset_id, x.dt, ROUND(COALESCE(y, my + b * (size - mx)), 6) AS momentum, y IS NULL AS is_proxy FROM x JOIN f ON x.dt = f.dt""")
def _(v):
    x = v.exposures.withColumn("momentum", F.when(F.col("asset_id") % 7 != 0, F.col("momentum"))).withColumn("estu", F.lit(True))
    return _r(sd.proxy_data(x, ["dt"], "momentum", ["size"], "mcap", "estu").select("asset_id", "dt", "momentum", "is_proxy"), ["momentum"])


@query("std09_shrink_to_mean", "exposures", """
WITH x AS (SELECT asset_id, dt, region, country, mcap, CASE WHEN asset_id % 11 <> 0 THEN momentum END AS y, CASE WHEN asset_id % 11 = 0 THEN 0 WHEN asset_id % 3 = 0 THEN 0.4::DOUBLE ELSE 1 END AS s, mcap > 100000 AS estu FROM exposures),
b AS (SELECT dt, region, country, SUM(CASE WHEN estu AND s >= 1 THEN y * mcap END) AS v, SUM(CASE WHEN estu AND s >= 1 THEN mcap END) AS w FROM x GROUP BY 1, 2, 3), t AS (SELECT dt, SUM(v) / SUM(w) AS a FROM b GROUP BY dt)
SELECT x.asset_id, x.dt, ROUND(COALESCE(y, 0) * s + (1 - s) * COALESCE(v / w, a, 0), 6) AS momentum FROM x JOIN b ON x.dt = b.dt AND x.region = b.region AND x.country = b.country JOIN t ON t.dt = x.dt""")
def _(v):
    x = v.exposures.withColumn("momentum", F.when(F.col("asset_id") % 11 != 0, F.col("momentum"))).withColumn("estu", F.col("mcap") > 100000)
    s = F.when(F.col("asset_id") % 3 == 0, 0.4).otherwise(1.0)
    return _r(sd.shrink_to_mean(x, "dt", "region", "country", "momentum", "mcap", "estu", s).select("asset_id", "dt", "momentum"), ["momentum"])


@query("std10_fill_standardized_zero", "descr", "WITH " + _LONG + ", " + _stats_sql("dt, factor") + """
SELECT asset_id, dt, factor, ROUND(CASE WHEN value IS NOT NULL THEN GREATEST(-2.5::DOUBLE, LEAST(2.5::DOUBLE, (value - mean) / std)) ELSE -mean / std END, 6) AS value FROM lg LEFT JOIN s USING (dt, factor) WHERE std > 0""")
def _(v):
    z = sd.standardize(descr_long(v), ["dt", "factor"], "value", "estu", "mcap", 2.5).where("std > 0")
    return _r(sd.fill_standardized_zero(z, "value").select("asset_id", "dt", "factor", "value"), ["value"])


_LINKS = """lk AS (SELECT s_suppkey AS asset_id, CAST(floor(s_suppkey / 4) AS BIGINT) AS group_id, CASE WHEN s_suppkey % 8 = 3 THEN s_suppkey - 3 END AS master, 1.0::DOUBLE + s_suppkey % 4 AS score, s_suppkey % 8 = 6 AS is_shell FROM supplier)"""


@query("std11_clone_linked", "exposures", "WITH " + _LINKS + """,
m AS (SELECT group_id, dt, SUM(score * momentum) / SUM(score) AS mean FROM exposures e JOIN lk USING (asset_id) WHERE master IS NULL AND NOT is_shell GROUP BY 1, 2),
x AS (SELECT e.asset_id, e.dt, lk.master, CASE WHEN is_shell THEN momentum ELSE COALESCE(mean, momentum) END AS v FROM exposures e JOIN lk USING (asset_id) LEFT JOIN m ON m.group_id = lk.group_id AND m.dt = e.dt)
SELECT x.asset_id, x.dt, ROUND(CASE WHEN x.master IS NOT NULL THEN COALESCE(y.v, x.v) ELSE x.v END, 6) AS value FROM x LEFT JOIN x y ON y.asset_id = x.master AND y.dt = x.dt""")
def _(v):
    k = F.col("s_suppkey")
    links = v.supplier.select(k.alias("asset_id"), F.floor(k / 4).alias("group_id"), F.when(k % 8 == 3, k - 3).alias("master"), (1.0 + k % 4).alias("score"), (k % 8 == 6).alias("is_shell"))
    x = v.exposures.select("asset_id", "dt", F.col("momentum").alias("value"))
    return _r(sd.clone_linked(x, links, ["dt"]), ["value"])


@query("std12_score_linked", "panel", """
WITH a AS (SELECT asset_id, CAST(floor(asset_id / 4) AS BIGINT) AS g, ROUND(AVG(volume), 6) AS adv, ROUND(AVG(mcap), 4) AS cap, CAST(COUNT(ret) AS DOUBLE) AS nret FROM panel GROUP BY 1),
m AS (SELECT g, MAX(adv) AS ma, MAX(cap) AS mc, MAX(nret) AS mn FROM a GROUP BY g)
SELECT asset_id, ROUND(exp(15 * (adv / ma * (cap / mc) * (nret / mn) - 1)), 6) AS score FROM a JOIN m USING (g)""")
def _(v):
    a = v.panel.groupBy("asset_id").agg(F.round(F.avg("volume"), 6).alias("adv"), F.round(F.avg("mcap"), 4).alias("cap"), F.count("ret").cast("double").alias("nret")).withColumn("g", F.floor(F.col("asset_id") / 4))
    return _r(sd.score_linked(a, "g", ["adv", "cap", "nret"], 15.0).select("asset_id", "score"), ["score"])


@query("std13_orthogonalize", "exposures", """
WITH f AS (SELECT dt, SUM(root_cap * size * volatility) / SUM(root_cap * size * size) AS b FROM exposures WHERE mcap > 100000 GROUP BY dt),
r AS (SELECT asset_id, e.dt, mcap, volatility - b * size AS e FROM exposures e JOIN f ON e.dt = f.dt), s AS (SELECT dt, stddev_samp(e) AS s FROM r WHERE mcap > 100000 GROUP BY dt)
SELECT asset_id, r.dt, ROUND(e / s, 6) AS volatility FROM r JOIN s ON r.dt = s.dt""")
def _(v):
    x = v.exposures.withColumn("estu", F.col("mcap") > 100000)
    return _r(sd.orthogonalize(x, ["dt"], "volatility", ["size"], "root_cap", "estu").select("asset_id", "dt", "volatility"), ["volatility"])


@query("std14_size_cubed", "panel", """
WITH m AS (SELECT dt, SUM(mcap * ln(mcap)) / SUM(mcap) AS m FROM panel WHERE mcap > 100000 GROUP BY dt), s AS (SELECT p.dt, MAX(m) AS m, sqrt(SUM((ln(mcap) - m)^2) / (COUNT(*) - 1)) AS s FROM panel p JOIN m ON p.dt = m.dt WHERE mcap > 100000 GROUP BY p.dt)
SELECT asset_id, p.dt, ROUND(((ln(mcap) - m) / s)^3, 4) AS size_nl FROM panel p JOIN s ON p.dt = s.dt""")
def _(v):
    x = v.panel.withColumn("estu", F.col("mcap") > 100000)
    return _r(sd.size_cubed(x, ["dt"], "mcap", "estu").select("asset_id", "dt", "size_nl"), ["size_nl"], 4)


@query("std15_china_local", "", "SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 1.0::DOUBLE END AS local FROM part")
def _(v):
    return sd.china_local(v.part, "p_type", ["SMALL", "LARGE"]).select("p_partkey", "local")


@query("std16_cap_buckets", "panel", "WITH src AS (SELECT dt, mcap AS x FROM panel), " + hazen_sql({"a": 40, "b": 70}) + """
SELECT asset_id, p.dt, CASE WHEN mcap > a AND mcap <= b THEN 1.0::DOUBLE END AS mid, CASE WHEN mcap <= a THEN 1.0::DOUBLE END AS small FROM panel p JOIN hp ON p.dt = hp.dt""")
def _(v):
    x = v.panel.withColumn("estu", F.lit(True))
    return sd.cap_buckets(x, ["dt"], "mcap", "estu", {"mid": (40.0, 70.0), "small": (0.0, 40.0)}).select("asset_id", "dt", "mid", "small")


@query("std17_exclude_by_cap_rank", "sparse", """
WITH r AS (SELECT asset_id, dt, industry, mcap, SUM(mcap) OVER w AS run, SUM(mcap) OVER (PARTITION BY dt, industry) AS tot, SUM(sqrt(mcap)) OVER (PARTITION BY dt, industry) AS rt FROM sparse WINDOW w AS (PARTITION BY dt, industry ORDER BY mcap DESC, asset_id ROWS UNBOUNDED PRECEDING))
SELECT asset_id, dt, industry, mcap FROM r WHERE rt * rt / tot <= 10 OR run - mcap < 0.75::DOUBLE * tot""")
def _(v):
    return un.exclude_by_cap_rank(v.sparse.select("asset_id", "dt", "industry", "mcap"), ["dt", "industry"], "asset_id", "mcap")


@query("std18_cap_and_volume", "sparse", """
WITH r AS (SELECT asset_id, dt, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY mcap DESC, asset_id) AS rc, ROW_NUMBER() OVER (PARTITION BY dt ORDER BY volume DESC, asset_id) AS rv, COUNT(*) OVER (PARTITION BY dt) AS n FROM sparse),
a AS (SELECT *, rc <= 120 AND rv <= 120 AND ROW_NUMBER() OVER (PARTITION BY dt, rc <= 120 AND rv <= 120 ORDER BY rc) <= 100 AS a FROM r WHERE n > 250),
a1 AS (SELECT *, 100 - SUM(CASE WHEN a THEN 1 ELSE 0 END) OVER (PARTITION BY dt) AS short FROM a),
a2 AS (SELECT *, a OR (rv <= 120 AND NOT a AND ROW_NUMBER() OVER (PARTITION BY dt, rv <= 120 AND NOT a ORDER BY rv) <= short) AS e FROM a1),
b AS (SELECT *, rc <= 300 AND rv <= 300 AND NOT e AND ROW_NUMBER() OVER (PARTITION BY dt, rc <= 300 AND rv <= 300 AND NOT e ORDER BY rc) <= 150 AS b FROM a2),
b1 AS (SELECT *, 150 - SUM(CASE WHEN b THEN 1 ELSE 0 END) OVER (PARTITION BY dt) AS short2 FROM b),
b2 AS (SELECT *, rv <= 300 AND NOT e AND NOT b AND ROW_NUMBER() OVER (PARTITION BY dt, rv <= 300 AND NOT e AND NOT b ORDER BY rv) <= short2 AS b2 FROM b1)
SELECT asset_id, dt FROM b2 WHERE e OR b OR b2 UNION ALL SELECT asset_id, dt FROM r WHERE n <= 250""")
def _(v):
    return un.cap_and_volume(v.sparse.select("asset_id", "dt", "mcap", "volume"), ["dt"], "asset_id", "mcap", "volume", 100, 150).select("asset_id", "dt")


@query("std19_pump_up", "sparse", """
WITH x AS (SELECT asset_id, dt, industry, mcap, mcap > 120000 AS m FROM sparse),
n AS (SELECT dt, industry, COALESCE(SUM(CASE WHEN m THEN sqrt(mcap) END), 0) AS s1, COALESCE(SUM(CASE WHEN m THEN mcap END), 0) AS s2 FROM x GROUP BY 1, 2),
t AS (SELECT *, CASE WHEN s2 > 0 THEN s1 * s1 / s2 ELSE 0 END AS w0 FROM n WHERE CASE WHEN s2 > 0 THEN s1 * s1 / s2 ELSE 0 END < 10),
r AS (SELECT x.*, s1, s2, w0, ROW_NUMBER() OVER w AS rank, SUM(sqrt(mcap)) OVER w AS r1, SUM(mcap) OVER w AS r2 FROM x JOIN t USING (dt, industry) WHERE NOT m WINDOW w AS (PARTITION BY dt, industry ORDER BY mcap DESC, asset_id ROWS UNBOUNDED PRECEDING)),
q AS (SELECT *, (s1 + r1)^2 / (s2 + r2) AS width, LAG((s1 + r1)^2 / (s2 + r2), 1, w0) OVER (PARTITION BY dt, industry ORDER BY rank) AS prev FROM r),
l AS (SELECT dt, industry, COALESCE(MIN(CASE WHEN width >= 10 OR (prev <> 0 AND width / prev - 1 < 0.01::DOUBLE) THEN rank END), MAX(rank)) AS last FROM q GROUP BY 1, 2)
SELECT q.dt, q.industry, asset_id, rank, ROUND(width, 6) AS width FROM q JOIN l ON q.dt = l.dt AND q.industry = l.industry WHERE rank <= last""")
def _(v):
    x = v.sparse.select("asset_id", "dt", "industry", "mcap", (F.col("mcap") > 120000).alias("m"))
    return _r(un.pump_up(x, ["dt", "industry"], "asset_id", "mcap", "m"), ["width"])


@query("std20_estimation_universe", "panel")
def _(v):
    x = v.panel.select(
        "asset_id", "dt", "mi", F.col("mcap").alias("cap"), F.col("region").alias("industry"), F.lit("com").alias("asset_type"), (F.col("asset_id") % 13 == 0).alias("excluded"),
        F.when(F.col("volume") < 100, 0.7).otherwise(1.0).alias("non_missing"), F.when(F.col("ret") == 0, 0.5).otherwise(1.0).alias("non_zero"),
    )
    return un.estimation_universe(x, min_width=5.0)
