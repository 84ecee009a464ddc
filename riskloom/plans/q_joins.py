"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import bitemporal as bt, joins as jn
from riskloom.plans.registry import query
from riskloom.session import spread


def day(text: str):
    return F.lit(text).cast("date")


@query("joi01_rmg_map", "panel validity", """
SELECT p.asset_id, p.dt, v.status AS market FROM panel p JOIN validity v ON p.asset_id = v.id AND v.from_dt <= p.dt AND p.dt < v.thru_dt""")
def _(v):
    lst = v.validity.select(F.col("id").alias("asset_id"), F.col("status").alias("market"), "from_dt", "thru_dt")
    return jn.rmg_map(v.panel.select("asset_id", "dt"), lst, "asset_id")


@query("joi02_home_markets", "", """
SELECT s_suppkey AS asset_id, s_nationkey AS market, COALESCE(CASE WHEN s_suppkey % 10 = 0 THEN 1 END, CASE WHEN c_custkey % 4 = 0 THEN c_nationkey END, s_nationkey) AS home,
 COALESCE(CASE WHEN s_suppkey % 10 = 0 THEN 1 END, CASE WHEN c_custkey % 4 = 0 THEN c_nationkey END, s_nationkey) <> s_nationkey AS is_foreign
FROM supplier LEFT JOIN customer ON s_suppkey = c_custkey""")
def _(v):
    a = v.supplier.where("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("asset_id"), F.lit(1).alias("home"))
    b = v.customer.where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("asset_id"), F.col("c_nationkey").alias("home"))
    u = v.supplier.select(F.col("s_suppkey").alias("asset_id"), F.col("s_nationkey").alias("market"))
    return jn.home_markets(u, [a, b], "asset_id")


@query("joi03_linkage", "", """
WITH a AS (SELECT p_partkey AS asset_id, CAST(floor(p_partkey / 4) AS BIGINT) AS company FROM part),
l AS (SELECT asset_id, company, CASE WHEN company % 20 = 1 THEN company - 1 ELSE company END AS link_id FROM a),
n AS (SELECT link_id, COUNT(*) AS n_lines FROM l GROUP BY 1)
SELECT l.asset_id, l.company, l.link_id, n.n_lines, CAST(CASE WHEN l.asset_id % 4 = 3 AND p_type = 'PROMO' THEN l.asset_id - 3 END AS DOUBLE) AS clone_of FROM l JOIN n ON l.link_id = n.link_id JOIN part ON p_partkey = l.asset_id""")
def _(v):
    a = v.part.select(F.col("p_partkey").alias("asset_id"), "p_type")
    company = a.select("asset_id", F.floor(F.col("asset_id") / 4).alias("company"))
    dual = company.select("company").distinct().where("company % 20 in (0, 1)").withColumn("dual_group", F.col("company") - F.col("company") % 20)
    clones = a.where("asset_id % 4 = 3 and p_type = 'PROMO'").select("asset_id", (F.col("asset_id") - 3).cast("double").alias("master"))
    return jn.linkage(a.select("asset_id"), company, dual, clones, "asset_id")


@query("joi04_group_linked", "", """
WITH x AS (SELECT p_partkey AS asset_id, CAST(floor(p_partkey / 4) AS BIGINT) AS issuer, concat_ws('|', p_type, CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END) AS cluster FROM part)
SELECT issuer, cluster, asset_id, COUNT(*) OVER (PARTITION BY issuer, cluster) AS size FROM x""")
def _(v):
    x = v.part.select(F.col("p_partkey").alias("asset_id"), F.floor(F.col("p_partkey") / 4).alias("issuer"), "p_type", "p_size")
    return jn.group_linked(x, "issuer", "asset_id", [F.col("p_type"), F.col("p_size") > 25]).select("issuer", "cluster", "asset_id", "size")


_SUBGROUPS = """l AS (SELECT p_partkey AS asset_id, CAST(floor(p_partkey / 8) AS BIGINT) AS issuer, p_size % 2 AS market, p_type AS kind FROM part),
k AS (SELECT asset_id, CASE asset_id % 8 WHEN 3 THEN asset_id - 3 WHEN 4 THEN asset_id - 1 WHEN 5 THEN asset_id - 1 WHEN 6 THEN asset_id + 1 WHEN 7 THEN asset_id - 1 ELSE asset_id + 7 END AS master,
  CASE asset_id % 8 WHEN 3 THEN 'clone' WHEN 4 THEN 'dr' WHEN 5 THEN 'forced' WHEN 2 THEN 'soft' ELSE 'clone' END AS link FROM l WHERE asset_id % 8 IN (3, 4, 5, 6, 7, 1) AND (asset_id % 8 < 6 OR asset_id % 3 = 0) OR asset_id % 16 = 2)"""


@query("joi04_linked_subgroups", "", "WITH " + _SUBGROUPS + """,
i AS (SELECT k.* FROM k JOIN l a USING (asset_id) JOIN l b ON b.asset_id = k.master AND b.issuer = a.issuer),
soft AS (SELECT asset_id FROM i WHERE link = 'soft'),
c AS (SELECT l.asset_id, issuer, CASE WHEN soft.asset_id IS NULL THEN concat_ws('|', market, CASE WHEN kind IN ('SMALL', 'STANDARD', 'ECONOMY') THEN 'main' WHEN kind = 'PROMO' THEN CAST(l.asset_id AS VARCHAR) ELSE kind END) END AS tag FROM l LEFT JOIN soft USING (asset_id)),
e1 AS (SELECT asset_id, master FROM i WHERE link <> 'soft'),
e AS (SELECT a.asset_id, COALESCE(d.master, c.master, b.master, a.master) AS root, d.master IS NOT NULL AS far FROM e1 a LEFT JOIN e1 b ON b.asset_id = a.master LEFT JOIN e1 c ON c.asset_id = b.master LEFT JOIN e1 d ON d.asset_id = c.master),
r AS (SELECT c.issuer, c.asset_id, CASE WHEN c.tag IS NULL THEN NULL WHEN e.asset_id IS NULL THEN c.tag WHEN far THEN NULL ELSE b.tag END AS cluster FROM c LEFT JOIN e USING (asset_id) LEFT JOIN c b ON b.asset_id = e.root)
SELECT issuer, cluster, asset_id, CASE WHEN cluster IS NOT NULL THEN COUNT(*) OVER (PARTITION BY issuer, cluster) END AS size FROM r""")
def _(v):
    """Chains of links of up to three steps, circles of two, and links to another issuer's line."""
    a = F.col("asset_id")
    lines = v.part.select(F.col("p_partkey").alias("asset_id"), F.floor(F.col("p_partkey") / 8).alias("issuer"), (F.col("p_size") % 2).alias("market"), F.col("p_type").alias("kind"))
    some = (a % 8).isin(3, 4, 5, 6, 7, 1) & ((a % 8 < 6) | (a % 3 == 0)) | (a % 16 == 2)
    step = F.when(a % 8 == 3, -3).when((a % 8).isin(4, 5, 7), -1).when(a % 8 == 6, 1).otherwise(7)
    kind = F.when(a % 8 == 4, "dr").when(a % 8 == 5, "forced").when(a % 8 == 2, "soft").otherwise("clone")
    links = lines.where(some).select("asset_id", (a + step).alias("master"), kind.alias("link"))
    out = jn.linked_subgroups(lines, links, "issuer", "asset_id", "market", "kind", ["SMALL", "STANDARD", "ECONOMY"], ["PROMO"])
    return out.select("issuer", "cluster", "asset_id", "size")


_LINES = """lines AS (SELECT asset_id, dt, issuer AS company, mcap AS cap, asset_id % 7 = 0 AS excluded, CAST(CASE WHEN asset_id % 5 IN (0, 1) THEN 0 ELSE asset_id % 5 END AS BIGINT) AS country, asset_type = 'PROMO' AS is_dr FROM sparse)"""


def _lines(v):
    place = jn.merge_countries(F.col("asset_id") % 5, {0: [0, 1]}).cast("long")
    return v.sparse.select(
        "asset_id", "dt", F.col("issuer").alias("company"), F.col("mcap").alias("cap"), (F.col("asset_id") % 7 == 0).alias("excluded"), place.alias("country"), (F.col("asset_type") == "PROMO").alias("is_dr")
    )


@query("joi05_issuer_cap", "sparse", "WITH " + _LINES + """,
c AS (SELECT dt, company, country, COUNT(*) AS n, SUM(CASE WHEN NOT excluded THEN 1 ELSE 0 END) AS n_ok, SUM(cap) AS all_cap, MAX(cap) AS max_cap,
 SUM(CASE WHEN NOT excluded AND NOT is_dr THEN 1 ELSE 0 END) AS n_plain, SUM(CASE WHEN NOT excluded AND NOT is_dr THEN cap ELSE 0 END) AS plain, SUM(CASE WHEN NOT excluded THEN cap ELSE 0 END) AS ok FROM lines GROUP BY 1, 2, 3),
t AS (SELECT dt, company, CASE WHEN SUM(n_ok) = 0 THEN MAX(max_cap) ELSE MAX(CASE WHEN n = 1 THEN all_cap WHEN n_ok = 0 THEN 0 WHEN n_plain > 0 THEN CASE WHEN plain = 0 THEN all_cap ELSE plain END WHEN ok = 0 THEN all_cap ELSE ok END) END AS total_cap FROM c GROUP BY 1, 2),
d AS (SELECT dt, CASE WHEN company % 20 = 1 THEN company - 1 ELSE company END AS g, SUM(total_cap) AS dlc_cap FROM t GROUP BY 1, 2)
SELECT l.asset_id, l.dt, ROUND(t.total_cap, 2) AS total_cap, ROUND(d.dlc_cap, 2) AS dlc_cap FROM lines l JOIN t ON l.dt = t.dt AND l.company = t.company JOIN d ON d.dt = l.dt AND d.g = CASE WHEN l.company % 20 = 1 THEN l.company - 1 ELSE l.company END""")
def _(v):
    lines = _lines(v)
    dual = v.part.select(F.floor(F.col("p_partkey") / 4).alias("company")).distinct().where("company % 20 in (0, 1)").withColumn("dual_group", F.col("company") - F.col("company") % 20)
    out = jn.issuer_cap(lines, dual, ["dt"])
    return out.select("asset_id", "dt", F.round("total_cap", 2).alias("total_cap"), F.round("dlc_cap", 2).alias("dlc_cap"))


@query("joi06_combine_first", "panel", """
WITH a AS (SELECT asset_id, dt, price, volume FROM panel WHERE asset_id % 3 <> 0), b AS (SELECT asset_id, dt, price * 2 AS price, mcap, n FROM panel WHERE asset_id % 5 <> 0)
SELECT COALESCE(a.asset_id, b.asset_id) AS asset_id, COALESCE(a.dt, b.dt) AS dt, COALESCE(a.price, b.price) AS price, a.volume, b.mcap, CAST(b.n AS DOUBLE) AS n FROM a FULL JOIN b ON a.asset_id = b.asset_id AND a.dt = b.dt""")
def _(v):
    a = v.panel.where("asset_id % 3 <> 0").select("asset_id", "dt", "price", "volume", F.lit(0.0).alias("n"))
    b = v.panel.where("asset_id % 5 <> 0").select("asset_id", "dt", (F.col("price") * 2).alias("price"), "mcap", F.col("n").cast("double").alias("n"))
    return jn.combine_first(a, b, ["asset_id", "dt"], drop_left=["n"])


@query("joi07_cross_listings", "", """
WITH u AS (SELECT c_custkey AS id, c_nationkey AS market, c_acctbal AS bal, CAST(floor(c_custkey / 3) AS BIGINT) AS isin FROM customer),
p AS (SELECT isin, id, market, ROW_NUMBER() OVER (PARTITION BY isin ORDER BY bal DESC, id) AS rn, COUNT(*) OVER (PARTITION BY isin) AS n FROM u)
SELECT u.isin, p.id AS primary_id, u.id AS other_id, u.market AS other_market FROM u JOIN p ON u.isin = p.isin AND p.rn = 1 AND p.n > 1 WHERE u.id <> p.id AND u.market <> p.market""")
def _(v):
    u = v.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("market"), F.col("c_acctbal").alias("bal"), F.floor(F.col("c_custkey") / 3).alias("isin"))
    return jn.cross_listings(u, "isin", "id", "market", "bal")


@query("joi08_depository_receipts", "", """
SELECT p.p_partkey, p.p_type, CAST(s.s_nationkey AS DOUBLE) AS home_ccy FROM part p LEFT JOIN supplier s ON p.p_partkey = s.s_suppkey WHERE p_type IN ('PROMO', 'ECONOMY')""")
def _(v):
    und = v.supplier.select(F.col("s_suppkey").alias("p_partkey"), F.col("s_nationkey").cast("double").alias("home_ccy"))
    return jn.depository_receipts(v.part.select("p_partkey", "p_type"), und, "p_partkey", "p_type", ["PROMO", "ECONOMY"])


@query("joi09_share_classes", "", """
WITH x AS (SELECT p_partkey AS asset_id, CAST(floor(p_partkey / 4) AS BIGINT) AS issuer, p_type AS cls, p_retailprice AS cap FROM part),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY issuer ORDER BY CASE cls WHEN 'STANDARD' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'SMALL' THEN 2 ELSE 3 END, cap DESC, asset_id) AS rn FROM x)
SELECT issuer, asset_id, cls, cap, rn = 1 AS chosen FROM r""")
def _(v):
    x = v.part.select(F.col("p_partkey").alias("asset_id"), F.floor(F.col("p_partkey") / 4).alias("issuer"), F.col("p_type").alias("cls"), F.col("p_retailprice").alias("cap"))
    return jn.share_classes(x, "issuer", "asset_id", "cls", ["STANDARD", "LARGE", "SMALL"], "cap").select("issuer", "asset_id", "cls", "cap", "chosen")


def _at(v, d):
    return v.sparse.where(F.col("dt") == day(d))


@query("joi10_leavers", "sparse", """
SELECT industry, COUNT(*) AS n_leavers FROM sparse p WHERE dt = DATE '1998-03-01' AND NOT EXISTS (SELECT 1 FROM sparse c WHERE c.dt = DATE '1998-04-01' AND c.asset_id = p.asset_id) GROUP BY 1""")
def _(v):
    return jn.leavers(_at(v, "1998-03-01").select("asset_id", "industry"), _at(v, "1998-04-01"), ["asset_id"], ["industry"])


@query("joi11_join_leave", "sparse", """
WITH p AS (SELECT * FROM sparse WHERE dt = DATE '1998-03-01'), c AS (SELECT * FROM sparse WHERE dt = DATE '1998-04-01')
SELECT COALESCE(p.asset_id, c.asset_id) AS asset_id, CASE WHEN p.asset_id IS NULL THEN 'joiner' ELSE 'leaver' END AS status, COALESCE(c.industry, p.industry) AS industry, COALESCE(c.mcap, p.mcap) AS mcap
FROM p FULL JOIN c ON p.asset_id = c.asset_id WHERE p.asset_id IS NULL OR c.asset_id IS NULL""")
def _(v):
    return jn.join_leave(_at(v, "1998-03-01"), _at(v, "1998-04-01"), "asset_id", ["industry", "mcap"])


@query("joi12_missing_from", "sparse", """
WITH u AS (SELECT asset_id FROM sparse WHERE dt = DATE '1998-04-01')
SELECT asset_id, 'classified' AS source FROM (SELECT p_partkey AS asset_id FROM part WHERE p_size < 10 EXCEPT SELECT asset_id FROM u) a
UNION ALL SELECT asset_id, 'previous' FROM (SELECT asset_id FROM sparse WHERE dt = DATE '1998-03-01' EXCEPT SELECT asset_id FROM u) b""")
def _(v):
    refs = {"classified": v.part.where("p_size < 10").select(F.col("p_partkey").alias("asset_id")), "previous": _at(v, "1998-03-01")}
    return jn.missing_from(_at(v, "1998-04-01"), refs, "asset_id")


@query("joi13_compare_estu", "sparse", """
WITH a AS (SELECT * FROM sparse WHERE volume > 20), b AS (SELECT * FROM sparse WHERE mcap > 30000),
j AS (SELECT COALESCE(a.dt, b.dt) AS dt, a.mcap AS x, b.mcap AS y FROM a FULL JOIN b ON a.asset_id = b.asset_id AND a.dt = b.dt)
SELECT dt, COUNT(x + y) AS n_common, SUM(CASE WHEN y IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_left, SUM(CASE WHEN x IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_right,
 ROUND(SUM(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN x ELSE 0 END), 2) AS cap_common, ROUND(SUM(CASE WHEN y IS NULL THEN x ELSE 0 END), 2) AS cap_left, ROUND(SUM(CASE WHEN x IS NULL THEN y ELSE 0 END), 2) AS cap_right FROM j GROUP BY dt""")
def _(v):
    out = jn.compare_estu(v.sparse.where("volume > 20"), v.sparse.where("mcap > 30000"), "asset_id", "mcap")
    return out.withColumns({c: F.round(c, 2) for c in ("cap_common", "cap_left", "cap_right")})


@query("joi14_interval_faults", "validity", """
WITH i AS (SELECT id, from_dt, CASE WHEN id % 3 = 0 THEN thru_dt + 40 WHEN id % 3 = 1 THEN GREATEST(thru_dt - 10, from_dt + 1) ELSE thru_dt END AS thru_dt FROM (SELECT * FROM validity WHERE thru_dt < DATE '9999-01-01') v),
w AS (SELECT *, LAG(thru_dt) OVER (PARTITION BY id ORDER BY from_dt, thru_dt) AS prev_thru FROM i)
SELECT id, from_dt, prev_thru, CASE WHEN prev_thru > from_dt THEN 'overlap' ELSE 'gap' END AS fault FROM w WHERE prev_thru <> from_dt""")
def _(v):
    i = v.validity.where("thru_dt < '9999-01-01'").select(
        "id", "from_dt", F.when(F.col("id") % 3 == 0, F.date_add("thru_dt", 40)).when(F.col("id") % 3 == 1, F.greatest(F.date_sub("thru_dt", 10), F.date_add("from_dt", 1))).otherwise(F.col("thru_dt")).alias("thru_dt")
    )
    return jn.interval_faults(i, ["id"])


@query("joi14_identifier_clashes", "", "SELECT p_name, MIN(p_partkey) AS first_id, MAX(p_partkey) AS last_id, COUNT(*) AS n_rows FROM part GROUP BY 1 HAVING MIN(p_partkey) <> MAX(p_partkey)")
def _(v):
    return jn.identifier_clashes(v.part, "p_name", "p_partkey")


@query("joi15_tighten", "validity", """
WITH life AS (SELECT id, MIN(from_dt) - 100 AS f, MAX(CASE WHEN thru_dt < DATE '9999-01-01' THEN thru_dt END) AS t FROM validity GROUP BY id), pr AS (SELECT o_custkey AS id, MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) + 1 AS hi FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT life.id, GREATEST(f, lo) AS from_dt, LEAST(t, hi) AS thru_dt FROM life JOIN pr ON life.id = pr.id WHERE GREATEST(f, lo) < LEAST(t, hi)""")
def _(v):
    life = v.validity.groupBy("id").agg(F.date_sub(F.min("from_dt"), 100).alias("from_dt"), F.max(F.when(F.col("thru_dt") < day("9999-01-01"), F.col("thru_dt"))).alias("thru_dt"))
    px = v.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("date").alias("dt"))
    return jn.tighten(life.where("thru_dt is not null"), px, "id")


_RULES = """rules AS (SELECT * FROM (VALUES ('small', 'A'), ('small ri', 'B'), ('red', 'C'), ('large w', 'D'), ('blue', 'E')) t(prefix, target))"""


@query("joi16_map_by_prefix", "", "WITH " + _RULES + """,
m AS (SELECT p_partkey, p_name, target, ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY length(prefix) DESC) AS rn FROM part LEFT JOIN rules ON starts_with(p_name, prefix))
SELECT p_partkey, p_name, target FROM m WHERE rn = 1""")
def _(v):
    rules = v.spark.createDataFrame([("small", "A"), ("small ri", "B"), ("red", "C"), ("large w", "D"), ("blue", "E")], "prefix string, target string")
    return jn.map_by_prefix(v.part.select("p_partkey", "p_name"), rules, "p_name", "prefix", "target", [3, 4, 5, 7, 8])


@query("joi17_priority", "items", """
WITH a AS (SELECT asset_id, dt, value FROM items WHERE item = '1-URGENT'), b AS (SELECT asset_id, dt, value FROM items WHERE item = '2-HIGH'), c AS (SELECT asset_id, dt, value FROM items WHERE item = '5-LOW'),
k AS (SELECT asset_id, dt FROM a UNION SELECT asset_id, dt FROM b UNION SELECT asset_id, dt FROM c)
SELECT k.asset_id, k.dt, COALESCE(a.value, b.value, c.value) AS value, CASE WHEN a.value IS NOT NULL THEN 0 WHEN b.value IS NOT NULL THEN 1 ELSE 2 END AS source FROM k LEFT JOIN a USING (asset_id, dt) LEFT JOIN b USING (asset_id, dt) LEFT JOIN c USING (asset_id, dt)""")
def _(v):
    pick = lambda i: v.items.where(F.col("item") == i).select("asset_id", "dt", "value")
    return jn.priority([pick("1-URGENT"), pick("2-HIGH"), pick("5-LOW")], ["asset_id", "dt"], "value")


@query("joi17_prefer_override", "items", """
WITH h AS (SELECT asset_id, item, dt, ROW_NUMBER() OVER (PARTITION BY asset_id ORDER BY dt, item) AS rn FROM (SELECT asset_id, dt, MIN(item) AS item FROM items WHERE dt >= DATE '1997-01-01' GROUP BY 1, 2) q)
SELECT c_custkey AS asset_id, CASE WHEN h.item IN ('1-URGENT', '2-HIGH') AND c_mktsegment IN ('BUILDING', 'FURNITURE') THEN h.item ELSE c_mktsegment END AS industry FROM customer LEFT JOIN h ON h.asset_id = c_custkey AND rn = 1""")
def _(v):
    hist = v.items.groupBy("asset_id", "dt").agg(F.min("item").alias("industry"))
    base = v.customer.select(F.col("c_custkey").alias("asset_id"), F.col("c_mktsegment").alias("industry"))
    return jn.prefer_override(base, hist, "asset_id", "industry", "1997-01-01", ["1-URGENT", "2-HIGH"], ["BUILDING", "FURNITURE"])


@query("joi18_best_match", "panel market", """
WITH te AS (SELECT p.asset_id, m.region AS idx, ROUND(stddev_samp(p.ret - m.mret), 9) AS te, abs(p.region - m.region) AS off FROM panel p JOIN market m ON p.dt = m.dt WHERE p.ret IS NOT NULL GROUP BY 1, 2, 4),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY asset_id ORDER BY te, off, idx) AS rn FROM te) SELECT asset_id, idx, ROUND(te, 6) AS te FROM r WHERE rn = 1""")
def _(v):
    # candidates: each asset against the few regional indices
    j = v.panel.where("ret is not null").select("asset_id", "dt", "region", "ret").join(v.market.select(F.col("region").alias("idx"), "dt", "mret"), "dt")
    te = j.groupBy("asset_id", "idx", F.abs(F.col("region") - F.col("idx")).alias("off")).agg(F.round(F.stddev_samp(F.col("ret") - F.col("mret")), 9).alias("te"))
    return jn.best_match(te, "asset_id", "idx", [F.col("te"), F.col("off")]).select("asset_id", "idx", F.round("te", 6).alias("te"))


_FUNDS = """f AS (SELECT asset_id, mi, region, ret FROM panel WHERE ret IS NOT NULL),
i AS (SELECT CAST(country AS BIGINT) AS idx, mi, ANY_VALUE(region) AS region, AVG(ret) AS iret FROM panel WHERE ret IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT 100 + region, mi, region, mret FROM market),
size AS (SELECT CAST(country AS BIGINT) AS idx, COUNT(DISTINCT asset_id) AS n_assets FROM panel GROUP BY 1 UNION ALL SELECT 100 + region, COUNT(DISTINCT asset_id) FROM panel GROUP BY region),
own AS (SELECT asset_id, COUNT(*) % 7 + 1 AS n_assets FROM panel GROUP BY 1)"""


@query("joi18_match_funds", "panel market", "WITH " + _FUNDS + """,
t AS (SELECT f.asset_id, i.idx, COUNT(*) AS n, ROUND(stddev_samp(f.ret - i.iret), 9) AS te FROM f JOIN i ON f.mi = i.mi AND f.region = i.region GROUP BY 1, 2 HAVING COUNT(*) >= 12),
r AS (SELECT t.*, ROW_NUMBER() OVER (PARTITION BY asset_id ORDER BY te, abs(size.n_assets - own.n_assets), idx) AS place FROM t JOIN size USING (idx) JOIN own USING (asset_id))
SELECT asset_id, idx, ROUND(te, 6) AS te, n, place FROM r WHERE place <= 3""")
def _(v):
    """Suppliers as funds against country averages and regional markets of their own region."""
    f = v.panel.where("ret is not null").select("asset_id", "mi", "region", "country", "ret")
    i = f.groupBy(F.col("country").cast("bigint").alias("idx"), "mi").agg(F.avg("ret").alias("ret"))
    i = i.unionByName(v.market.select((F.col("region") + 100).cast("bigint").alias("idx"), "mi", F.col("mret").alias("ret")))
    place = F.array(F.col("region").cast("string"))
    size = v.panel.groupBy(F.col("country").cast("bigint").alias("idx")).agg(F.count_distinct("asset_id").alias("n_assets"), F.any_value("region").alias("region"))
    size = size.unionByName(v.panel.groupBy("region").agg(F.count_distinct("asset_id").alias("n_assets")).select((F.col("region") + 100).cast("bigint").alias("idx"), "n_assets", "region"))
    own = v.panel.groupBy("asset_id").agg((F.count("*") % 7 + 1).alias("n_assets"), F.any_value("region").alias("region"))
    out = jn.match_funds(f, i, "asset_id", "idx", "mi", "ret", 12, None, 3, own.select("asset_id", place.alias("countries"), "n_assets"), size.select("idx", place.alias("countries"), "n_assets"), block=8)
    return out.select("asset_id", "idx", F.round("te", 6).alias("te"), "n", "place")


@query("joi19_asset_to_model", "", """
WITH own AS (SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN 'm1' WHEN s_nationkey < 9 THEN 'm2' END AS m FROM supplier),
sc AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 >= s_suppkey % 4 THEN 'm2' ELSE 'm3' END AS m FROM supplier)
SELECT s.s_suppkey AS asset_id, s.s_nationkey AS market, COALESCE(own.m, sc.m) AS model FROM supplier s JOIN own USING (s_suppkey) JOIN sc USING (s_suppkey)""")
def _(v):
    u = v.supplier.select(F.col("s_suppkey").alias("asset_id"), F.col("s_nationkey").alias("market"))
    n = v.nation.select(F.col("n_nationkey").alias("market"))
    m = n.where("market < 5").select(F.lit("m1").alias("model"), F.lit(1).alias("position"), "market")
    m = m.unionByName(n.where("market < 9").select(F.lit("m2").alias("model"), F.lit(2).alias("position"), "market"))
    m = m.unionByName(n.where("market < 0").select(F.lit("m3").alias("model"), F.lit(3).alias("position"), "market"))
    m = m.unionByName(v.spark.range(1).select(F.lit("m3").alias("model"), F.lit(3).alias("position"), F.lit(-1).alias("market")))
    s = u.select("asset_id", F.lit("m2").alias("model"), (F.col("asset_id") % 3).alias("score")).unionByName(u.select("asset_id", F.lit("m3").alias("model"), (F.col("asset_id") % 4).alias("score")))
    return jn.asset_to_model(u, m, s, "asset_id", "market")


@query("joi20_merge_nodes", "", """
WITH u AS (SELECT n_name AS name, 'a' AS model FROM nation UNION ALL SELECT CASE WHEN c_custkey % 2 = 0 THEN concat('NATION_', c_custkey) ELSE c_name END, 'b' FROM customer WHERE c_custkey < 60),
n AS (SELECT name, COUNT(DISTINCT model) AS k FROM u GROUP BY 1)
SELECT u.name, u.model, CASE WHEN k > 1 THEN concat_ws('-', u.name, u.model) ELSE u.name END AS node FROM u JOIN n ON u.name = n.name""")
def _(v):
    a = v.nation.select(F.col("n_name").alias("name"))
    b = v.customer.where("c_custkey < 60").select(F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("NATION_"), F.col("c_custkey"))).otherwise(F.col("c_name")).alias("name"))
    return jn.merge_nodes(a, b, "name", ("a", "b")).select("name", "model", "node")


@query("joi21_coverage", "validity", """
WITH c AS (SELECT v.id, CASE WHEN c_nationkey < 12 THEN 'east' ELSE 'west' END AS model, v.from_dt, v.thru_dt FROM validity v JOIN customer ON id = c_custkey WHERE v.status <> 'P'),
g AS (SELECT *, CASE WHEN LAG(thru_dt) OVER (PARTITION BY id, model ORDER BY from_dt) >= from_dt THEN 0 ELSE 1 END AS s FROM c),
h AS (SELECT *, SUM(s) OVER (PARTITION BY id, model ORDER BY from_dt) AS grp FROM g),
m AS (SELECT id, model, MIN(from_dt) AS f, MAX(thru_dt) AS t FROM h GROUP BY id, model, grp),
x AS (SELECT id, model, f, LEAST(t, DATE '1998-01-01') AS t FROM m WHERE f < DATE '1998-01-01' UNION ALL SELECT id, model, GREATEST(f, DATE '1999-01-01'), t FROM m WHERE t > DATE '1999-01-01')
SELECT id, model, f AS from_dt, t AS thru_dt FROM x WHERE f < t""")
def _(v):
    home = v.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") < 12, "east").otherwise("west").alias("model"))
    iss = spread(v.validity.where("status <> 'P'").select("id", "from_dt", "thru_dt"), ["id"]).join(home, "id")
    rules = v.spark.createDataFrame([("east", "1900-01-01"), ("west", "1900-01-01")], "model string, f string").select("model", F.col("f").cast("date").alias("from_dt"), day(bt.OPEN_END).alias("thru_dt"))
    excl = iss.select("id", "model").distinct().withColumn("from_dt", day("1998-01-01")).withColumn("thru_dt", day("1999-01-01"))
    return jn.coverage(iss, rules, "id", ["model"], excl)


@query("joi22_model_universe", "validity", """
SELECT v.id, 'east' AS model, v.from_dt, v.thru_dt, c_nationkey AS home, c_nationkey IN (3, 4) AS nursery FROM validity v JOIN customer ON id = c_custkey WHERE c_nationkey < 12 AND v.from_dt <= DATE '1998-01-15' AND DATE '1998-01-15' < v.thru_dt""")
def _(v):
    home = v.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("home"))
    cover = v.validity.select("id", "from_dt", "thru_dt").join(home, "id").withColumn("model", F.when(F.col("home") < 12, "east").otherwise("west")).drop("home")
    return jn.model_universe(cover, home, "id", "east", "1998-01-15", [3, 4]).select("id", "model", "from_dt", "thru_dt", "home", "nursery")
