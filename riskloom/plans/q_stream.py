"""Streams, run over what is available and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.plans.q_base import scratch
from riskloom.plans.registry import query
from riskloom.session import spread
from riskloom.streaming import incremental as inc


@query("str01_cumulative", "panel", "SELECT asset_id, mi, ROUND(product(1 + COALESCE(ret, 0)) OVER (PARTITION BY asset_id ORDER BY mi), 6) AS cum FROM panel")
def _(v):
    # files in no order of months, two a trigger: late months are taken up
    path = scratch(v, "returns")
    v.panel.select("asset_id", "mi", "ret").repartition(6, "mi").write.parquet(path)
    s = inc.read_stream(v.spark, path, 2)
    log = inc.run_available(inc.stream_cumulative(s, "asset_id", "mi", "ret"), "cumulative")
    return inc.latest(log, ["asset_id", "mi"]).withColumn("cum", F.round("cum", 6))


@query("str02_active", "revisions", """
SELECT id, dt, rev_dt, line, part, value FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY id, dt ORDER BY rev_dt DESC, line DESC, part DESC, rev_del_flag DESC, value DESC) AS rn FROM revisions) r WHERE rn = 1 AND rev_del_flag = 'N'""")
def _(v):
    # the lines of an order arrive in two triggers, in files of a size that does not grow with the tables
    path, files = scratch(v, "revisions"), spread(v.revisions, ["line", "id"])
    files.write.parquet(path)
    s = inc.read_stream(v.spark, path, max(1, int(v.spark.conf.get("spark.sql.shuffle.partitions")) // 2))
    return inc.stream_active(s, ["id", "dt"], "rev_dt", "rev_del_flag").drop("rev_del_flag")


@query("str03_windows", "", """
WITH w AS (SELECT ts, event_type, value, unnest(range(7)) AS k FROM events), x AS (SELECT CAST(date_trunc('day', ts) - INTERVAL 1 DAY * k AS TIMESTAMP) AS start, event_type, value FROM w),
g AS (SELECT start, event_type, AVG(value) AS mean, stddev_samp(value) AS std, COUNT(*) AS n FROM x GROUP BY 1, 2)
SELECT start, start + INTERVAL 7 DAY AS "end", event_type, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, n FROM g""")
def _(v):
    s = inc.read_stream(v.spark, f"{v.sf_dir}/events*.parquet")
    out = inc.stream_windows(s, "event_type", "ts", "value", "7 days", "1 day")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")
