"""Estimation universe rules. Ranks and running sums are split by value bucket, see ``ranks``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from riskloom.operators import cleaning as cl, timeseries as ts
from riskloom.operators.ranks import running_by_rank
from riskloom.session import stored
from riskloom.functions.columns import div


def exclude_by_cap_rank(univ: DataFrame, by: Sequence[str], key: str, cap: str, lower: float = 25.0, upper: float = 100.0, min_width: float = 10.0) -> DataFrame:
    """Per factor bucket keep the largest lines up to a cumulative cap share and the one that crosses.

    Buckets whose effective number of lines (on root caps) is not above ``min_width`` stay whole.
    """
    target = (upper - lower) / 100.0
    x = univ.withColumn("_root", F.sqrt(cap))
    r = running_by_rank(x, by, cap, key, {"_run": cap, "_rr": "_root"})
    width = div(F.col("_rr_total") * F.col("_rr_total"), F.col("_run_total"))
    keep = (width <= min_width) | (F.col("_run") - F.col(cap) < F.lit(target) * F.col("_run_total"))
    return r.where(keep).drop("_root", "_run", "_run_total", "_rr", "_rr_total", "n", "rank")


def cap_and_volume(univ: DataFrame, by: Sequence[str], key: str, cap: str, volume: str, hi: int = 1000, lo: int = 2000, buffer: float = 1.2) -> DataFrame:
    """Quota of lines that rank high by cap and by volume at once, topped up by volume.

    Only lines inside the quota bands take part in the later steps, so their windows hold a
    number of rows fixed by the quotas. Universes within the quota stay whole.
    """
    by = list(by)
    a = running_by_rank(univ, by, cap, key).withColumnsRenamed({"rank": "_rc", "n": "_n"})
    x = running_by_rank(a, by, volume, key).withColumnRenamed("rank", "_rv").drop("n")
    u1, u2 = int(hi * buffer), int((hi + lo) * buffer)
    small = x.where(F.col("_n") <= hi + lo)
    c = x.where((F.col("_n") > hi + lo) & ((F.col("_rc") <= u2) | (F.col("_rv") <= u2)))

    def take(df: DataFrame, pool, order: str, quota, name: str) -> DataFrame:
        w = W.partitionBy(*by, "_pool").orderBy(order)
        return df.withColumn("_pool", pool).withColumn(name, F.col("_pool") & (F.row_number().over(w) <= quota)).drop("_pool")

    def top_up(df: DataFrame, pool, chosen: str, quota: int, name: str) -> DataFrame:
        have = F.sum(F.when(F.col(chosen), 1).otherwise(0)).over(W.partitionBy(*by))
        df = df.withColumn("_short", F.lit(quota) - have)
        return take(df, pool & ~F.col(chosen), "_rv", F.col("_short"), name).drop("_short")

    c = take(c, (F.col("_rc") <= u1) & (F.col("_rv") <= u1), "_rc", hi, "_a")
    c = top_up(c, F.col("_rv") <= u1, "_a", hi, "_a2").withColumn("_e", F.col("_a") | F.col("_a2"))
    c = take(c, (F.col("_rc") <= u2) & (F.col("_rv") <= u2) & ~F.col("_e"), "_rc", lo, "_b")
    c = c.withColumn("_have", F.sum(F.when(F.col("_b"), 1).otherwise(0)).over(W.partitionBy(*by)))
    c = take(c, (F.col("_rv") <= u2) & ~F.col("_e") & ~F.col("_b"), "_rv", F.lit(lo) - F.col("_have"), "_b2")
    c = c.where(F.col("_e") | F.col("_b") | F.col("_b2"))
    keep = [f for f in univ.columns]
    return c.select(*keep).unionByName(small.select(*keep))


def pump_up(univ: DataFrame, by: Sequence[str], key: str, cap: str, member: str, min_width: float = 10.0, cut_off: float = 0.01) -> DataFrame:
    """Lines added to thin factor buckets, largest first.

    Adding stops once the effective number reaches ``min_width`` or one more line raised it
    by less than ``cut_off``. Output: the added lines with the width they bring.
    """
    by = list(by)
    root = F.sqrt(cap)
    now = univ.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col(member), root)), F.lit(0.0)).alias("_s1"), F.coalesce(F.sum(F.when(F.col(member), F.col(cap))), F.lit(0.0)).alias("_s2")
    )
    width = lambda a, b: F.when(b > 0, div(a * a, b)).otherwise(0.0)
    thin = now.withColumn("_w0", width(F.col("_s1"), F.col("_s2"))).where(F.col("_w0") < min_width)
    spare = univ.where(~F.col(member)).withColumn("_root", root).join(thin, by)
    r = running_by_rank(spare, by, cap, key, {"_r1": "_root", "_r2": cap})
    r = r.withColumn("width", width(F.col("_s1") + F.col("_r1"), F.col("_s2") + F.col("_r2")))
    before = width(F.col("_s1") + F.col("_r1") - F.col("_root"), F.col("_s2") + F.col("_r2") - F.col(cap))
    r = r.withColumn("_prev", F.when(F.col("rank") == 1, F.col("_w0")).otherwise(before))
    stop = (F.col("width") >= min_width) | ((F.col("_prev") != 0) & (div(F.col("width"), F.col("_prev")) - 1 < cut_off))
    last = r.groupBy(*by).agg(F.coalesce(F.min(F.when(stop, F.col("rank"))), F.max("rank")).alias("_last"))
    return r.join(last, by).where(F.col("rank") <= F.col("_last")).select(*by, key, "rank", "width")


def estimation_universe(
    univ: DataFrame, key: str = "asset_id", dt: str = "dt", cap: str = "cap", step: str = "mi", industry: str = "industry",
    types: Sequence[str] = (), lower: float = 25.0, min_score: float = 0.75, add_days: int = 10, window: int = 12, min_width: float = 10.0,
) -> DataFrame:
    """Members per date with the rule that let them in.

    Exclusions and types, cap ranks over the date and inside industries, sparse trading,
    pump-up of thin industries, then grandfathering. ``univ``: key, dt, step, cap, industry,
    asset_type, excluded, non_missing, non_zero.
    """
    x = cl.by_type(univ.where(~F.col("excluded")), "asset_type", exclude=types) if types else univ.where(~F.col("excluded"))
    x = stored(x.where(F.col(cap) > 0))
    ranked = exclude_by_cap_rank(x, [dt], key, cap, lower, 100.0, min_width)
    ranked = ranked.unionByName(exclude_by_cap_rank(x, [dt, industry], key, cap, lower, 100.0, min_width)).dropDuplicates([key, dt])
    core = cl.drop_sparse(ranked, "non_missing", "non_zero", min_score).select(key, dt, F.lit(True).alias("_m"))
    y = stored(x.join(core, [key, dt], "left").withColumn("_m", F.coalesce("_m", F.lit(False))))
    added = pump_up(y, [dt, industry], key, cap, "_m", min_width).select(key, dt, F.lit(True).alias("_p"))
    y = y.join(added, [key, dt], "left").withColumn("qualified", F.col("_m") | F.coalesce("_p", F.lit(False)))
    g = ts.grandfather(y, key, add_days, window, step)
    rule = F.when(F.col("_m"), "core").when(F.col("_p"), "pumped").otherwise("grandfathered")
    return g.where("member").select(key, dt, step, cap, rule.alias("rule"))
