"""Screening, clipping, masking and universe filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import columns as fc
from riskloom.operators.ranks import percentiles
from riskloom.functions.columns import div


def screen(df: DataFrame, cols: Sequence[str], fill: float | None = None) -> DataFrame:
    """NaN, infinities and nulls of ``cols`` to null, or to ``fill``."""
    return df.withColumns({c: fc.screen(F.col(c), fill) for c in cols})


def mask_by_from(df: DataFrame, from_dates: DataFrame, key: str, value: str, dt: str = "dt", mask_first: bool = False) -> DataFrame:
    """Missing to 0, then cells before (or on) the asset's first date to null."""
    j = df.join(from_dates.select(key, F.col("from_dt").alias("_f")), key, "left")
    early = (F.col(dt) <= F.col("_f")) if mask_first else (F.col(dt) < F.col("_f"))
    return j.withColumn(value, F.when(early, None).otherwise(F.coalesce(F.col(value), F.lit(0.0)))).drop("_f")


def ipo_dates(intervals: DataFrame, key: str, spac: DataFrame | None = None) -> DataFrame:
    """First from_dt per key; former shells start on their merger date."""
    out = intervals.groupBy(key).agg(F.min("from_dt").alias("from_dt"))
    if spac is None:
        return out
    out = out.join(spac.select(key, F.col("eff_dt").alias("_e")), key, "left")
    return out.withColumn("from_dt", F.greatest("from_dt", "_e")).drop("_e")


def clip_extrema(df: DataFrame, value: str, pct: float = 0.05, keys: Sequence[str] = ()) -> DataFrame:
    """Clip to the C-th value from each end, C = min(100, round(N pct)), nulls counted as 0.

    The bounds are order statistics, found without sorting the group in one task.
    """
    keys = list(keys)
    x = df.select(*keys, F.coalesce(F.col(value), F.lit(0.0)).cast("double").alias("_v"))
    bounds = _edge_values(x, keys, pct)
    if keys:
        j = df.join(bounds, keys, "left")
    else:
        j = df.withColumn("_one", F.lit(1)).join(bounds.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return j.withColumn(value, fc.clip(F.col(value), F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def _edge_values(x: DataFrame, keys: list[str], pct: float) -> DataFrame:
    """Values at sorted positions C and N - C - 1."""
    from riskloom.operators.ranks import order_bucket
    from pyspark.sql import Window as W

    x = x.withColumn("_b", order_bucket(F.col("_v")))
    hist = x.groupBy(*keys, "_b").agg(F.count("*").alias("_c"))
    w = W.partitionBy(*keys)
    hist = hist.withColumn("_n", F.sum("_c").over(w)).withColumn(
        "_o", F.sum("_c").over(w.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)) - F.col("_c")
    )
    c = F.least(F.lit(100), F.rint(F.col("_n") * F.lit(pct)).cast("long"))
    hist = hist.withColumn("_c1", c).withColumn("_c2", F.col("_n") - c - 1)
    inside = lambda p: (F.col(p) >= F.col("_o")) & (F.col(p) < F.col("_o") + F.col("_c"))
    hit = hist.where(inside("_c1") | inside("_c2")).select(*keys, "_b", "_o", "_c1", "_c2")
    r = x.join(hit, keys + ["_b"]).groupBy(*keys, "_b", "_o", "_c1", "_c2", "_v").agg(F.count("*").alias("_m"))
    wb = W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    r = r.withColumn("_e", F.col("_o") + F.sum("_m").over(wb)).withColumn("_s", F.col("_e") - F.col("_m"))
    at = lambda p: F.max(F.when((F.col(p) >= F.col("_s")) & (F.col(p) < F.col("_e")), F.col("_v")))
    return r.groupBy(*keys).agg(at("_c1").alias("_lo"), at("_c2").alias("_hi"))


def blend(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str, dt: str, start, end) -> DataFrame:
    """Linear weights between two dates; each side fills the other's gaps; outside, one side."""
    o = old.select(*keys, F.col(value).alias("_o"))
    n = new.select(*keys, F.col(value).alias("_n"))
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    ratio = F.lit(1.0) - div(F.datediff(F.col(dt), s), F.datediff(e, s))
    mix = F.coalesce("_o", "_n") * ratio + (F.lit(1.0) - ratio) * F.coalesce("_n", "_o")
    out = F.when(F.col(dt) < s, F.col("_o")).when(F.col(dt) > e, F.col("_n")).otherwise(mix)
    return o.join(n, list(keys), "full_outer").select(*keys, out.alias(value))


def is_binary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """True when a factor holds at most two distinct values.

    Two extremes and a test for anything between them: no distinct set is kept.
    """
    b = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    between = (F.col(value) != F.col("_lo")) & (F.col(value) != F.col("_hi"))
    return df.join(b, list(keys)).groupBy(*keys).agg((F.sum(F.when(between, 1).otherwise(0)) == 0).alias("is_binary"))


def non_empty(df: DataFrame, axis: Sequence[str], value: str, zeros_missing: bool = False, empty: bool = False) -> DataFrame:
    """Assets or dates with at least one value (or the empty ones)."""
    ok = F.col(value).isNotNull()
    if zeros_missing:
        ok = ok & (F.col(value) != 0)
    g = df.groupBy(*axis).agg(F.sum(F.when(ok, 1).otherwise(0)).alias("n_values"))
    return g.where("n_values = 0" if empty else "n_values > 0")


def by_type(univ: DataFrame, col: str, include: Sequence[str] = (), exclude: Sequence[str] = (), prefix: bool = False) -> DataFrame:
    """Keep ``include`` types or drop ``exclude`` types; ``prefix`` matches leading text."""

    def match(vals: Sequence[str]) -> Column:
        if not prefix:
            return F.col(col).isin(*vals)
        m = F.lit(False)
        for v in vals:
            m = m | F.col(col).startswith(v)
        return m

    if include:
        univ = univ.where(match(include))
    if exclude:
        univ = univ.where(~F.coalesce(match(exclude), F.lit(False)))
    return univ


def by_classification(univ: DataFrame, cls: DataFrame, key: str, code: str, codes: Sequence) -> DataFrame:
    """Keep assets whose code is listed, and assets without one."""
    j = univ.join(cls.select(key, F.col(code).alias("_code")), key, "left")
    return j.where(F.col("_code").isNull() | F.col("_code").isin(*codes)).drop("_code")


def apply_exclusions(univ: DataFrame, excluded: DataFrame, key: str, dt: str | None = None) -> DataFrame:
    """Drop excluded assets; with ``dt``, only inside the exclusion's interval."""
    if dt is None:
        return univ.join(excluded.select(key).distinct(), key, "left_anti")
    e = excluded.select(F.col(key).alias("_k"), F.col("from_dt").alias("_f"), F.col("thru_dt").alias("_t"))
    on = (F.col(key) == F.col("_k")) & (F.col("_f") <= F.col(dt)) & (F.col(dt) < F.col("_t"))
    return univ.join(e, on, "left_anti")


def drop_sparse(univ: DataFrame, non_missing: str, non_zero: str, floor: float = 0.75) -> DataFrame:
    """Keep assets whose trading score, clip(non_missing + non_zero - 1, 0, 1), reaches the floor."""
    score = fc.clip(F.col(non_missing) + F.col(non_zero) - 1, 0.0, 1.0)
    return univ.where(score >= F.lit(floor))


def drop_sparse_two_floors(univ: DataFrame, non_missing: str, non_zero: str, floor: float = 0.95, zero_floor: float = 0.5) -> DataFrame:
    """Older form: separate floors for non-missing and non-zero shares."""
    return univ.where((F.col(non_missing) >= F.lit(floor)) & (F.col(non_zero) >= F.lit(zero_floor)))


def filter_by_score(univ: DataFrame, score: str, lo: float, hi: float, keys: Sequence[str] = (), base: DataFrame | None = None) -> DataFrame:
    """Keep rows inside Hazen percentiles of the base set."""
    keys = list(keys)
    q = percentiles(univ if base is None else base, keys, score, {"_lo": lo, "_hi": hi}).drop("n")
    if not keys:
        univ, q, keys = univ.withColumn("_one", F.lit(1)), q.withColumn("_one", F.lit(1)), ["_one"]
    j = univ.join(q, keys)
    return j.where(F.col(score).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi", "_one")


def exclude_rows(df: DataFrame, excl: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose (date, id) is listed."""
    return df.join(excl.select(*keys).distinct(), list(keys), "left_anti")


def prune(ids: DataFrame, usage: DataFrame, key: str, kinds: Sequence[str], col: str = "kind") -> DataFrame:
    """Keep ids of the wanted usage classes."""
    return ids.join(usage.where(F.col(col).isin(*kinds)).select(key).distinct(), key, "left_semi")


def rmg_status(markets: DataFrame, dt: str, overrides: dict[str, float] | None = None, key: str = "market") -> DataFrame:
    """Life-cycle weight per market row with ``full_dt`` and ``fade_dt``; overrides win."""
    wt = fc.lifecycle_weight(F.col(dt), F.col("full_dt"), F.col("fade_dt"))
    for name, value in (overrides or {}).items():
        wt = F.when(F.col(key) == name, F.lit(float(value))).otherwise(wt)
    return markets.withColumn("weight", wt)


def cap_market_share(caps: DataFrame, market: str, cap: str, limit: float, blend_factor: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """Scale a market's caps so that its share of the total does not exceed ``limit``.

    The scale is phased in by ``blend_factor`` (0 leaves caps alone, 1 applies it whole).
    """
    by = list(by)
    sums = caps.groupBy(*by, market).agg(F.sum(cap).alias("_m"))
    total = sums.groupBy(*by).agg(F.sum("_m").alias("_t"))
    if by:
        s = sums.join(total, by)
    else:
        s = sums.withColumn("_one", F.lit(1)).join(total.withColumn("_one", F.lit(1)), "_one").drop("_one")
    # share after scaling: a m / (a m + t - m) = limit
    scale = div(F.lit(limit) * (F.col("_t") - F.col("_m")), F.col("_m") * F.lit(1.0 - limit))
    s = s.withColumn("scale", 1 - F.lit(blend_factor) * (1 - F.least(F.lit(1.0), scale))).drop("_m", "_t")
    return caps.join(s, [*by, market]).withColumn(cap, F.col(cap) * F.col("scale")).drop("scale")


def factors_on(factors: DataFrame, used: DataFrame, key: str, on_date) -> DataFrame:
    """Factors alive on a date with a status: ok, unused (alive, no asset) or dead (used, not alive)."""
    d = F.lit(on_date).cast("date")
    live = factors.where((F.col("from_dt") <= d) & (d < F.col("thru_dt"))).select(key, F.lit(True).alias("_a")).distinct()
    u = used.select(key, F.lit(True).alias("_u")).distinct()
    j = live.join(u, key, "full_outer")
    status = F.when(F.col("_a").isNull(), "dead").when(F.col("_u").isNull(), "unused").otherwise("ok")
    return j.select(key, status.alias("status"))
