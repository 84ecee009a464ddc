"""Covariances, averages, market portfolios and distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.operators.crossprod import gram
from riskloom.operators.ranks import mad_bounds, median, percentiles, running_by_rank
from riskloom.session import cut, stored
from riskloom.functions.columns import corr, div


# --- covariance of factor series (number of factors and dates bounded) --------------------


def scaled_series(df: DataFrame, factor: str, value: str, step: str, half_life: float | None = None, demean: bool = True) -> DataFrame:
    """Series with weights scaled to sum to T and the weighted mean taken out; nulls as 0.

    ``df`` is dense: each factor has a row for every step. Adds ``w`` and ``x``, and ``t``,
    the position of the step, 1 the oldest.
    """
    cal = df.select(step).distinct()
    w = W.orderBy(step)  # the calendar: one row per date of the window
    cal = cal.withColumn("t", F.row_number().over(w)).withColumn("n_obs", F.count("*").over(W.partitionBy()))
    raw = F.pow(F.lit(2.0), -(F.col("n_obs") - F.col("t")) / F.lit(float(half_life))) if half_life else F.lit(1.0)
    cal = cal.withColumn("_r", raw)
    cal = cal.withColumn("w", div(F.col("_r") * F.col("n_obs"), F.sum("_r").over(W.partitionBy()))).drop("_r")
    x = df.select(factor, step, F.coalesce(F.col(value), F.lit(0.0)).alias("x")).join(cal, step)
    if demean:
        m = x.groupBy(factor).agg((div(F.sum(F.col("w") * F.col("x")), F.max("n_obs"))).alias("_m"))
        x = x.join(m, factor).withColumn("x", F.col("x") - F.col("_m")).drop("_m")
    return x


def covariance(df: DataFrame, factor: str, value: str, step: str, half_life: float | None = None, demean: bool = True, lag: int = 0) -> DataFrame:
    """Weighted covariance (f1, f2, value); divisor T - 1, or T when not demeaned.

    With a lag, f1 is read ``lag`` steps earlier than f2.
    """
    x = scaled_series(df, factor, value, step, half_life, demean)
    n = F.col("n_obs") - 1 if demean else F.col("n_obs")
    x = x.withColumn("v", div(F.sqrt("w") * F.col("x"), F.sqrt(n)))
    return lagged_products(x, factor, lag)


def lagged_products(x: DataFrame, factor: str, lag: int) -> DataFrame:
    """sum over t of v[f1, t - lag] v[f2, t] from columns ``factor``, ``t`` and ``v``."""
    if lag == 0:
        return gram(x, "t", factor, "v").withColumnsRenamed({"i": "f1", "j": "f2"})
    # both copies become columns of one row per step: marked names keep them apart
    now = x.select("t", F.concat(F.lit("b|"), F.col(factor)).alias("f"), "v")
    old = x.select((F.col("t") + lag).alias("t"), F.concat(F.lit("a|"), F.col(factor)).alias("f"), "v")
    g = gram(now.unionByName(old), "t", "f", "v").where(F.col("i").startswith("a|") & F.col("j").startswith("b|"))
    return g.select(F.substring("i", 3, 1000).alias("f1"), F.substring("j", 3, 1000).alias("f2"), "value")


def newey_west(df: DataFrame, factor: str, value: str, step: str, lags: int, half_life: float | None = None, demean: bool = True) -> DataFrame:
    """C0 plus (1 - l/(L+1)) (C_l + C_l') over the lags."""
    x = scaled_series(df, factor, value, step, half_life, demean)
    n = F.col("n_obs") - 1 if demean else F.col("n_obs")
    x = x.withColumn("v", div(F.sqrt("w") * F.col("x"), F.sqrt(n)))
    out = lagged_products(x, factor, 0)
    for l in range(1, lags + 1):
        c = lagged_products(x, factor, l).withColumn("value", F.col("value") * F.lit(1.0 - l / (lags + 1.0)))
        out = out.unionByName(c).unionByName(c.select(F.col("f2").alias("f1"), F.col("f1").alias("f2"), "value"))
    return out.groupBy("f1", "f2").agg(F.sum("value").alias("value"))


def to_correlation(cov: DataFrame, fill: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Correlations; rows of zero or negative variance become ``fill``; the diagonal is 1."""
    by = list(by)
    d = cov.where("f1 = f2").select(*by, F.col("f1").alias("_f"), F.when(F.col("value") > 0, F.col("value")).alias("_v"))
    a = d.withColumnsRenamed({"_f": "f1", "_v": "_v1"})
    b = d.withColumnsRenamed({"_f": "f2", "_v": "_v2"})
    j = cov.join(a, [*by, "f1"]).join(b, [*by, "f2"])
    c = F.when(F.col("f1") == F.col("f2"), F.lit(1.0)).otherwise(div(F.col("value"), F.sqrt(F.col("_v1") * F.col("_v2"))))
    return j.select(*by, "f1", "f2", F.coalesce(c, F.lit(fill).cast("double")).alias("corr"))


# --- averages -----------------------------------------------------------------------------


def effective_n(df: DataFrame, keys: Sequence[str], weight: str, name: str = "eff_n") -> DataFrame:
    """(sum w)^2 / sum w^2, 0 when the sum is not positive."""
    s = F.sum(weight)
    return df.groupBy(*keys).agg(F.when(s > 0, div(s * s, F.sum(F.col(weight) * F.col(weight)))).otherwise(0.0).alias(name))


def sample_std(df: DataFrame, keys: Sequence[str], value: str, name: str = "std") -> DataFrame:
    """N - 1 standard deviation."""
    return df.groupBy(*keys).agg(F.stddev_samp(value).alias(name))


def robust_average(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None, k: float = 1.345, rounds: int = 3, buckets: int = 4096) -> DataFrame:
    """Weighted Huber location per key; fewer than two values give 0, rows without value or weight do not count.

    The scale is the MAD of weighted residuals about their median, first about the weighted mean and once
    more about the mean reweighted by that; no spread leaves the centre there. With the scale given, the sum
    of clipped residuals falls in straight pieces as the centre rises, with a bend on each side of every
    value. A round adds the bends up in ``buckets`` of the interval that holds the zero, one row a bucket, and
    goes on inside the bucket in which the sign changes; three rounds leave 1.5e-11 of the first interval, and
    the last piece is solved as a line. The number of jobs depends neither on keys nor on values.
    """
    keys = list(keys)
    x = df.select(*keys, F.col(value).alias("_v"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w")).where("_v is not null and _w > 0")
    x = stored(x)
    e = F.sqrt("_w") * (F.col("_v") - F.col("_c"))

    def scaled(centre: DataFrame) -> DataFrame:
        r = _keyed(x, centre, keys).withColumn("_e", e)
        away = _keyed(r, median(r, keys, "_e", "_m").drop("n"), keys).withColumn("_d", F.abs(F.col("_e") - F.col("_m")))
        return _keyed(r, median(away, keys, "_d", "_s").select(*keys, (F.col("_s") / 0.67449).alias("_s")), keys)

    first = x.groupBy(*keys).agg(div(F.sum(F.col("_w") * F.col("_v")), F.sum("_w")).alias("_c"), F.count("*").alias("_n"))
    start = cut(first)
    u = F.when(F.col("_s") > 0, F.least(F.lit(1.0), div(F.lit(k) * F.col("_s"), F.greatest(F.abs(F.col("_e")), F.lit(1e-300))))).otherwise(1.0) * F.col("_w")
    once = scaled(start).groupBy(*keys, "_n").agg(div(F.sum(u * F.col("_v")), F.sum(u)).alias("_c"), F.max("_s").alias("_s0"))
    once = cut(once)
    reach = F.lit(k) * F.col("_s") / F.sqrt("_w")
    ends = scaled(once.where("_s0 > 0").select(*keys, "_c", "_n")).groupBy(*keys, "_n", "_c", "_s").agg(F.min(F.col("_v") - reach).alias("_lo"), F.max(F.col("_v") + reach).alias("_hi"))
    state = cut(ends)
    for _ in range(rounds):
        state = cut(_narrowed(_keyed(x, state.where("_s > 0"), keys), state, keys, k, buckets))
    zero = state.select(*keys, F.when(F.col("_s") > 0, (F.col("_lo") + F.col("_hi")) / 2).otherwise(F.col("_c")).alias("_z"))
    out = _left(once, zero, keys)
    return out.select(*keys, F.when(F.col("_n") < 2, 0.0).otherwise(F.coalesce("_z", "_c")).alias("average"))


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str], k: float, buckets: int) -> DataFrame:
    """The part of each key's interval (_lo, _hi) in which the sum of clipped residuals changes its sign."""
    width = (F.col("_hi") - F.col("_lo")) / buckets
    reach = F.lit(k) * F.col("_s") / F.sqrt("_w")
    bends = rows.withColumn("_bend", F.explode(F.array(F.struct((F.col("_v") - reach).alias("at"), (-F.col("_w")).alias("slope")), F.struct((F.col("_v") + reach).alias("at"), F.col("_w").alias("slope")))))
    # the sum at the interval's low end, and its slope there
    low = F.greatest(-reach, F.least(reach, F.col("_v") - F.col("_lo"))) * F.col("_w")
    at_low = rows.groupBy(*keys).agg(F.sum(low).alias("_sum"), F.sum(F.when((F.col("_v") - reach <= F.col("_lo")) & (F.col("_v") + reach > F.col("_lo")), -F.col("_w")).otherwise(0.0)).alias("_slope"))
    place = F.least(F.lit(buckets - 1), F.greatest(F.lit(0), F.floor((F.col("_bend.at") - F.col("_lo")) / width)))
    inside = bends.where("_bend.at > _lo AND _bend.at < _hi").groupBy(*keys, F.when(width > 0, place).otherwise(0).alias("_k"))
    sums = inside.agg(F.sum("_bend.slope").alias("_ds"), F.sum(F.col("_bend.slope") * (F.col("_bend.at") - F.col("_lo"))).alias("_dm"))
    # sums at the end of every bucket that has bends; between two of them the sum is a line
    run = W.partitionBy(*keys).orderBy("_k").rowsBetween(W.unboundedPreceding, 0) if keys else W.orderBy("_k").rowsBetween(W.unboundedPreceding, 0)
    each = _left(_keyed(state.where("_s > 0"), at_low, keys), sums, keys).withColumn("_ds", F.sum("_ds").over(run)).withColumn("_dm", F.sum("_dm").over(run))
    end = width * (F.col("_k") + 1)
    value = F.col("_sum") + F.col("_slope") * end + F.coalesce(F.col("_ds") * end - F.col("_dm"), F.lit(0.0))
    each = each.withColumn("_value", value).withColumn("_fall", F.col("_slope") + F.coalesce("_ds", F.lit(0.0)))
    # the last bucket end at or above zero, and the first one below
    pick = each.groupBy(*keys, "_n", "_c", "_s", "_lo", "_hi", "_sum", "_slope").agg(
        F.max_by(F.struct("_k", "_value", "_fall"), F.when(F.col("_value") >= 0, F.col("_k"))).alias("_a"), F.min(F.when(F.col("_value") < 0, F.col("_k"))).alias("_b")
    )
    begin = F.coalesce(F.col("_lo") + width * (F.col("_a._k") + 1), F.col("_lo"))
    height, fall = F.coalesce("_a._value", "_sum"), F.coalesce("_a._fall", "_slope")
    stop = F.coalesce(F.col("_lo") + width * F.col("_b"), F.col("_hi"))  # the begin of the bucket whose end is below zero
    guess = F.when(fall < 0, begin - height / fall).otherwise(begin)
    # the zero is on the line that goes on from the last end, or in the bucket that brought the change
    on_line = guess <= stop
    lo, hi = F.when(on_line, guess).otherwise(F.greatest(begin, stop)), F.when(on_line, guess).otherwise(F.least(F.col("_hi"), stop + width))
    return pick.select(*keys, "_n", "_c", "_s", lo.alias("_lo"), hi.alias("_hi"))


def _left(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    if keys:
        return a.join(b, keys, "left")
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")


def _keyed(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    if keys:
        return a.join(b, keys)
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one")


def average_cap(df: DataFrame, key: str, cap: str, n: int, step: str, name: str = "avg_cap") -> DataFrame:
    """Mean positive cap over n steps; where there is none, over the n steps before."""
    c = F.when(F.col(cap) > 0, F.col(cap))
    w = W.partitionBy(key).orderBy(step)
    return df.withColumn(name, F.coalesce(F.avg(c).over(w.rangeBetween(1 - n, 0)), F.avg(c).over(w.rangeBetween(1 - 2 * n, -n))))


def iqr_bounds(df: DataFrame, keys: Sequence[str], value: str, n_dev: float, lo: float = 25.0, hi: float = 75.0) -> DataFrame:
    """Hazen quartiles (or deciles) moved out by ``n_dev`` times their distance."""
    from riskloom.operators.ranks import spread_bounds

    return spread_bounds(df, keys, value, n_dev, lo, hi)


# --- markets ------------------------------------------------------------------------------


def market_portfolio(
    caps: DataFrame, by: Sequence[str], key: str, cap: str, top_n: int | None = None, coverage: float | None = None,
    root: bool = False, foreign: str | None = None, warn_above: float = 0.30,
) -> DataFrame:
    """Cap (or root-cap) weights of the largest lines, up to a count or a cumulative share.

    Foreign lines' caps are halved. The line that crosses the coverage is kept. ``heavy``
    marks weights above the warning level.
    """
    by = list(by)
    c = F.col(cap) * F.when(F.col(foreign), 0.5).otherwise(1.0) if foreign else F.col(cap)
    x = caps.where(F.col(cap) > 0).withColumn("_c", c)
    r = running_by_rank(x, by, "_c", key, {"_run": "_c"})
    if top_n is not None:
        r = r.where(F.col("rank") <= top_n)
    if coverage is not None:
        r = r.where((F.col("_run") - F.col("_c")) < F.lit(coverage) * F.col("_run_total"))
    r = r.withColumn("_w", F.sqrt("_c") if root else F.col("_c"))
    t = r.groupBy(*by).agg(F.sum("_w").alias("_t"))
    out = _keyed(r, t, by).withColumn("weight", div(F.col("_w"), F.col("_t")))
    return out.select(*by, key, "rank", "weight", (F.col("weight") > warn_above).alias("heavy"))


def eligible_market(univ: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """First rule that excludes each asset, or ``eligible``; rules are tried in order."""
    why = F.lit(None).cast("string")
    for name, cond in reversed(list(steps)):
        why = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(why)
    return univ.withColumn("status", F.coalesce(why, F.lit("eligible")))


def market_return(weights: DataFrame, returns: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """Weights of the previous date times returns; missing returns count 0, live weights scaled to 1."""
    j = weights.join(returns, [*by, key], "left")
    live = F.when(F.col("ret").isNotNull(), F.col("weight"))
    return j.groupBy(*by).agg((div(F.sum(F.col("weight") * F.coalesce("ret", F.lit(0.0))), F.sum(live))).alias("mret"), F.count("ret").alias("n"))


def market_vol(df: DataFrame, by: Sequence[str], ret: str, n_dev: float = 8.0, min_share: float = 0.1) -> DataFrame:
    """Cross-sectional N - 1 deviation after a MAD clip; null when over 90% do not trade."""
    by = list(by)
    b = mad_bounds(df, by, ret, n_dev, 0.0)
    j = df.join(b, by, "left")
    v = F.when(F.col("lower").isNull(), F.col(ret)).otherwise(F.when(F.col(ret).isNotNull(), F.greatest("lower", F.least("upper", ret))))
    live = div(F.sum(F.when(F.col(ret).isNotNull() & (F.col(ret) != 0), 1).otherwise(0)), F.count("*"))
    return j.groupBy(*by).agg(F.when(live >= F.lit(min_share), F.stddev_samp(v)).alias("mvol"))


def replicate_index(univ: DataFrame, by: Sequence[str], key: str, cap: str, liquidity: str, pool: int, bands: Sequence[tuple[str, int]]) -> DataFrame:
    """Sub-index of each member: cap ranks among the ``pool`` most liquid lines, cut at band ends.

    Lines outside the pool, or beyond the last band, form the rest (``small``).
    """
    liq = running_by_rank(univ, by, liquidity, key).withColumnRenamed("rank", "liq_rank").drop("n")
    liquid = running_by_rank(liq.where(F.col("liq_rank") <= pool), by, cap, key).withColumnRenamed("rank", "cap_rank").drop("n")
    band = F.lit("small")
    for name, last in reversed(list(bands)):
        band = F.when(F.col("cap_rank") <= last, F.lit(name)).otherwise(band)
    rest = liq.where(F.col("liq_rank") > pool).withColumn("cap_rank", F.lit(None).cast("long"))
    return liquid.unionByName(rest).withColumn("sub_index", F.when(F.col("cap_rank").isNull(), "small").otherwise(band))


def replicate_subindexes(univ: DataFrame, by: Sequence[str], key: str, cap: str, liquidity: str, stages: Sequence[tuple[str, int, int | None, int]], base: str | None = None, float_cap: str | None = None) -> DataFrame:
    """Sub-indexes filled one after another: univ with cap_rank, vol_rank and sub_index.

    A stage (name, members, cap pool, volume pool) takes, of lines that no stage before has taken, those within both
    pools by cap rank; where they are too few, the rest by volume rank from the volume pool alone. Stages of one name
    fill one sub-index. Caps are ``float_cap`` where that is given, and count as 0 for lines outside the ``base``
    universe; what no stage takes is ``small``, or null outside the base. Only lines within some pool are
    looked at in windows, so a window holds no more lines of a date than the largest pools have.
    """
    by = list(by)
    worth = F.col(float_cap) if float_cap else F.col(cap)
    inside = F.coalesce(F.col(base), F.lit(False)) if base else F.lit(True)
    x = univ.withColumn("_worth", F.when(inside, F.coalesce(worth, F.lit(0.0))).otherwise(0.0))
    x = running_by_rank(x, by, "_worth", key).withColumnRenamed("rank", "cap_rank").drop("n")
    x = stored(running_by_rank(x, by, liquidity, key).withColumnRenamed("rank", "vol_rank").drop("n", "_worth"))
    most_cap, most_vol = max(c or 0 for _, _, c, _ in stages), max(v for *_, v in stages)
    near = (F.col("cap_rank") <= most_cap) | (F.col("vol_rank") <= most_vol)
    pool = x.where(near).select(*by, key, "cap_rank", "vol_rank").withColumn("sub_index", F.lit(None).cast("string"))
    for name, n, caps, volumes in stages:
        free = F.col("sub_index").isNull() & (F.col("vol_rank") <= volumes)
        both = free & (F.col("cap_rank") <= caps) if caps else free
        first = F.row_number().over(W.partitionBy(*by, "_both").orderBy("cap_rank", key))
        pool = pool.withColumn("_both", both).withColumn("_take", F.col("_both") & (first <= n))
        pool = pool.withColumn("_short", F.lit(n) - F.sum(F.col("_take").cast("int")).over(W.partitionBy(*by)))
        pool = pool.withColumn("_alt", free & ~F.col("_take"))
        second = F.row_number().over(W.partitionBy(*by, "_alt").orderBy("vol_rank", key))
        pool = pool.withColumn("_take", F.col("_take") | (F.col("_alt") & (second <= F.col("_short"))))
        pool = pool.withColumn("sub_index", F.when(F.col("_take"), F.lit(name)).otherwise(F.col("sub_index"))).drop("_both", "_take", "_short", "_alt")
    out = x.join(pool.select(*by, key, "sub_index"), [*by, key], "left")
    return out.withColumn("sub_index", F.coalesce("sub_index", F.when(inside, F.lit("small"))))


def annual_dividends(div: DataFrame, key: str, on_date, dt: str = "ex_dt", amount: str = "amount") -> DataFrame:
    """Dividends of the last year with fuzzy periodicity.

    The window is 380 days. If the newest payment is at most 60 days old, payments 350-380
    or 290-320 days before it show a yearly rhythm: the window then starts 350 days before
    the newest payment (not earlier than 380 days ago), else 320 days before it.
    """
    d = F.lit(on_date).cast("date")
    x = div.where((F.col(dt) <= d) & (F.col(dt) >= F.date_sub(d, 440)))
    last = x.groupBy(key).agg(F.max(dt).alias("_last"))
    j = x.join(last, key)
    age = F.datediff(F.col("_last"), F.col(dt))
    rhythm = F.max(F.when(age.between(350, 380) | age.between(290, 320), 1).otherwise(0))
    start = (
        F.when(F.datediff(d, F.max("_last")) > 60, F.date_sub(d, 380))
        .when(rhythm == 1, F.greatest(F.date_sub(d, 380), F.date_sub(F.max("_last"), 350)))
        .otherwise(F.date_sub(F.max("_last"), 320))
    )
    cutoff = j.groupBy(key).agg(start.alias("_from"))
    return j.join(cutoff, key).where(F.col(dt) >= F.col("_from")).groupBy(key).agg(F.sum(amount).alias("dividends"))


def descriptor_stats(df: DataFrame, by: Sequence[str], value: str, cap: str, points: dict[str, float]) -> DataFrame:
    """Count, share and cap share of non-missing values, with percentiles."""
    by = list(by)
    have = F.col(value).isNotNull()
    a = df.groupBy(*by).agg(
        F.count("*").alias("n_assets"), F.count(value).alias("n_values"), (div(F.count(value), F.count("*"))).alias("share"),
        (div(F.sum(F.when(have, F.col(cap)).otherwise(0.0)), F.sum(cap))).alias("cap_share"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
    )
    return a.join(percentiles(df, by, value, points).drop("n"), by, "left")


def churn_correlation(df: DataFrame, key: str, value: str, step: str) -> DataFrame:
    """Correlation of a descriptor between consecutive steps over the assets in both."""
    a = df.select(key, step, F.col(value).alias("_a"))
    b = df.select(key, (F.col(step) + 1).alias(step), F.col(value).alias("_b"))
    return a.join(b, [key, step]).groupBy(step).agg(corr("_a", "_b").alias("corr"), F.count("*").alias("n"))


def dual_histogram(a: DataFrame, b: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts of two samples over common bins (limits of both, top value in the last bin)."""
    u = a.select(F.col(value).alias("_v"), F.lit("a").alias("_s")).unionByName(b.select(F.col(value).alias("_v"), F.lit("b").alias("_s"))).where("_v is not null")
    lim = u.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    j = _keyed(u, lim, [])
    i = F.least(F.lit(bins - 1), F.floor(div(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * bins)).cast("long")
    j = j.withColumn("bin", F.coalesce(i, F.lit(0).cast("long")))
    cnt = lambda s: F.sum(F.when(F.col("_s") == s, 1).otherwise(0))
    return j.groupBy("bin").agg(cnt("a").alias("n_a"), cnt("b").alias("n_b"))


def demographics(univ: DataFrame, by: Sequence[str], groups: Sequence[str], cap: str) -> DataFrame:
    """Count, cap, cap share and effective N per group of a date, with totals over the groups.

    One pass: group rows come out of a partial aggregate and totals are its roll-up.
    """
    by, groups = list(by), list(groups)
    g = univ.groupBy(*by, *groups).agg(F.count("*").alias("n"), F.sum(cap).alias("cap"), F.sum(F.col(cap) * F.col(cap)).alias("_c2"))
    t = g.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("cap").alias("cap"), F.sum("_c2").alias("_c2"))
    for c in groups:
        t = t.withColumn(c, F.lit(None).cast(univ.schema[c].dataType))
    u = g.unionByName(t)
    total = t.select(*by, F.col("cap").alias("_t"))
    return u.join(total, by).select(*by, *groups, "n", "cap", (div(F.col("cap"), F.col("_t"))).alias("share"), (div(F.col("cap") * F.col("cap"), F.col("_c2"))).alias("eff_n"))


def dummies(df: DataFrame, col: str, levels: Sequence, prefix: str = "") -> DataFrame:
    """0/1 exposure per level; the levels are given, so one projection does it."""
    return df.withColumns({f"{prefix}{l}": F.when(F.col(col) == l, 1.0).otherwise(0.0) for l in levels})


def top_n_weights(lines: DataFrame, by: Sequence[str], key: str, cap: str, n: int) -> DataFrame:
    """Root-cap weights of the n largest lines."""
    return market_portfolio(lines, by, key, cap, top_n=n, root=True).drop("heavy")


def free_float(caps: DataFrame, ff: DataFrame, key: str, cap: str) -> DataFrame:
    """Cap times free float, full float where none is known."""
    return caps.join(ff.select(key, "free_float"), key, "left").withColumn(cap, F.col(cap) * F.coalesce("free_float", F.lit(1.0))).drop("free_float")


def down_weight(caps: DataFrame, weights: dict, market: str, cap: str) -> DataFrame:
    """Caps of chosen markets multiplied by a weight."""
    f = F.lit(1.0)
    for m, w in weights.items():
        f = F.when(F.col(market) == m, F.lit(float(w))).otherwise(f)
    return caps.withColumn(cap, F.col(cap) * f)


def asset_age(first: DataFrame, key: str, on_date, from_col: str = "from_dt") -> DataFrame:
    """Days since the first date."""
    return first.groupBy(key).agg(F.min(from_col).alias("first_dt")).withColumn("age", F.datediff(F.lit(on_date).cast("date"), F.col("first_dt")))
