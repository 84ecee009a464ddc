"""Windows, lags and series along time.

Input panels hold one row per key and date. A window partition is one key's history, so its
size is the length of the calendar and does not grow with the number of keys. ``step`` is an
integer position on the trading calendar; ranges over it treat absent rows as missing.
"""

from __future__ import annotations

import math
from itertools import accumulate
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from riskloom.functions import columns as fc, linalg
from riskloom.operators.bitemporal import newest
from riskloom.functions.columns import div


def month_index(dt: str) -> Column:
    """Months since year 0: the calendar position of a monthly panel."""
    return (F.year(dt) * 12 + F.month(dt)).cast("long")


# --- products -----------------------------------------------------------------------------


def product_over(f: Column, w: WindowSpec) -> Column:
    """Product of factors over a window; right for zero and negative factors, nulls skipped."""
    return _product(lambda c: F.sum(c).over(w), f)


def product_agg(f: Column) -> Column:
    """Product of factors as an aggregate."""
    return _product(F.sum, f)


def _product(total, f: Column) -> Column:
    zero = total(F.when(f == 0, 1).otherwise(0))
    neg = total(F.when(f < 0, 1).otherwise(0))
    size = F.exp(F.coalesce(total(F.when(f != 0, F.log(F.abs(f)))), F.lit(0.0)))
    return F.when(zero > 0, F.lit(0.0)).otherwise(F.when(neg % 2 == 1, -size).otherwise(size))


def _hist(keys: Sequence[str], order: str) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order)


def last_steps(keys: Sequence[str], step: str, n: int, until: int = 0) -> WindowSpec:
    """The last ``n`` calendar steps ending ``until`` steps back."""
    return _hist(keys, step).rangeBetween(-(n - 1) - until, -until)


# --- weights ------------------------------------------------------------------------------


def exp_weight(age: Column, half_life: float) -> Column:
    """2^(-age / half_life), age 0 the newest; normalise by the sum where needed."""
    return F.pow(F.lit(2.0), -age / F.lit(float(half_life)))


def triangle_weight(pos: Column, n: int, peak: int) -> Column:
    """Rises from the oldest (pos 1) to ``peak`` steps before the end and falls to the newest."""
    return F.when(pos <= n - peak, pos / float(n - peak + 1)).otherwise((F.lit(n + 1) - pos) / float(max(peak, 1)))


def pyramid_weight(pos: Column, n: int, newest_ramp: int, oldest_ramp: int) -> Column:
    """Flat between a ramp up from the oldest end and a ramp down to the newest end."""
    oldest_ramp = min(oldest_ramp, n - newest_ramp)
    up = F.least(F.lit(1.0), pos / float(oldest_ramp + 1))
    return F.when(pos <= n - newest_ramp, up).otherwise((F.lit(n + 1) - pos) / float(max(newest_ramp, 1)))


# --- basic --------------------------------------------------------------------------------


def weighted_return(panel: DataFrame, by: Sequence[str], ret: str, weight: str, name: str) -> DataFrame:
    """Weighted mean return of the rows that have one."""
    live = panel.where(F.col(ret).isNotNull())
    return live.groupBy(*by).agg((div(F.sum(F.col(weight) * F.col(ret)), F.sum(weight))).alias(name))


def latest(df: DataFrame, keys: Sequence[str], value: str, dt: str = "dt") -> DataFrame:
    """Last value of a dated list and its date."""
    s = F.max(F.struct(F.col(dt).alias("d"), F.col(value).alias("v"))).alias("_s")
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(s).select(*keys, F.col("_s.v").alias(value), F.col("_s.d").alias(dt))


def period_ends(dates: DataFrame, freq: str, dt: str = "dt") -> DataFrame:
    """Weekly: the next date's weekday is lower; monthly: the month changes; rolling: the last date's weekday.

    ``dates`` is the calendar: one row per date.
    """
    d = dates.select(dt).distinct()
    if freq == "rolling":
        last = d.agg(F.dayofweek(F.max(dt)).alias("_d")).withColumn("_one", F.lit(1))
        return d.withColumn("_one", F.lit(1)).join(last, "_one").where(F.dayofweek(dt) == F.col("_d")).select(dt)
    nxt = F.lead(dt).over(W.orderBy(dt))
    d = d.withColumn("_n", nxt)
    if freq == "weekly":
        return d.where(F.weekday("_n") < F.weekday(dt)).select(dt)
    return d.where(F.trunc("_n", "month") != F.trunc(dt, "month")).select(dt)


def period_dates(dates: DataFrame, freq: str, dt: str = "dt") -> DataFrame:
    """Calendar Fridays or month ends of the range, not after the last date."""
    r = dates.agg(F.min(dt).alias("a"), F.max(dt).alias("b"))
    d = r.select(F.explode(F.sequence("a", "b")).alias(dt))
    return d.where(F.weekday(dt) == 4) if freq == "weekly" else d.where(F.last_day(dt) == F.col(dt))


def to_period(df: DataFrame, ends: DataFrame, dt: str = "dt") -> DataFrame:
    """Adds ``period``: the first period end on or after each date.

    The calendar table maps dates to periods once; the panel then takes an equality join.
    """
    both = df.select(dt).distinct().withColumn("_e", F.lit(None).cast("date")).unionByName(
        ends.select(F.col(dt)).distinct().withColumn("_e", F.col(dt))
    )
    g = both.groupBy(dt).agg(F.max("_e").alias("_e"))
    w = W.orderBy(dt).rowsBetween(0, W.unboundedFollowing)
    cal = g.select(dt, F.first("_e", ignorenulls=True).over(w).alias("period")).where("period is not null")
    return df.join(cal, dt)


def compound(df: DataFrame, ends: DataFrame, keys: Sequence[str], value: str, dt: str = "dt", mode: str = "return", empty_as_zero: bool = False) -> DataFrame:
    """Returns compounded (or values summed or averaged) over (previous end, this end]."""
    d = to_period(df, ends, dt)
    v = F.col(value)
    if mode == "sum":
        agg = F.sum(v)
    elif mode == "mean":
        agg = F.avg(v)
    else:
        agg = product_agg(1 + v) - 1
    agg = F.when(F.count(v) > 0, agg).otherwise(F.lit(0.0) if empty_as_zero else F.lit(None).cast("double"))
    return d.groupBy(*keys, "period").agg(agg.alias(value))


def cumulative(df: DataFrame, keys: Sequence[str], ret: str, name: str = "cum", dt: str = "dt", start: Column | None = None) -> DataFrame:
    """C_t = C_{t-1} (1 + r_t); missing returns count as 0 and a missing start as 1."""
    w = _hist(keys, dt).rowsBetween(W.unboundedPreceding, 0)
    c = product_over(1 + F.coalesce(F.col(ret), F.lit(0.0)), w)
    return df.withColumn(name, c if start is None else c * F.coalesce(start, F.lit(1.0)))


def cumulative_risk_free(rates: DataFrame, ccy: str = "ccy", rate: str = "rf", dt: str = "dt") -> DataFrame:
    """Annual rates as a running product of (1 + rate)^(1/365) per calendar day to the next row.

    Dates without a rate are left out.
    """
    r = rates.where(F.col(rate).isNotNull())
    w = _hist([ccy], dt)
    days = F.coalesce(F.datediff(F.col(dt), F.lag(dt).over(w)), F.lit(0))
    r = r.withColumn("_l", F.log1p(rate) * days / 365.0)
    return r.withColumn("cum_rf", F.exp(F.sum("_l").over(w.rowsBetween(W.unboundedPreceding, 0)))).drop("_l")


def total_return(px: DataFrame, key: str = "asset_id", step: str = "step", look_back: int = 5) -> DataFrame:
    """Return against the last price of up to ``look_back`` steps.

    ``px``: price, ``fx`` (price currency in the return currency), ``split`` (factor on the
    day, 1 when none) and ``dividend``. The earlier price is brought to today's share basis
    and currency. No usable earlier price gives null.
    """
    w = _hist([key], step)
    x = px.withColumn("_cs", product_over(F.coalesce(F.col("split"), F.lit(1.0)), w.rowsBetween(W.unboundedPreceding, 0)))
    x = x.withColumn("_cd", F.sum(F.coalesce(F.col("dividend"), F.lit(0.0))).over(w.rowsBetween(W.unboundedPreceding, 0)))
    have = F.when(F.col("price") > 0, F.struct("price", "fx", "_cs", "_cd"))
    x = x.withColumn("_p", F.last(have, ignorenulls=True).over(w.rangeBetween(-look_back, -1)))
    growth = div(F.col("_cs"), F.col("_p._cs"))
    income = F.col("_cd") - F.col("_p._cd")
    ret = div((F.col("price") * growth + income) * F.col("fx"), F.col("_p.price") * F.col("_p.fx")) - 1
    return x.withColumn("ret", F.when(F.col("price") > 0, ret)).drop("_cs", "_cd", "_p")


def cash_return(rates: DataFrame, ccy: str = "ccy", rate: str = "rate", dt: str = "dt") -> DataFrame:
    """rate / 360 times the days since the previous date, at the previous date's rate."""
    w = _hist([ccy], dt)
    r = F.lag(rate).over(w) / 360.0 * F.datediff(F.col(dt), F.lag(dt).over(w))
    return rates.withColumn("cash_ret", r)


def excess(ret: DataFrame, ccy_of: DataFrame | None, rf: DataFrame, key: str = "asset_id", dt: str = "dt", forced: object = None) -> DataFrame:
    """Return less the risk-free return of the currency in force on the date (or one currency).

    ``ccy_of``: key, ccy, from_dt, thru_dt. ``rf``: ccy, dt, rf.
    """
    from riskloom.operators.bitemporal import valid_on

    if forced is not None:
        x = ret.withColumn("ccy", F.lit(forced))
    else:
        x = valid_on(ret, ccy_of.select(key, "ccy", "from_dt", "thru_dt"), [key], dt).drop("from_dt", "thru_dt")
    return x.join(rf.select("ccy", dt, "rf"), ["ccy", dt], "left").withColumn("excess", F.col("ret") - F.coalesce("rf", F.lit(0.0)))


def fx_returns(fx: DataFrame, rf: DataFrame, numeraire, ccy: str = "ccy", dt: str = "dt") -> DataFrame:
    """Currency return: rate change plus local less numeraire risk-free return."""
    w = _hist([ccy], dt)
    r = fx.withColumn("fx_ret", div(F.col("rate"), F.lag("rate").over(w)) - 1)
    num = rf.where(F.col(ccy) == numeraire).select(dt, F.col("rf").alias("_n"))
    j = r.join(rf.select(ccy, dt, "rf"), [ccy, dt], "left").join(num, dt, "left")
    return j.withColumn("ret", F.col("fx_ret") + F.coalesce("rf", F.lit(0.0)) - F.coalesce("_n", F.lit(0.0))).drop("_n")


def overlap(df: DataFrame, keys: Sequence[str], value: str, n: int, name: str, dt: str = "dt") -> DataFrame:
    """Product over the row and its next n - 1 older rows, less 1 (series taken newest first)."""
    w = _hist(keys, dt).rowsBetween(-(n - 1), 0)
    full = F.count(F.col(value)).over(w) == n
    return df.withColumn(name, F.when(full, product_over(1 + F.col(value), w) - 1))


# --- missing data -------------------------------------------------------------------------


def densify(df: DataFrame, key: str, step: str, until: Column | None = None) -> DataFrame:
    """A row for every step of each key's life; added rows hold nulls."""
    life = df.groupBy(key).agg(F.min(step).alias("_a"), F.max(step).alias("_b"))
    grid = life.select(key, F.explode(F.sequence(F.col("_a"), F.col("_b") if until is None else until)).alias(step))
    return grid.join(df, [key, step], "left")


def classify_missing(panel: DataFrame, first: DataFrame, trading: DataFrame, key: str = "asset_id", dt: str = "dt", market: str = "market") -> DataFrame:
    """Kind of each cell: pre_ipo, non_trading, illiquid, zero or live.

    A zero return without volume is dubious: its return becomes null. ``first``: key,
    from_dt. ``trading``: market and dt of trading days.
    """
    no_vol = F.coalesce(F.col("volume"), F.lit(0.0)) <= 0
    x = panel.withColumn("ret", F.when((F.col("ret") == 0) & no_vol, None).otherwise(F.col("ret")))
    x = x.join(first.select(key, F.col("from_dt").alias("_f")), key, "left").join(
        trading.select(market, dt, F.lit(True).alias("_t")).distinct(), [market, dt], "left"
    )
    kind = (
        F.when(F.col("_f").isNotNull() & (F.col(dt) < F.col("_f")), "pre_ipo")
        .when(F.col("_t").isNull(), "non_trading")
        .when(F.col("ret").isNull(), "illiquid")
        .when(F.col("ret") == 0, "zero")
        .otherwise("live")
    )
    return x.withColumn("kind", kind).drop("_f", "_t")


def carry_fx(df: DataFrame, key: str, ret: str, fx: str, step: str = "step") -> DataFrame:
    """Currency moves of days without a return are compounded into the next day that has one."""
    w = _hist([key], step)
    x = df.withColumn("_g", F.count(F.col(ret)).over(w.rowsBetween(W.unboundedPreceding, -1)))
    run = W.partitionBy(key, "_g").orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    moved = product_over(1 + F.coalesce(F.col(fx), F.lit(0.0)), run)
    return x.withColumn(ret, F.when(F.col(ret).isNotNull(), (1 + F.col(ret)) * moved - 1)).drop("_g")


def fill_smooth(df: DataFrame, key: str, ret: str, proxy: str, step: str = "step", pre_ipo: str | None = None) -> DataFrame:
    """Fill missing returns by proxies and keep long-run growth.

    After a gap the next real return is divided by the compounded proxies of the gap.
    A proxy whose previous step is before the first listing is not carried. ``df`` is dense.
    """
    w = _hist([key], step)
    early = F.coalesce(F.lag(pre_ipo).over(w), F.col(pre_ipo), F.lit(False)) if pre_ipo else F.lit(False)
    x = df.withColumn("_g", F.count(F.col(ret)).over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_early", early)
    f = F.when(F.col(ret).isNull() & F.col(proxy).isNotNull() & ~F.col("_early"), 1 + F.col(proxy)).otherwise(F.lit(1.0))
    run = W.partitionBy(key, "_g").orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    x = x.withColumn("_c", product_over(f, run))
    back = F.when(F.lag(ret).over(w).isNull(), F.coalesce(F.lag("_c").over(w), F.lit(1.0))).otherwise(F.lit(1.0))
    x = x.withColumn("_back", back)
    out = F.when(F.col(ret).isNotNull(), div(1 + F.col(ret), F.col("_back")) - 1).otherwise(F.col(proxy))
    return x.withColumn("filled", out).drop("_g", "_early", "_c", "_back")


def proxy_returns(panel: DataFrame, beta: DataFrame, market: DataFrame, key: str = "asset_id", mkt: str = "market", dt: str = "dt") -> DataFrame:
    """beta times the market return, beta 1 where none is known."""
    j = panel.join(beta.select(key, "beta"), key, "left").join(market.select(mkt, dt, "mret"), [mkt, dt], "left")
    return j.withColumn("proxy", F.coalesce(F.col("beta"), F.lit(1.0)) * F.col("mret"))


def timing_adjust(market_ret: DataFrame, gmt: DataFrame, market: str = "market", step: str = "step", min_gap: float = 2.0) -> DataFrame:
    """Per market, non-negative fit of its next return on later-closing markets' returns.

    Groups hold one market's design (number of markets times the window of dates), which
    does not grow with the number of assets. Output: market, step, adjustment.
    """
    w = _hist([market], step)
    y = market_ret.join(gmt, market).select(
        F.col(market).alias("_m"), step, F.col("offset").alias("_o"), F.lead("mret").over(w).alias("_y")
    )
    x = market_ret.join(gmt, market).select(F.col(market).alias("_x"), F.col("offset").alias("_ox"), step, F.col("mret").alias("_v"))
    # offset is closing time behind GMT: a larger one closes later
    d = y.join(x, step).where(F.col("_ox") - F.col("_o") > F.lit(min_gap))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        m = pdf.pivot(index=step, columns="_x", values="_v").fillna(0.0).sort_index()
        yy = pdf.drop_duplicates(step).set_index(step)["_y"].reindex(m.index)
        ok = yy.notna().to_numpy()
        a = m.to_numpy()
        b = linalg.nnls_normal((a[ok].T @ a[ok]).ravel(), a[ok].T @ yy.to_numpy()[ok])
        return pd.DataFrame({"_m": pdf["_m"].iloc[0], step: m.index.to_numpy(), "adjustment": a @ b})

    mt, st = market_ret.schema[market].dataType.simpleString(), market_ret.schema[step].dataType.simpleString()
    out = d.groupBy("_m").applyInPandas(fit, f"_m {mt}, {step} {st}, adjustment double")
    return out.withColumnRenamed("_m", market)


def apply_timing(ret: DataFrame, adj: DataFrame, trading: str, home: str, step: str = "step", market: str = "market") -> DataFrame:
    """Add the trading market's adjustment, and the home market's where that differs."""
    a = adj.select(F.col(market).alias(trading), step, F.col("adjustment").alias("_a"))
    b = adj.select(F.col(market).alias(home), step, F.col("adjustment").alias("_b"))
    j = ret.join(a, [trading, step], "left").join(b, [home, step], "left")
    extra = F.when(F.col(home) != F.col(trading), F.coalesce("_b", F.lit(0.0))).otherwise(F.lit(0.0))
    return j.withColumn("ret", F.col("ret") + F.coalesce("_a", F.lit(0.0)) + extra).drop("_a", "_b")


# --- descriptors over trailing steps ------------------------------------------------------


def momentum(df: DataFrame, key: str, ret: str, start: int, stop: int = 0, step: str = "step", log_form: bool = False, name: str = "momentum", clip_at: float = 1000.0) -> DataFrame:
    """Compound (or log) return over steps [start, stop) back, each return clipped evenly."""
    w = last_steps([key], step, start - stop, stop)
    f = 1 + fc.symmetric_clip(F.coalesce(F.col(ret), F.lit(0.0)), clip_at)
    c = F.sum(F.log(f)).over(w) if log_form else product_over(f, w) - 1
    return df.withColumn(name, c)


def momentum_weighted(df: DataFrame, key: str, ret: str, end: int, n: int, weights, step: str = "step") -> DataFrame:
    """Product of (1 + r)^w less 1 over the n steps up to ``end``; weights scaled to sum 1.

    ``weights(pos, age)`` gives a column from the position (oldest 1) and age (newest 0).
    """
    x = df.where((F.col(step) > end - n) & (F.col(step) <= end))
    age = F.lit(end) - F.col(step)
    wt = weights(F.lit(n) - age, age)
    total = sum_over_positions(weights, n)
    lr = F.log1p(fc.symmetric_clip(F.coalesce(F.col(ret), F.lit(0.0))))
    return x.groupBy(key).agg((F.exp(div(F.sum(wt * lr), total)) - 1).alias("momentum"))


def sum_over_positions(weights, n: int) -> Column:
    """Sum of a weight rule over positions 1..n."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(n)), F.lit(0.0), lambda acc, p: acc + weights(p, F.lit(n) - p))


def hist_vol(df: DataFrame, key: str, ret: str, n: int, step: str = "step", name: str = "hist_vol") -> DataFrame:
    """sqrt of the mean squared return over n steps, missing returns as 0."""
    w = last_steps([key], step, n)
    return df.withColumn(name, F.sqrt(div(F.sum(F.coalesce(F.col(ret) * F.col(ret), F.lit(0.0))).over(w), n)))


def skew(df: DataFrame, key: str, ret: str, n: int, step: str = "step", name: str = "skew") -> DataFrame:
    """Population skewness over the rows of the last n steps."""
    return df.withColumn(name, F.skewness(F.coalesce(F.col(ret), F.lit(0.0))).over(last_steps([key], step, n)))


def cross_section_vol(df: DataFrame, ret: str, by: Sequence[str], dt: str = "dt", min_share: float = 0.1) -> DataFrame:
    """Standard deviation across assets per date; null where over 90% are zero or missing."""
    v = F.col(ret)
    live = div(F.sum(F.when(v.isNotNull() & (v != 0), 1).otherwise(0)), F.count("*"))
    return df.groupBy(*by, dt).agg(F.when(live >= F.lit(min_share), F.stddev_samp(v)).alias("csv"))


def pace_vol(ret: DataFrame, csv: DataFrame, key: str, end: int, n: int, step: str = "step", half_life: float | None = None) -> DataFrame:
    """sqrt of the weighted mean of abs(r) / csv over n steps.

    A missing csv takes the last one; values under 1e-4 take the mean of the rest.
    """
    c = csv.where((F.col(step) > end - n) & (F.col(step) <= end))
    w = W.orderBy(step)  # the calendar: one row per step
    c = c.withColumn("csv", F.last("csv", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    good = F.when(F.col("csv") >= 1e-4, F.col("csv"))
    c = c.withColumn("csv", F.coalesce(good, F.avg(good).over(W.partitionBy())))
    wt = exp_weight(F.lit(end) - F.col(step), half_life) if half_life else F.lit(1.0)
    c = c.withColumn("_w", wt).withColumn("_tw", F.sum("_w").over(W.partitionBy()))
    j = ret.join(c.select(step, "csv", "_w", "_tw"), step)
    return j.groupBy(key).agg(F.sqrt(div(F.sum(div(F.col("_w") * F.abs(F.coalesce(F.col("ret"), F.lit(0.0))), F.col("csv"))), F.max("_tw"))).alias("pace_vol"))


def relative_strength(ret: DataFrame, key: str, end: int, n: int, smooth: int = 10, step: str = "step") -> DataFrame:
    """1 - 1/(1 + up/down) with weighted products of up and of down returns; no losses give 1."""
    half = div(-math.log(2.0), math.log(1.0 - div(2.0, smooth + 1.0)))
    total = sum(2.0 ** (div(-i, half)) for i in range(n))
    x = ret.where((F.col(step) > end - n) & (F.col(step) <= end))
    wt = exp_weight(F.lit(end) - F.col(step), half) / F.lit(total)
    r = F.coalesce(F.col("ret"), F.lit(0.0))
    up = F.exp(F.sum(F.log1p(F.when(r > 0, r).otherwise(0.0) * wt)))
    down = product_agg(1 + F.when(r < 0, r).otherwise(0.0) * wt)
    losses = F.sum(F.when(r < 0, r).otherwise(0.0))
    return x.groupBy(key).agg(F.when(losses == 0, F.lit(1.0)).otherwise(1 - div(1, 1 + div(up, down))).alias("rsi"))


def variance_ratio(df: DataFrame, key: str, ret: str, n: int, q: int, step: str = "step", keep_sig: float = 0.0) -> DataFrame:
    """var_q / (q var) - 1 over the last n rows per key, with finite-sample factors.

    Period returns overlap and run from the step before i to i + q, so each spans q + 1
    steps. With ``keep_sig``, values nearer to 0 than that many deviations become null.
    """
    w = _hist([key], step)
    x = df.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(F.col(step).desc()))).where(F.col("_rn") <= n)
    x = x.withColumn("_r", F.coalesce(F.col(ret), F.lit(0.0)))
    x = x.withColumn("_q", F.when(F.count("*").over(w.rowsBetween(-q, 0)) == q + 1, product_over(1 + F.col("_r"), w.rowsBetween(-q, 0)) - 1))
    m = (n - q) * (1.0 - div(q, n - 1.0))
    g = x.groupBy(key).agg(F.count("*").alias("_n"), F.var_samp("_r").alias("v1"), F.var_samp("_q").alias("vq")).where(F.col("_n") == n)
    v1 = F.col("v1") * (div(n - 1.0, n - 2.0))
    vq = F.when(F.col("vq") != 0, F.col("vq")) * (div(n - q - 1.0, m))
    out = div(vq, q * v1) - 1
    if keep_sig > 0:
        s = div(div(2.0 * (2.0 * q - 1.0) * (q - 1.0), 3.0 * q), n - 1.0)
        out = F.when(div(F.abs(out), math.sqrt(s)) >= keep_sig, out)
    return g.select(key, out.alias("variance_ratio"))


def high_low(df: DataFrame, key: str, cap: str, n: int, step: str = "step", log_form: bool = True) -> DataFrame:
    """ln(high/low) or (high - low)/(high + low) of positive caps over n steps."""
    w = last_steps([key], step, n)
    c = F.when(F.col(cap) > 0, F.col(cap))
    hi, lo = F.max(c).over(w), F.min(c).over(w)
    return df.withColumn("high_low", F.log(div(hi, lo)) if log_form else div(hi - lo, hi + lo))


def turnover(df: DataFrame, key: str, volume: str, cap: str, n: int, step: str = "step", form: str = "ratio", median: bool = False) -> DataFrame:
    """Mean or median volume over n steps as is, over cap, or ln(v + 1) - ln(cap); 0 when missing."""
    w = last_steps([key], step, n)
    v = F.percentile(volume, F.lit(0.5)).over(w) if median else F.avg(volume).over(w)
    x = df.withColumn("_v", v)
    vol, c = F.when((F.col("_v") > 0) & (F.col(cap) > 0), F.col("_v")), F.when(F.col(cap) > 0, F.col(cap))
    if form == "simple":
        out = vol
    elif form == "log":
        out = F.log(F.coalesce(vol, F.lit(0.0)) + 1) - F.log(c)
    else:
        out = div(vol, c)
    return x.withColumn("turnover", F.coalesce(out, F.lit(0.0))).drop("_v")


def amihud(df: DataFrame, key: str, ret: str, volume: str, cap: str, n: int, step: str = "step") -> DataFrame:
    """1 / mean(abs(r) / (volume / cap)) over the steps with volume, cap as of each row."""
    w = last_steps([key], step, n)
    # today's cap is constant inside the window, so it factors out of the mean
    x = F.when(F.col(volume) > 0, div(F.abs(F.col(ret)), F.col(volume)))
    mean = F.avg(x).over(w)
    c = F.when(F.col(cap) > 0, F.col(cap))
    return df.withColumn("amihud", F.when(mean > 0, div(1, mean * c)))


def volume_beta(df: DataFrame, key: str, volume: str, step: str = "step", weight: str | None = None) -> DataFrame:
    """Slope of relative volume changes on the market's mean relative change."""
    w = _hist([key], step)
    v = F.when(F.col(volume) > 0, F.col(volume))
    x = df.withColumn("_c", div(v, F.lag(v).over(w)) - 1)
    wt = F.col(weight) if weight else F.lit(1.0)
    m = x.groupBy(step).agg((div(F.sum(F.coalesce("_c", F.lit(0.0)) * wt), F.sum(wt))).alias("_m"))
    return x.join(m, step).where("_c is not null").groupBy(key).agg(F.regr_slope("_c", "_m").alias("volume_beta"))


def return_scores(df: DataFrame, key: str, end: int, n: int, min_steps: int, step: str = "step", kind: str = "kind") -> DataFrame:
    """Shares of non-missing and of non-zero returns over valid steps; 0 below ``min_steps``.

    ``kind`` comes from :func:`classify_missing`.
    """
    x = df.where((F.col(step) > end - n) & (F.col(step) <= end))
    cnt = lambda *ks: F.sum(F.when(F.col(kind).isin(*ks), 1).otherwise(0))
    valid = F.lit(n) - cnt("pre_ipo", "non_trading")
    g = x.groupBy(key).agg(valid.alias("valid"), cnt("illiquid").alias("_i"), cnt("zero").alias("_z"))
    share = lambda bad: F.when(F.col("valid") < min_steps, 0.0).otherwise(div(F.col("valid") - bad, F.col("valid")))
    return g.select(key, "valid", share(F.col("_i")).alias("non_missing"), share(F.col("_z")).alias("non_zero"))


def prop_non_missing(df: DataFrame, key: str, ret: str, n: int, step: str = "step") -> DataFrame:
    """Share of the last n steps that have a return."""
    return df.withColumn("prop", F.count(F.col(ret)).over(last_steps([key], step, n)) / F.lit(float(n)))


def grandfather(qualified: DataFrame, key: str, add_days: int, window: int = 61, step: str = "step", flag: str = "qualified") -> DataFrame:
    """Members by today's rule, or by qualifying on at least ``add_days`` of the last steps.

    The threshold does not exceed the largest count seen on the date less one.
    """
    w = last_steps([key], step, window)
    x = qualified.withColumn("_n", F.sum(F.when(F.col(flag), 1).otherwise(0)).over(w))
    top = x.groupBy(step).agg(F.max("_n").alias("_top"))
    x = x.join(top, step)
    need = F.least(F.lit(add_days), F.greatest(F.col("_top") - 1, F.lit(1)))
    return x.withColumn("member", F.col(flag) | (F.col("_n") >= need)).withColumnRenamed("_n", "n_qualified").drop("_top")


def roll_over(df: DataFrame, key: str, value: str, n: int, step: str = "step") -> DataFrame:
    """A missing value takes the newest one of the last n steps."""
    w = _hist([key], step).rangeBetween(-n, 0)
    return df.withColumn(value, F.last(F.col(value), ignorenulls=True).over(w))


def asof_constituents(members: DataFrame, composite: str, on_date, max_days: int, dt: str = "dt") -> DataFrame:
    """Constituents of the newest revision of each composite not older than ``max_days``."""
    d = F.lit(on_date).cast("date")
    live = members.where((F.col(dt) <= d) & (F.datediff(d, F.col(dt)) <= max_days))
    last = live.groupBy(composite).agg(F.max(dt).alias(dt))
    return live.join(last, [composite, dt])


# --- series transforms --------------------------------------------------------------------


def units(df: DataFrame, keys: Sequence[str], value: str, how: str, per_year: int, dt: str = "dt", name: str | None = None) -> DataFrame:
    """Change forms of a level series: chg, ch1, pch, pc1, pca, cch, cca, log, lin."""
    w = _hist(keys, dt)
    x = F.col(value)
    p, y = F.lag(value).over(w), F.lag(value, per_year).over(w)
    forms = {
        "lin": x, "chg": x - p, "ch1": x - y, "pch": (div(x, p) - 1) * 100, "pc1": (div(x, y) - 1) * 100,
        "pca": (F.pow(div(x, p), F.lit(float(per_year))) - 1) * 100, "cch": F.log(div(x, p)) * 100,
        "cca": F.log(div(x, p)) * 100 * per_year, "log": F.log(x),
    }
    return df.withColumn(name or how, forms[how])


def stationary(df: DataFrame, keys: Sequence[str], value: str, how: str, dt: str = "dt", year: int = 12) -> DataFrame:
    """Level and change of a series by its type; adds ``level`` and ``change``."""
    w = _hist(keys, dt)
    x = F.col(value)
    if how == "percent":
        level = x * 0.01
        return df.withColumn("level", level).withColumn("change", F.col("level") - F.lag("level").over(w))
    if how == "lin":
        return df.withColumn("level", x).withColumn("change", x - F.lag(value).over(w))
    if how == "geomlog":
        return df.withColumn("level", F.log(x)).withColumn("change", F.log(div(x, F.lag(value).over(w))))
    if how == "yoy":
        # level_t = level_{t-12} (1 + x_t): running products of every twelfth element
        d = df.withColumn("_rn", F.row_number().over(w))
        d = d.withColumn("_f", F.when(F.col("_rn") > year, 1 + x * 0.01).otherwise(F.lit(1.0))).withColumn("_p", F.col("_rn") % year)
        lane = W.partitionBy(*keys, "_p").orderBy(dt).rowsBetween(W.unboundedPreceding, 0)
        d = d.withColumn("level", product_over(F.col("_f"), lane)).drop("_rn", "_f", "_p")
        return d.withColumn("change", div(F.col("level"), F.lag("level").over(w)) - 1)
    d = df.withColumn("level", x).withColumn("change", div(x, F.lag(value).over(w)) - 1)
    if how == "geom2":
        d = d.withColumn("change", F.col("change") - F.lag("change").over(w))
    return d


def vintage(df: DataFrame, keys: Sequence[str], how: str, on_date=None, eff: str = "eff_dt", seq: str = "change_seq") -> DataFrame:
    """Initial release, latest release, or latest release before a date."""
    if how == "initial":
        return df.where(F.col(seq) == 0)
    if how == "before":
        df = df.where(F.col(eff) < F.lit(on_date).cast("date"))
    return newest(df, keys, [eff, seq])


def interpolate(df: DataFrame, key: str, value: str, dt: str = "dt", daily: bool = False) -> DataFrame:
    """Gaps filled linearly in time, ends kept flat; optionally on every calendar day."""
    if daily:
        life = df.groupBy(key).agg(F.min(dt).alias("_a"), F.max(dt).alias("_b"))
        df = life.select(key, F.explode(F.sequence("_a", "_b")).alias(dt)).join(df.select(key, dt, value), [key, dt], "left")
    w = _hist([key], dt)
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(dt).alias("d"), F.col(value).alias("v")))
    x = df.withColumn("_p", F.last(point, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    x = x.withColumn("_n", F.first(point, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing)))
    gap = F.datediff(F.col("_n.d"), F.col("_p.d"))
    line = F.col("_p.v") + div((F.col("_n.v") - F.col("_p.v")) * F.datediff(F.col(dt), F.col("_p.d")), gap)
    out = F.coalesce(F.col(value), F.when(gap > 0, line), F.col("_p.v"), F.col("_n.v"))
    return x.withColumn(value, out).drop("_p", "_n")


def trim(df: DataFrame, keys: Sequence[str], value: str, q: float, history: bool = True) -> DataFrame:
    """Clip each series at quantiles max(q, 1/(n-2)) and its mirror.

    The quantile depends on the count, so positions are found on the sorted series.
    """
    keys = list(keys)
    w = W.partitionBy(*keys)
    x = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    x = x.withColumn("_n", F.count("*").over(w)).withColumn("_i", F.row_number().over(w.orderBy("_v")) - 1)
    share = F.greatest(F.lit(q), div(1.0, F.col("_n") - 2))
    aggs = []
    for name, p in (("_lo", share), ("_hi", 1 - share)):
        x = x.withColumn(f"{name}p", F.greatest(F.lit(0.0), F.least(p, F.lit(1.0))) * (F.col("_n") - 1))
        at = F.floor(f"{name}p")
        frac = F.col(f"{name}p") - at
        aggs.append(
            (F.max(F.when(F.col("_i") == at, F.col("_v"))) + F.max(frac) * (
                F.max(F.when(F.col("_i") == F.least(at + 1, F.col("_n") - 1), F.col("_v"))) - F.max(F.when(F.col("_i") == at, F.col("_v")))
            )).alias(name)
        )
    b = x.groupBy(*keys).agg(*aggs)
    return df.join(b, keys, "left").withColumn(value, fc.clip(F.col(value), F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def uniform_month(dates: DataFrame, n: int, dt: str = "dt") -> DataFrame:
    """Exactly n days per month: the first stays, Saturdays are out, surplus late days drop.

    Months with fewer days are left out.
    """
    d = dates.select(dt).distinct().where(F.dayofweek(dt) != 7)
    w = W.partitionBy(F.trunc(dt, "month"))
    d = d.withColumn("_r", F.row_number().over(w.orderBy(dt))).withColumn("_n", F.count("*").over(w))
    return d.where((F.col("_n") >= n) & (F.col("_r") <= n)).select(dt)


def curve_returns(curve: DataFrame, kind: str, key: str = "curve", node: str = "node", value: str = "value", dt: str = "dt", a: float = 0.01) -> DataFrame:
    """First differences of a curve node's level, or of its level-log form."""
    w = _hist([key, node], dt)
    lev = F.col(value) if kind == "level" else fc.level_log(F.col(value), a)
    return curve.withColumn("_l", lev).withColumn("ret", F.col("_l") - F.lag("_l").over(w)).drop("_l")


def spread_returns(long: DataFrame, short: DataFrame, keys: Sequence[str], dt: str = "dt") -> DataFrame:
    """First difference of long less short (term spread, or nominal less real); gaps carried forward."""
    j = long.select(*keys, dt, F.col("value").alias("_l")).join(short.select(*keys, dt, F.col("value").alias("_s")), [*keys, dt], "full_outer")
    w = _hist(keys, dt)
    back = w.rowsBetween(W.unboundedPreceding, 0)
    j = j.withColumn("spread", F.last(F.col("_l") - F.col("_s"), ignorenulls=True).over(back))
    return j.withColumn("ret", F.col("spread") - F.lag("spread").over(w)).drop("_l", "_s")


def index_return(df: DataFrame, keys: Sequence[str], value: str, dt: str = "dt") -> DataFrame:
    """level / previous level - 1, skipping missing levels."""
    w = _hist(keys, dt)
    prev = F.last(F.col(value), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    return df.withColumn("ret", div(F.col(value), prev) - 1)


def roll_actions(actions: DataFrame, calendar: DataFrame, market: str, key: str, dt: str = "dt") -> DataFrame:
    """Actions on a holiday move to the market's next trading day; a day's factors multiply.

    The calendar is expanded once to (any day, trading day), from the market's earliest action on,
    then joined by equality. Actions after the last trading day keep a null trade date.
    """
    days = calendar.select(market, dt).distinct()
    earliest = actions.groupBy(market).agg(F.min(dt).alias("_least"))
    w = W.partitionBy(market).orderBy(dt)
    start = F.coalesce(F.date_add("_prev", 1), F.least("_least", F.col(dt)))
    span = days.withColumn("_prev", F.lag(dt).over(w)).join(earliest, market).select(market, F.col(dt).alias("trade_dt"), F.explode(F.sequence(start, F.col(dt))).alias(dt))
    j = actions.join(span, [market, dt], "left")
    return j.groupBy(market, key, "trade_dt").agg(product_agg(F.col("factor")).alias("factor"), F.count("*").alias("n_actions"))


def convergence(assets: DataFrame, conversions: DataFrame, key: str, ccy: str = "ccy") -> DataFrame:
    """Currency changeover events per asset whose life spans the conversion date."""
    j = assets.join(conversions, ccy)
    return j.where("from_dt <= conv_dt and conv_dt < thru_dt").select(key, ccy, "new_ccy", "conv_dt", "rate")


# --- volatility adjustment ----------------------------------------------------------------


def volatility_knots(n: int, length: int, guard: int = 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Knots of a newest-first series of ``n`` values, with first and end of the block of each.

    The newest block has ``length`` values and its knot at 0. With h half of that, rounded up, the
    other knots are length, length + h, length + 2 h, ..., each amid a block of 2 h values. A knot
    within ``guard`` values of the end, or beyond it, is the last one: it lies at the end and its
    block ends there.
    """
    h = math.ceil(length / 2)
    inner = np.arange(length, n - guard + 1, h)
    last = length + len(inner) * h
    first, end = inner - h, np.minimum(inner + h, n)
    if last - h < n:
        inner, first, end = np.append(inner, n), np.append(first, last - h), np.append(end, n)
    return np.append(0, inner), np.append(0, first), np.append(min(length, n), end)


def volatility_scale(values: np.ndarray, length: int, lo: float | None = -0.1, hi: float | None = 0.1, smooth: bool = True, guard: int = 20) -> np.ndarray:
    """Multipliers that bring a newest-first series to the newest block's volatility.

    A block's level is its mean absolute value and its multiplier the newest level over its own,
    held within (1 + lo) and (1 + hi) of the multiplier before it; three knots or fewer change nothing.
    """
    n = len(values)
    if not n:
        return np.ones(0)
    knots, first, end = volatility_knots(n, length, guard)
    if len(knots) <= 3:
        return np.ones(n)
    run = np.append(0.0, np.cumsum(np.abs(values)))
    level = (run[end] - run[first]) / (end - first)
    want = np.where((level > 0) & (level[0] > 0), level[0] / np.where(level > 0, level, 1.0), 1.0)
    low, high = 1 + (-np.inf if lo is None else lo), 1 + (np.inf if hi is None else hi)
    scale = np.array(list(accumulate(want[1:], lambda before, x: max(min(x, high * before), low * before), initial=1.0)))
    if smooth:
        return linalg.cubic_spline(knots.astype(float), scale, np.arange(n, dtype=float))
    return scale[np.searchsorted(knots, np.arange(n), side="right") - 1]


def dva(df: DataFrame, key: str, value: str, length: int, lo: float | None = -0.1, hi: float | None = 0.1, smooth: bool = True, dt: str = "dt") -> DataFrame:
    """Dynamic volatility adjustment of each factor's history.

    One group is one factor's series (a few thousand numbers at most); the step form and
    the spline form differ in how multipliers are joined between blocks.
    """
    kt, tt = df.schema[key].dataType.simpleString(), df.schema[dt].dataType.simpleString()

    def adjust(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values(dt, ascending=False)
        v = p[value].fillna(0.0).to_numpy()
        s = volatility_scale(v, length, lo, hi, smooth)
        return pd.DataFrame({key: p[key].to_numpy(), dt: p[dt].to_numpy(), "scale": s, value: v * s})

    return df.select(key, dt, value).groupBy(key).applyInPandas(adjust, f"{key} {kt}, {dt} {tt}, scale double, {value} double")


def process_returns(
    panel: DataFrame, market: DataFrame, beta: DataFrame, first: DataFrame, trading: DataFrame,
    fx: DataFrame | None = None, adjustment: DataFrame | None = None, rf: DataFrame | None = None,
    key: str = "asset_id", step: str = "step",
) -> DataFrame:
    """Returns made ready: currency, day flags, timing, proxies, smoothing, excess, in that order.

    ``panel`` is dense: key, step, dt, market, ret, volume (and ccy with ``rf`` or ``fx``).
    """
    x = panel
    if fx is not None:
        x = x.join(fx.select("ccy", step, "fx_ret"), ["ccy", step], "left")
        x = carry_fx(x, key, "ret", "fx_ret", step).drop("fx_ret")
    x = classify_missing(x, first, trading, key)
    if adjustment is not None:
        x = apply_timing(x.withColumn("_home", F.col("market")), adjustment, "market", "_home", step).drop("_home")
    x = proxy_returns(x, beta, market.select("market", "dt", "mret"), key)
    x = fill_smooth(x.withColumn("_pre", F.col("kind") == "pre_ipo"), key, "ret", "proxy", step, "_pre").drop("_pre")
    if rf is not None:
        x = x.join(rf.select("ccy", "dt", "rf"), ["ccy", "dt"], "left").withColumn("excess", F.col("filled") - F.coalesce("rf", F.lit(0.0)))
    return x


