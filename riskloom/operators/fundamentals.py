"""Fundamental items, ratios, growth and estimates.

Items are rows (asset, item, period date, effective date, value). Quarterly series are
processed for all quarters at once with windows over the quarter number: a partition is one
asset's quarters. Annualising, averaging and mixing follow our own definitions, stated at
each function.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.operators.bitemporal import newest
from riskloom.functions.columns import div
from riskloom.session import spread


def quarter_index(dt: str) -> Column:
    """Quarters since year 0: the position of a quarterly series."""
    return (F.year(dt) * 4 + F.quarter(dt)).cast("long")


# --- series processing --------------------------------------------------------------------


def _w(key: str, step: str):
    return W.partitionBy(key).orderBy(step)


def latest_of(value: str, key: str = "asset_id", step: str = "qi", back: int = 8) -> Column:
    """Newest value of the last ``back`` quarters."""
    return F.last(F.col(value), ignorenulls=True).over(_w(key, step).rangeBetween(1 - back, 0))


def annualised(value: str, key: str = "asset_id", step: str = "qi") -> Column:
    """Sum of four quarters; the last three must be there, three alone are scaled by 4/3."""
    w = _w(key, step)
    n, recent = F.count(F.col(value)).over(w.rangeBetween(-3, 0)), F.count(F.col(value)).over(w.rangeBetween(-2, 0))
    return F.when(recent == 3, div(F.sum(value).over(w.rangeBetween(-3, 0)) * 4.0, n))


def averaged(value: str, key: str = "asset_id", step: str = "qi", back: int = 8) -> Column:
    """Mean of the values of the last ``back`` quarters."""
    return F.avg(value).over(_w(key, step).rangeBetween(1 - back, 0))


PROCESSES = {"latest": latest_of, "annualise": annualised, "average": averaged}


def treat(c: Column, negative: str | None = None, zero: str | None = None) -> Column:
    """Negative values masked or set to zero; zero values masked or set to one."""
    if negative == "mask":
        c = F.when(c >= 0, c)
    elif negative == "zero":
        c = F.when(c < 0, 0.0).otherwise(c)
    if zero == "mask":
        c = F.when(c != 0, c)
    elif zero == "one":
        c = F.when(c == 0, 1.0).otherwise(c)
    return c


@dataclass(frozen=True)
class Ratio:
    """One descriptor: item and process of both sides and the treatment of odd values."""

    num: str
    num_process: str = "latest"
    den: str | None = None
    den_process: str = "latest"
    num_negative: str | None = None
    den_negative: str | None = None
    den_zero: str | None = "mask"
    num_multiplier: float = 1.0
    den_multiplier: float = 1.0


# The descriptor families as parameters. Items are column names.
PRICE_RATIOS = {
    "book_to_price": Ratio("book", "latest", "cap", "average"),
    "earnings_to_price": Ratio("income", "annualise", "cap", "average"),
    "sales_to_price": Ratio("sales", "annualise", "cap", "average"),
    "cash_flow_to_price": Ratio("cash_flow", "annualise", "cap", "average"),
    "debt_to_cap": Ratio("debt", "latest", "cap", "average", num_negative="zero"),
    "dividend_yield": Ratio("dividends", "annualise", "cap", "average"),
}
PROFIT_RATIOS = {
    "return_on_equity": Ratio("income", "annualise", "book", "average", den_negative="mask"),
    "return_on_assets": Ratio("income", "annualise", "assets", "average", den_negative="mask"),
    "gross_margin": Ratio("gross", "annualise", "sales", "annualise", den_negative="mask"),
    "sales_to_assets": Ratio("sales", "annualise", "assets", "average", den_negative="mask"),
    "cash_flow_to_assets": Ratio("cash_flow", "annualise", "assets", "average", den_negative="mask"),
    "cash_flow_to_income": Ratio("cash_flow", "annualise", "income", "annualise", den_negative="mask"),
    "asset_turnover": Ratio("sales", "annualise", "assets", "average", den_negative="mask"),
    "operating_cash_to_assets": Ratio("operating_cash", "annualise", "assets", "average", den_negative="mask"),
    "accruals": Ratio("accruals", "annualise", "assets", "average", den_negative="mask"),
}
BALANCE_RATIOS = {
    "debt_to_equity": Ratio("debt", "latest", "book", "latest", num_negative="zero", den_negative="mask"),
    "debt_to_assets": Ratio("debt", "latest", "assets", "latest", num_negative="zero", den_negative="mask"),
    "current_ratio": Ratio("current_assets", "latest", "current_liabilities", "latest"),
    "equity_to_assets": Ratio("book", "latest", "assets", "latest", den_negative="mask"),
    "ebitda_to_assets": Ratio("ebitda", "annualise", "assets", "average", den_negative="mask"),
    "current_items_to_assets": Ratio("current_assets", "latest", "assets", "latest", den_negative="mask"),
    "dividend_payout": Ratio("dividends", "annualise", "income", "annualise", den_negative="mask"),
}
ITEMS = {n: Ratio(n, p) for n, p in {"book": "latest", "income": "annualise", "sales": "annualise", "cost": "annualise"}.items()}


def ratio(df: DataFrame, name: str, r: Ratio, key: str = "asset_id", step: str = "qi") -> DataFrame:
    """Adds one ratio descriptor for every quarter of a wide item table."""
    num = treat(PROCESSES[r.num_process](r.num, key, step), r.num_negative) * F.lit(r.num_multiplier)
    if r.den is None:
        return df.withColumn(name, num)
    den = treat(PROCESSES[r.den_process](r.den, key, step), r.den_negative, r.den_zero) * F.lit(r.den_multiplier)
    return df.withColumn(name, div(num, den))


def ratios(df: DataFrame, table: Mapping[str, Ratio], key: str = "asset_id", step: str = "qi") -> DataFrame:
    """All ratios of a table in one pass: they share the window partitioning."""
    for name, r in table.items():
        df = ratio(df, name, r, key, step)
    return df


def mixed_frequency(df: DataFrame, num_q: str, num_a: str, den_q: str, den_a: str, name: str) -> DataFrame:
    """Quarterly over quarterly where both exist; on a mismatch both sides annual."""
    both_q = F.col(num_q).isNotNull() & F.col(den_q).isNotNull()
    den = F.when(both_q, F.col(den_q)).otherwise(F.col(den_a))
    num = F.when(both_q, F.col(num_q)).otherwise(F.col(num_a))
    return df.withColumn(name, div(num, F.when(den != 0, den)))


def payout_with_proxy(df: DataFrame, dividends: str, income: str, name: str = "payout", key: str = "asset_id", step: str = "qi") -> DataFrame:
    """Dividends over income; where income is not positive, over the mean positive income of two years."""
    inc = F.when(F.col(income) > 0, F.col(income))
    proxy = F.avg(inc).over(_w(key, step).rangeBetween(-7, 0))
    return df.withColumn(name, div(F.col(dividends), F.coalesce(inc, proxy)))


# --- growth -------------------------------------------------------------------------------


def growth(annual: DataFrame, as_of, key: str = "asset_id", dt: str = "dt", value: str = "value", forecasts: DataFrame | None = None, years: float = 4.05, variability: bool = False) -> DataFrame:
    """Slope of up to five annual values over years, over their mean absolute value.

    Values up to ``years`` before the newest count, and a forecast for the following year
    (nearest to 366 days on, within 400). Needs more than 2 (for variability, 4) distinct
    values; variability takes the sample deviation instead of the slope.
    """
    d = F.lit(as_of).cast("date")
    x = spread(annual.where((F.col(dt) <= d) & F.col(value).isNotNull()).select(key, dt, F.col(value).alias("_v")), [key])
    last = x.groupBy(key).agg(F.max(dt).alias("_last"))
    x = x.join(last, key).where(F.datediff("_last", dt) / 365.0 <= years)
    # distinct values without a set: bounded history, at most six rows a key
    n = x.groupBy(key).agg(F.count_distinct("_v").alias("_n")).where(F.col("_n") > (4 if variability else 2))
    x = x.join(n, key).select(key, dt, "_v")
    if forecasts is not None:
        f = spread(forecasts.select(key, F.col("dt").alias("_fd"), F.col("value").alias("_fv")), [key]).join(last, key)
        near = F.abs(F.datediff("_fd", F.date_add("_last", 366)))
        f = f.groupBy(key, "_last").agg(F.min_by(F.struct("_fd", "_fv"), F.struct(near, F.col("_fd"))).alias("_f"))
        f = f.where((F.col("_f._fd") > F.col("_last")) & (F.col("_f._fd") < F.date_add("_last", 400)))
        f = f.join(n, key).select(key, F.col("_f._fd").alias(dt), F.col("_f._fv").alias("_v"))
        x = x.unionByName(f)
    t = F.datediff(F.col(dt), F.lit("2000-01-01").cast("date")) / 365.0
    top = F.stddev_samp("_v") if variability else F.regr_slope(F.col("_v"), t)
    return x.groupBy(key).agg((div(top, F.avg(F.abs("_v")))).alias("variability" if variability else "growth"))


def growth_rolling(quarters: DataFrame, value: str, key: str = "asset_id", step: str = "qi", years: int = 5, forecast: str | None = None, variability: bool = False, name: str = "growth") -> DataFrame:
    """The same on annualised rolling quarters, for every quarter at once.

    Points are the annualised sums one, two, ... years back, and optionally a forecast
    column for the year ahead.
    """
    w = _w(key, step)
    x = quarters.withColumn("_a", annualised(value, key, step))
    # points at whole years back, read by quarter number so gaps stay gaps
    pts = [(0, F.col("_a"))]
    for y in range(1, years):
        pts.append((-y, F.first(F.when(F.col("_a").isNotNull(), F.col("_a")), ignorenulls=True).over(w.rangeBetween(-4 * y, -4 * y))))
    if forecast:
        pts.append((1, F.col(forecast)))
    x = x.withColumns({f"_p{i}": c for i, (_, c) in enumerate(pts)})
    cols = [F.col(f"_p{i}") for i in range(len(pts))]
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    has = [F.when(c.isNotNull(), 1.0).otherwise(0.0) for c in cols]
    n = sum(has[1:], has[0])
    ts = [float(t) for t, _ in pts]
    sx = sum((h * t for h, t in zip(has, ts)), F.lit(0.0))
    sxx = sum((h * t * t for h, t in zip(has, ts)), F.lit(0.0))
    sy = sum((zero(c) for c in cols), F.lit(0.0))
    sxy = sum((zero(c) * t for c, t in zip(cols, ts)), F.lit(0.0))
    sa = sum((F.abs(zero(c)) for c in cols), F.lit(0.0))
    if variability:
        mean = div(sy, n)
        ss = sum((h * (zero(c) - mean) * (zero(c) - mean) for h, c in zip(has, cols)), F.lit(0.0))
        top = F.sqrt(div(ss, n - 1))
    else:
        top = div(n * sxy - sx * sy, n * sxx - sx * sx)
    return x.withColumn(name, F.when(n > (4 if variability else 2), div(top, div(sa, n)))).drop("_a", *[f"_p{i}" for i in range(len(pts))])


def as_of_forecast(quarters: DataFrame, estimates: DataFrame, key: str = "asset_id", step: str = "qi", value: str = "value", keep: int = 4, name: str = "forecast") -> DataFrame:
    """Quarters with the newest estimate known in each: made in that quarter or in one of the ``keep`` - 1 before it.

    ``estimates`` has (key, step it was made in, value); of several of one quarter the last row by ``eff_dt`` counts.
    An estimate meets the ``keep`` quarters in which it can be the newest, by equality, so nothing is joined on a range.
    """
    last = estimates.groupBy(key, F.col(step).alias("_made")).agg(F.max_by(value, F.struct("eff_dt", value)).alias("_v"))
    spread = last.where("_v is not null").withColumn(step, F.explode(F.sequence(F.col("_made"), F.col("_made") + (keep - 1))))
    known = spread.groupBy(key, step).agg(F.max_by("_v", "_made").alias(name))
    return quarters.join(known, [key, step], "left")


# --- estimates ----------------------------------------------------------------------------


def clean_estimates(est: DataFrame, reported: DataFrame, as_of, key: str = "asset_id", days: int = 0, drop_stale: bool = False, shares: DataFrame | None = None) -> DataFrame:
    """Newest estimate per (asset, item, fiscal date) as known on a date.

    Fiscal dates at most ``days`` after the last reported one drop out; optionally estimates
    older than 366 days; optionally values are times the shares in force on their date.
    """
    d = F.lit(as_of).cast("date")
    x = newest(est.where(F.col("eff_dt") <= d), [key, "item", "dt"], ["eff_dt"])
    last = reported.where(F.col("dt") <= d).groupBy(key).agg(F.max("dt").alias("_last"))
    x = x.join(last, key, "left").where(F.col("_last").isNull() | (F.col("dt") > F.date_add("_last", days)))
    if drop_stale:
        x = x.where(F.datediff(d, "eff_dt") <= 366)
    if shares is not None:
        from riskloom.operators.bitemporal import valid_on

        x = valid_on(x, shares, [key], "eff_dt").withColumn("value", F.col("value") * F.col("shares")).drop("shares", "from_dt", "thru_dt")
    return x.drop("_last")


def forward_12m(est: DataFrame, as_of, key: str = "asset_id", name: str = "fwd12") -> DataFrame:
    """Blend of the current and the next fiscal year, tau = days to year end / 365.

    Current: the first fiscal year ending within 366 days. Next: 330-400 days after it and
    not estimated earlier. Without a next year the current stands alone.
    """
    d = F.lit(as_of).cast("date")
    x = est.where((F.col("dt") > d) & F.col("value").isNotNull())
    s = F.struct("dt", "eff_dt", "value")
    cur = x.where(F.datediff("dt", d) <= 366).groupBy(key).agg(F.min(s).alias("_c"))
    j = x.join(cur, key)
    gap = F.datediff(F.col("dt"), F.col("_c.dt"))
    nxt = j.where(gap.between(330, 400) & (F.col("eff_dt") >= F.col("_c.eff_dt"))).groupBy(key).agg(F.min(s).alias("_n"))
    out = cur.join(nxt, key, "left")
    tau = F.datediff(F.col("_c.dt"), d) / 365.0
    mix = F.when(F.col("_n").isNotNull(), tau * F.col("_c.value") + (1 - tau) * F.col("_n.value")).otherwise(F.col("_c.value"))
    return out.select(key, mix.alias(name))


def est_earnings_yield(fwd: DataFrame, lines: DataFrame, caps: DataFrame, key: str = "asset_id", negative: str | None = None) -> DataFrame:
    """Forward earnings of all lines of an issuer over the issuer's cap."""
    e = fwd.join(lines.select(key, "issuer"), key).groupBy("issuer").agg(F.sum("fwd12").alias("_e"))
    j = lines.select(key, "issuer").join(e, "issuer").join(caps.select("issuer", "cap"), "issuer")
    return j.select(key, (div(treat(F.col("_e"), negative), F.when(F.col("cap") > 0, F.col("cap")))).alias("est_ep"))


# Estimate items that become descriptors, with their scaling item.
EST_RATIOS = {
    "est_ebitda": Ratio("ebitda", den="enterprise_value"), "est_cash_flow": Ratio("cash_flow", den="cap"), "est_revenue": Ratio("revenue", den="cap"),
    "est_income": Ratio("income", den="cap"), "est_roe": Ratio("income", den="book", den_negative="mask"), "est_roa": Ratio("income", den="assets", den_negative="mask"),
}


def est_ratios(fwd_wide: DataFrame, table: Mapping[str, Ratio] = EST_RATIOS) -> DataFrame:
    """Estimate descriptors on a wide table of forward values and scaling items."""
    return fwd_wide.withColumns(
        {n: div(treat(F.col(r.num), r.num_negative), treat(F.col(r.den), r.den_negative, r.den_zero)) for n, r in table.items() if r.num in fwd_wide.columns and r.den in fwd_wide.columns}
    )


def est_growth(fwd: DataFrame, realised: DataFrame, key: str = "asset_id", name: str = "est_growth") -> DataFrame:
    """Forward value over the last realised annual value, less 1, over its absolute size."""
    j = fwd.join(realised.select(key, F.col("value").alias("_r")), key)
    return j.select(key, (div(F.col("fwd12") - F.col("_r"), F.when(F.col("_r") != 0, F.abs("_r")))).alias(name))


# --- other --------------------------------------------------------------------------------


def short_interest(short: DataFrame, shares: DataFrame, as_of, key: str = "asset_id") -> DataFrame:
    """Newest shares short of the last two years over newest shares outstanding."""
    d = F.lit(as_of).cast("date")
    near = lambda df, n: df.where((F.col("dt") <= d) & (F.datediff(d, "dt") <= 731)).groupBy(key).agg(F.max_by("value", "dt").alias(n))
    return near(short, "_s").join(near(shares, "_o"), key).select(key, (div(F.col("_s"), F.when(F.col("_o") > 0, F.col("_o")))).alias("short_interest"))


def share_buyback(df: DataFrame, bought: str, shares: str, key: str = "asset_id", step: str = "qi", multiplier: float = 1e6) -> DataFrame:
    """Shares bought over four quarters over shares outstanding."""
    b = F.sum(bought).over(_w(key, step).rangeBetween(-3, 0)) * multiplier
    return df.withColumn("share_buyback", div(b, F.when(F.col(shares) > 0, F.col(shares))))


def net_equity_issuance(df: DataFrame, shares: str, split: str, key: str = "asset_id", step: str = "qi", year: int = 4) -> DataFrame:
    """ln of shares now over shares a year ago brought to today's share basis."""
    w = _w(key, step)
    s = F.last(F.when(F.col(shares) > 0, F.col(shares)), ignorenulls=True)
    old = s.over(w.rangeBetween(-2 * year + 1, -year))
    adj = F.exp(F.sum(F.log(F.coalesce(F.col(split), F.lit(1.0)))).over(w.rangeBetween(-year + 1, 0)))
    return df.withColumn("net_equity_issuance", F.log(div(s.over(w.rangeBetween(-year + 1, 0)), old * adj)))


def net_debt_issuance(df: DataFrame, debt: str, key: str = "asset_id", step: str = "qi", year: int = 4) -> DataFrame:
    """ln of debt now over debt a year ago."""
    w = _w(key, step)
    d = F.last(F.when(F.col(debt) > 0, F.col(debt)), ignorenulls=True)
    return df.withColumn("net_debt_issuance", F.log(div(d.over(w.rangeBetween(-year + 1, 0)), d.over(w.rangeBetween(-2 * year + 1, -year)))))


def net_payout(df: DataFrame, income: str, book: str, sales: str, cost: str, key: str = "asset_id", step: str = "qi", years: int = 5) -> DataFrame:
    """(five years' income + book now - book five years ago) / (five years' sales - cost).

    Five different years, as its definition says.
    """
    w = _w(key, step)
    n = 4 * years
    tot = lambda c: F.sum(c).over(w.rangeBetween(1 - n, 0))
    old = F.first(F.col(book), ignorenulls=True).over(w.rangeBetween(-n, -n))
    den = tot(sales) - tot(cost)
    return df.withColumn("net_payout", div(tot(income) + F.col(book) - old, F.when(den != 0, den)))


def altman_z(df: DataFrame, name: str = "altman_z") -> DataFrame:
    """1.2 working capital + 1.4 equity + 3.3 EBITDA + 0.6 market equity + sales, over assets."""
    top = (
        1.2 * (F.col("current_assets") - F.col("current_liabilities")) + 1.4 * F.col("book") + 3.3 * F.col("ebitda") + 0.6 * F.col("cap") + F.col("sales")
    )
    return df.withColumn(name, div(top, F.when(F.col("assets") > 0, F.col("assets"))))


def roe_variability(df: DataFrame, roe: str, key: str = "asset_id", step: str = "qi", back: int = 20) -> DataFrame:
    """Sample deviation of return on equity over the last quarters."""
    return df.withColumn("roe_variability", F.stddev_samp(roe).over(_w(key, step).rangeBetween(1 - back, 0)))


def delta(df: DataFrame, value: str, key: str = "asset_id", step: str = "qi", lag: int = 4, name: str | None = None) -> DataFrame:
    """Value less its value ``lag`` quarters before."""
    old = F.first(F.col(value)).over(_w(key, step).rangeBetween(-lag, -lag))
    return df.withColumn(name or f"delta_{value}", F.col(value) - old)


def age_of(df: DataFrame, key: Sequence[str], as_of, dt: str = "dt") -> DataFrame:
    """Days since the newest value per key."""
    return df.groupBy(*key).agg(F.datediff(F.lit(as_of).cast("date"), F.max(dt)).alias("age"))
