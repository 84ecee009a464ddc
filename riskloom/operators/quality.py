"""Quality reports: each check is a DataFrame of findings, never of everything looked at."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from riskloom.operators.crossprod import pack_matrix
from riskloom.operators.ranks import mad_bounds, running_by_rank
from riskloom.functions.columns import corr, div


def _both(prev: DataFrame, curr: DataFrame, keys: Sequence[str], cols: Sequence[str], how: str = "full_outer") -> DataFrame:
    p = prev.select(*keys, *[F.col(c).alias(f"{c}_prev") for c in cols])
    c = curr.select(*keys, *[F.col(x).alias(f"{x}_curr") for x in cols])
    return p.join(c, list(keys), how)


def check_exposures(prev: DataFrame, curr: DataFrame, key: str, styles: Sequence[str], tolerance: float, group: str) -> DataFrame:
    """Style changes over a tolerance and changes of the group (industry), one row per finding."""
    j = _both(prev, curr, [key], [*styles, group], "inner")
    found = [
        F.when(F.abs(F.col(f"{s}_curr") - F.col(f"{s}_prev")) > tolerance, F.struct(F.lit(s).alias("item"), F.col(f"{s}_prev").cast("string").alias("a"), F.col(f"{s}_curr").cast("string").alias("b"), (F.col(f"{s}_curr") - F.col(f"{s}_prev")).alias("change")))
        for s in styles
    ]
    found.append(F.when(~F.col(f"{group}_curr").eqNullSafe(F.col(f"{group}_prev")), F.struct(F.lit(group).alias("item"), F.col(f"{group}_prev").cast("string").alias("a"), F.col(f"{group}_curr").cast("string").alias("b"), F.lit(None).cast("double").alias("change"))))
    e = j.select(key, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("_f"))
    return e.select(key, F.col("_f.item").alias("item"), F.col("_f.change").alias("change"))


def min_eigenvalue(cov: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Smallest eigenvalue per matrix."""

    @pandas_udf(T.DoubleType())
    def low(values: pd.Series) -> pd.Series:
        out = []
        for v in values:
            k = int(round(np.sqrt(len(v))))
            out.append(float(np.linalg.eigvalsh(np.asarray(v, float).reshape(k, k)).min()))
        return pd.Series(out)

    return pack_matrix(cov, "f1", "f2", "value", by).select(*by, low("values").alias("min_eigenvalue"))


def check_cov(prev: DataFrame, curr: DataFrame, risk_tolerance: float, corr_tolerance: float) -> DataFrame:
    """Relative changes of factor risks and changes of correlations beyond tolerances."""

    def full(c: DataFrame, tag: str) -> DataFrame:
        d = c.where("f1 = f2").select(F.col("f1").alias("_f"), F.sqrt("value").alias("_s"))
        j = c.join(d.withColumnsRenamed({"_f": "f1", "_s": "_a"}), "f1").join(d.withColumnsRenamed({"_f": "f2", "_s": "_b"}), "f2")
        return j.select("f1", "f2", F.col("_a").alias(f"risk_{tag}"), (div(F.col("value"), F.col("_a") * F.col("_b"))).alias(f"corr_{tag}"))

    j = full(prev, "p").join(full(curr, "c"), ["f1", "f2"])
    rel = div(F.col("risk_c"), F.col("risk_p")) - 1
    dif = F.col("corr_c") - F.col("corr_p")
    kind = F.when((F.col("f1") == F.col("f2")) & (F.abs(rel) > risk_tolerance), "risk").when((F.col("f1") < F.col("f2")) & (F.abs(dif) > corr_tolerance), "correlation")
    return j.withColumn("check", kind).where("check is not null").select("f1", "f2", "check", F.when(F.col("check") == "risk", rel).otherwise(dif).alias("change"))


def check_returns(rets: DataFrame, key: str, ret: str, bound: float, n_ends: int, by: Sequence[str] = ()) -> DataFrame:
    """Returns over a bound, and the n largest and smallest of each date."""
    x = rets.where(F.col(ret).isNotNull())
    top = running_by_rank(x, by, ret, key).where(F.col("rank") <= n_ends).withColumn("check", F.lit("top"))
    low = running_by_rank(x, by, ret, key, descending=False).where(F.col("rank") <= n_ends).withColumn("check", F.lit("bottom"))
    big = x.where(F.abs(ret) > bound).withColumn("rank", F.lit(None).cast("long")).withColumn("check", F.lit("bound"))
    cols = [*by, key, ret, "check", F.col("rank").cast("double").alias("rank")]
    return top.select(*cols).unionByName(low.select(*cols)).unionByName(big.select(*cols))


def year_to_date(fret: DataFrame, key: str, dt: str, value: str) -> DataFrame:
    """Compounded return since the start of the year, every date."""
    from riskloom.operators.timeseries import product_over

    w = W.partitionBy(key, F.year(dt)).orderBy(dt).rowsBetween(W.unboundedPreceding, 0)
    return fret.withColumn("ytd", product_over(1 + F.coalesce(F.col(value), F.lit(0.0)), w) - 1)


def large_moves(rets: DataFrame, ret: str, market: str, bound: float = 0.15, special: Mapping | None = None) -> DataFrame:
    """abs(log10(1 + r)) over a bound, with other bounds for some markets."""
    b = F.lit(bound)
    for m, x in (special or {}).items():
        b = F.when(F.col(market) == m, F.lit(x)).otherwise(b)
    size = F.abs(F.log10(1 + F.col(ret)))
    return rets.withColumn("log_move", size).where(size > b)


def check_risk(prev: DataFrame, curr: DataFrame, key: str, risk: str, absolute: float = 0.10, relative: float = 0.5) -> DataFrame:
    """Risks that moved by more than a tolerance, or are negative."""
    j = _both(prev, curr, [key], [risk], "inner")
    d = F.col(f"{risk}_curr") - F.col(f"{risk}_prev")
    kind = F.when(F.col(f"{risk}_curr") < 0, "negative").when(F.abs(d) > absolute, "absolute").when(F.abs(d) > relative * F.col(f"{risk}_prev"), "relative")
    return j.withColumn("check", kind).where("check is not null").select(key, "check", F.col(f"{risk}_prev"), F.col(f"{risk}_curr"), d.alias("change"))


def low_correlations(pairs: DataFrame, bound: float) -> DataFrame:
    """Linked pairs below a correlation bound."""
    return pairs.where(F.col("corr") < bound)


def beta_discrepancies(a: DataFrame, b: DataFrame, key: str, bound: float) -> DataFrame:
    """Assets whose two betas differ by more than a bound."""
    j = a.select(key, F.col("beta").alias("beta_a")).join(b.select(key, F.col("beta").alias("beta_b")), key)
    return j.withColumn("difference", F.col("beta_a") - F.col("beta_b")).where(F.abs("difference") > bound)


def check_basic(universe: DataFrame, spec: DataFrame, factors: DataFrame, fret: DataFrame, key: str = "asset_id") -> DataFrame:
    """Assets without specific risk and factors without a return."""
    a = universe.select(key).join(spec.select(key), key, "left_anti").select(F.lit("no specific risk").alias("check"), F.col(key).cast("string").alias("item"))
    b = factors.select("factor").join(fret.select("factor").distinct(), "factor", "left_anti").select(F.lit("no factor return").alias("check"), F.col("factor").alias("item"))
    return a.unionByName(b)


def date_gaps(dates: DataFrame, key: Sequence[str], step: str) -> DataFrame:
    """Steps missing between a key's consecutive rows."""
    w = W.partitionBy(*key).orderBy(step)
    x = dates.select(*key, step, F.lag(step).over(w).alias("prev"))
    return x.where(F.col(step) - F.col("prev") > 1).select(*key, F.col("prev").alias("after"), F.col(step).alias("before"), (F.col(step) - F.col("prev") - 1).alias("n_missing"))


def qa_bounds(stats: DataFrame, code: str, dt: str, value: str, n: int = 250, one_sided: Sequence[str] = ()) -> DataFrame:
    """Alert level of a statistic against the mean and deviation of its last n values.

    The level is the whole number of deviations, counted one way only for listed codes.
    """
    w = W.partitionBy(code).orderBy(dt).rowsBetween(-n, -1)
    x = stats.withColumn("mean", F.avg(value).over(w)).withColumn("std", F.stddev_samp(value).over(w))
    z = div(F.col(value) - F.col("mean"), F.when(F.col("std") > 0, F.col("std")))
    z = F.when(F.col(code).isin(*one_sided), F.greatest(z, F.lit(0.0))).otherwise(F.abs(z)) if one_sided else F.abs(z)
    return x.withColumn("level", F.floor(z)).where("level is not null")


def universe_correlation(prev: DataFrame, curr: DataFrame, keys: Sequence[str], cap: str, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of cap weights today and before over the union, missing as 0, with churn counts."""
    def weights(df: DataFrame, name: str) -> DataFrame:
        if by:
            t = df.groupBy(*by).agg(F.sum(cap).alias("_t"))
            return df.join(t, list(by)).select(*by, *keys, (div(F.col(cap), F.col("_t"))).alias(name))
        t = df.agg(F.sum(cap).alias("_t")).withColumn("_one", F.lit(1))
        return df.withColumn("_one", F.lit(1)).join(t, "_one").select(*keys, (div(F.col(cap), F.col("_t"))).alias(name))

    j = weights(prev, "_p").join(weights(curr, "_c"), [*by, *keys], "full_outer")
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return j.groupBy(*by).agg(
        corr(F.coalesce("_p", F.lit(0.0)), F.coalesce("_c", F.lit(0.0))).alias("corr"), cnt(F.col("_p").isNull()).alias("n_joined"), cnt(F.col("_c").isNull()).alias("n_left")
    )


def descriptor_jumps(desc: DataFrame, key: str, step: str, value: str, cap: str, relative: float = 1.0, n_dev: float = 30.0, least: float = 0.01, top_share: float = 0.8, window: int = 5) -> DataFrame:
    """Values that more than double and stand out from a rolling median, among the largest caps.

    A jump is over ``relative``, over ``least`` in size, and its residual from the median of
    the last values exceeds ``n_dev`` MAD scales of the asset's residuals. Only assets
    inside the top share of the date's cap count.
    """
    w = W.partitionBy(key).orderBy(step)
    x = desc.where(F.col(value).isNotNull())
    x = x.withColumn("prev", F.lag(value).over(w)).withColumn("_res", F.col(value) - F.percentile(value, F.lit(0.5)).over(w.rowsBetween(1 - window, 0)))
    b = mad_bounds(x, [key], "_res", n_dev, 0.0, history=True).select(key, "lower", "upper")
    r = running_by_rank(x, [step], cap, key, {"_run": cap})
    r = r.where(F.col("_run") - F.col(cap) < top_share * F.col("_run_total")).join(b, key)
    d = F.col(value) - F.col("prev")
    jump = (F.abs(d) > relative * F.abs("prev")) & (F.abs(d) > least) & ((F.col("_res") < F.col("lower")) | (F.col("_res") > F.col("upper")))
    return r.where(jump).select(key, step, "prev", F.col(value))


def attribute_change(prev: DataFrame, curr: DataFrame, keys: Sequence[str], num: str, den: str) -> DataFrame:
    """Change of a ratio split into what the numerator and what the denominator brought."""
    j = _both(prev, curr, keys, [num, den], "inner")
    n0, n1, d0, d1 = (F.col(f"{num}_prev"), F.col(f"{num}_curr"), F.col(f"{den}_prev"), F.col(f"{den}_curr"))
    return j.select(*keys, (div(n1, d1) - div(n0, d0)).alias("change"), (div(n1 - n0, d0)).alias("from_num"), (div(n1, d1) - div(n1, d0)).alias("from_den"))


def source_report(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float) -> DataFrame:
    """Counts of items two sources agree on, disagree on, or only one has."""
    j = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), list(keys), "full_outer")
    kind = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(F.abs(F.col("_a") - F.col("_b")) > tolerance * F.abs("_a"), "mismatch").otherwise("match")
    return j.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def stale_items(items: DataFrame, keys: Sequence[str], as_of, max_days: int, dt: str = "dt") -> DataFrame:
    """Items whose newest value is older than a limit, with their age."""
    g = items.groupBy(*keys).agg(F.max(dt).alias("last_dt"))
    g = g.withColumn("age", F.datediff(F.lit(as_of).cast("date"), "last_dt").cast("long"))
    return g.where(F.col("age") > max_days)


def age_distribution(items: DataFrame, keys: Sequence[str], as_of, bucket_days: int, dt: str = "dt") -> DataFrame:
    """Number of keys per age bucket of their newest value."""
    g = items.groupBy(*keys).agg(F.max(dt).alias("_d"))
    return g.groupBy(F.floor(div(F.datediff(F.lit(as_of).cast("date"), "_d"), bucket_days)).alias("bucket")).agg(F.count("*").alias("n"))


def market_portfolio_report(prev: DataFrame, curr: DataFrame, by: Sequence[str], key: str, weight: str, top: int = 10, jump: float = 0.01) -> DataFrame:
    """Top lines with rank change, joiners, leavers and weight jumps."""
    by = list(by)
    a = running_by_rank(prev, by, weight, key).select(*by, key, F.col("rank").alias("rank_prev"), F.col(weight).alias("weight_prev"))
    b = running_by_rank(curr, by, weight, key).select(*by, key, F.col("rank").alias("rank_curr"), F.col(weight).alias("weight_curr"))
    j = a.join(b, [*by, key], "full_outer")
    d = F.coalesce("weight_curr", F.lit(0.0)) - F.coalesce("weight_prev", F.lit(0.0))
    kind = (
        F.when(F.col("weight_prev").isNull() & (F.col("rank_curr") <= top), "joined top").when(F.col("weight_prev").isNull(), "joined").when(F.col("weight_curr").isNull(), "left")
        .when(F.abs(d) > jump, "jump").when(F.col("rank_curr") <= top, "top")
    )
    return j.withColumn("finding", kind).where("finding is not null").select(*by, key, "finding", (F.col("rank_prev") - F.col("rank_curr")).cast("double").alias("rank_change"), d.alias("weight_change"))


def exposure_autocorrelation(exp: DataFrame, key: str, step: str, styles: Sequence[str], estu: str | None = None) -> DataFrame:
    """Correlation of each style between consecutive steps over the common universe."""
    x = exp.where(F.col(estu)) if estu else exp
    a = x.select(key, step, *[F.col(s).alias(f"_a_{s}") for s in styles])
    b = x.select(key, (F.col(step) + 1).alias(step), *[F.col(s).alias(f"_b_{s}") for s in styles])
    g = a.join(b, [key, step]).groupBy(step).agg(*[corr(f"_a_{s}", f"_b_{s}").alias(s) for s in styles])
    return g.unpivot([step], list(styles), "factor", "corr")


def bias_statistic(forecast: DataFrame, realised: DataFrame, name: str, step: str, n: int, per_year: int) -> DataFrame:
    """Forecast risk against the annual deviation of the next n returns."""
    w = W.partitionBy(name).orderBy(step).rowsBetween(1, n)
    r = realised.withColumn("realised", F.when(F.count("ret").over(w) == n, F.stddev_samp("ret").over(w) * F.sqrt(F.lit(float(per_year)))))
    return forecast.join(r.select(name, step, "realised"), [name, step]).where("realised is not null").withColumn("ratio", div(F.col("risk"), F.col("realised")))


def stability(prev: DataFrame, curr: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Least, mean and largest absolute relative change; zeros are skipped."""
    j = _both(prev, curr, keys, [value], "inner").where(F.col(f"{value}_prev") != 0)
    c = F.abs(div(F.col(f"{value}_curr"), F.col(f"{value}_prev")) - 1)
    return j.agg(F.min(c).alias("min_change"), F.avg(c).alias("mean_change"), F.max(c).alias("max_change"), F.count("*").alias("n"))


def compare_libraries(a: DataFrame, b: DataFrame, keys: Sequence[str], factors: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Correlation of matching factors of two exposure tables and universe counts."""
    l = a.select(*keys, *[F.col(x).alias(f"_a_{x}") for x in factors], F.lit(1).alias("_ia"))
    r = b.select(*keys, *[F.col(y).alias(f"_b_{y}") for y in factors.values()], F.lit(1).alias("_ib"))
    j = l.join(r, list(keys), "full_outer")
    aggs = [corr(f"_a_{x}", f"_b_{y}").alias(x) for x, y in factors.items()]
    cnt = [F.sum(F.when(F.col("_ib").isNull(), 1).otherwise(0)).alias("only_a"), F.sum(F.when(F.col("_ia").isNull(), 1).otherwise(0)).alias("only_b")]
    return j.groupBy(*by).agg(*aggs, *cnt)


def id_report(assets: DataFrame, key: str, industry: DataFrame, market: DataFrame, ticker: str) -> DataFrame:
    """Assets without industry or market, and tickers carried by more than one asset."""
    a = assets.join(industry.select(key), key, "left_anti").select(F.lit("no industry").alias("check"), F.col(key).cast("string").alias("item"))
    b = assets.join(market.select(key), key, "left_anti").select(F.lit("no market").alias("check"), F.col(key).cast("string").alias("item"))
    c = assets.groupBy(ticker).agg(F.min(key).alias("_a"), F.max(key).alias("_b")).where("_a <> _b").select(F.lit("ticker clash").alias("check"), F.col(ticker).cast("string").alias("item"))
    return a.unionByName(b).unionByName(c)


def infer_actions(prev: DataFrame, curr: DataFrame, key: str, company: str, equity: DataFrame, clear: float = 0.75) -> DataFrame:
    """Mergers and spin-offs from changes of the id map.

    Old companies whose ids meet in one new company merged; the survivor has the largest
    common equity when the second is under ``clear`` of it, else it is undecided. New
    companies that share an old one were spun off. The two largest come from bounded
    aggregates, not from a sort of the group.
    """
    m = prev.select(key, F.col(company).alias("old")).join(curr.select(key, F.col(company).alias("new")), key)
    links = m.select("old", "new").distinct().join(equity.select(F.col(company).alias("old"), "equity"), "old", "left").withColumn("equity", F.coalesce("equity", F.lit(0.0)))
    g = links.groupBy("new").agg(F.count("*").alias("n"), F.max(F.struct("equity", "old")).alias("_a"))
    second = links.join(g.select("new", F.col("_a.old").alias("_top")), "new").where(F.col("old") != F.col("_top")).groupBy("new").agg(F.max("equity").alias("_second"))
    merged = g.where("n > 1").join(second, "new").select(
        F.lit("merger").alias("action"), F.col("new").alias("company"), "n", F.when(F.col("_second") < clear * F.col("_a.equity"), F.col("_a.old")).alias("survivor")
    )
    spun = links.groupBy("old").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("spin-off").alias("action"), F.col("old").alias("company"), "n", F.lit(None).cast(prev.schema[company].dataType).alias("survivor"))
    return merged.unionByName(spun)


def id_gaps(ids: DataFrame, life: DataFrame, key: str) -> DataFrame:
    """Parts of an asset's priced life without the identifier."""
    from riskloom.operators.bitemporal import merge_intervals
    from riskloom.operators.joins import subtract_intervals

    return subtract_intervals(life.select(key, "from_dt", "thru_dt"), merge_intervals(ids.select(key, "from_dt", "thru_dt"), [key]), [key])


def id_duplicates(ids: DataFrame, identifier: str, key: str) -> DataFrame:
    """Periods in which an identifier is held by two or more assets at once.

    Starts and ends become +1/-1 events per identifier and day; the running number of
    holders gives the periods, so the work grows with the intervals, not with their pairs.
    """
    from riskloom.operators.bitemporal import merge_intervals

    own = merge_intervals(ids.select(identifier, key, "from_dt", "thru_dt"), [identifier, key])
    ev = own.select(identifier, F.col("from_dt").alias("at"), F.lit(1).alias("_s")).unionByName(own.select(identifier, F.col("thru_dt").alias("at"), F.lit(-1).alias("_s")))
    ev = ev.groupBy(identifier, "at").agg(F.sum("_s").alias("_s")).where("_s <> 0")
    w = W.partitionBy(identifier).orderBy("at")
    run = F.sum("_s").over(w.rowsBetween(W.unboundedPreceding, 0))
    x = ev.select(identifier, F.col("at").alias("from_dt"), F.lead("at").over(w).alias("thru_dt"), run.alias("n_assets"))
    return x.where("n_assets > 1")


def benchmark_coverage(bench: DataFrame, universe: DataFrame, name: str, key: str, weight: str, estu: str) -> DataFrame:
    """Count and weight of benchmark members outside the model and outside the estimation universe."""
    j = bench.join(universe.select(key, F.col(estu).alias("_e")), key, "left")
    out, non = F.col("_e").isNull(), F.col("_e").isNull() | ~F.col("_e")
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0))
    wt = lambda c: div(F.sum(F.when(c, F.col(weight)).otherwise(0.0)), F.sum(weight))
    return j.groupBy(name).agg(F.count("*").alias("n"), cnt(out).alias("n_outside"), wt(out).alias("share_outside"), cnt(non).alias("n_not_estu"), wt(non).alias("share_not_estu"))


def check_series(series: DataFrame, key: str, step: str, value: str, needed: DataFrame, as_of_step: int, max_age: int, lo: float, hi: float, max_jump: float) -> DataFrame:
    """Needed series that are absent, old, out of range or jump too far."""
    w = W.partitionBy(key).orderBy(step)
    x = series.where(F.col(value).isNotNull()).withColumn("_j", F.abs(F.col(value) - F.lag(value).over(w)))
    g = x.groupBy(key).agg(F.max(step).alias("last"), F.min(value).alias("low"), F.max(value).alias("high"), F.max("_j").alias("jump"))
    j = needed.select(key).join(g, key, "left")
    what = (
        F.when(F.col("last").isNull(), "absent").when(F.lit(as_of_step) - F.col("last") > max_age, "old").when((F.col("low") < lo) | (F.col("high") > hi), "range").when(F.col("jump") > max_jump, "jump")
    )
    return j.withColumn("finding", what).where("finding is not null").select(key, "finding")


def recheck(stored_rows: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Stored values that differ from the source's, null-safe."""
    j = stored_rows.select(*keys, F.struct(*cols).alias("_a")).join(source.select(*keys, F.struct(*cols).alias("_b")), list(keys))
    bad = F.filter(F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in cols]), lambda x: x.isNotNull())
    return j.select(*keys, F.explode(bad).alias("column"))


def severity(findings: DataFrame, rules: Mapping[str, str], col: str = "check") -> DataFrame:
    """Adds a severity by kind of finding, ``info`` where no rule names it."""
    s: Column = F.lit("info")
    for k, v in rules.items():
        s = F.when(F.col(col) == k, F.lit(v)).otherwise(s)
    return findings.withColumn("severity", s)
