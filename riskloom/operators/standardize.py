"""Outlier treatment, standardisation, missing exposures.

Exposures are long rows (asset, date, factor, value) where several factors share a rule, so
that all factors and dates go through one aggregation. Cross-sections are reduced by
map-side aggregates and joined back; no window runs over a whole date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.columns import clip, div
from riskloom.operators.crossprod import cross_products, dot, solve_normal
from riskloom.operators.ranks import mad_bounds, percentiles, spread_bounds
from riskloom.session import stored


def _bounds(df: DataFrame, keys: Sequence[str], value: str, n_dev: float, method: str, zero_tolerance: float, history: bool) -> DataFrame:
    if method == "mad":
        b = mad_bounds(df, keys, value, n_dev, zero_tolerance, history)
    elif method == "iqr":
        b = spread_bounds(df, keys, value, n_dev, 25.0, 75.0, zero_tolerance, history)
    else:
        b = spread_bounds(df, keys, value, n_dev, 10.0, 90.0, zero_tolerance, history)
    return b.select(*keys, "lower", "upper")


def clip_outliers(
    df: DataFrame, by: Sequence[str], value: str, n_dev: float = 8.0, method: str = "mad", zero_tolerance: float = 0.25,
    estu: str | None = None, history: bool = False,
) -> DataFrame:
    """Clip at bounds of the estimation set per key; keys without bounds stay as they are."""
    base = df.where(F.col(estu)) if estu else df
    b = _bounds(base, list(by), value, n_dev, method, zero_tolerance, history)
    j = df.join(b, list(by), "left")
    v = F.when(F.col("lower").isNull(), F.col(value)).otherwise(clip(F.col(value), F.col("lower"), F.col("upper")))
    return j.withColumn(value, v).drop("lower", "upper")


def clip_2d(
    df: DataFrame, key: str, dt: str, value: str, n_dev: float = 8.0, n_dev_time: float | None = None, method: str = "mad",
    zero_tolerance: float = 0.25, estu: str | None = None, shrink: bool = False,
) -> DataFrame:
    """Clip cells that are outliers both on their date and in their own history.

    Bounds are the looser of both. With ``shrink`` cells past the bounds keep their order:
    the excess is compressed logarithmically instead of cut.
    """
    base = df.where(F.col(estu)) if estu else df
    across = _bounds(base, [dt], value, n_dev, method, zero_tolerance, False).withColumnsRenamed({"lower": "_lc", "upper": "_uc"})
    along = _bounds(df, [key], value, n_dev_time or n_dev, method, zero_tolerance, True).withColumnsRenamed({"lower": "_lr", "upper": "_ur"})
    j = df.join(across, [dt], "left").join(along, [key], "left")
    v = F.col(value)
    out = ((v < F.col("_lc")) | (v > F.col("_uc"))) & ((v < F.col("_lr")) | (v > F.col("_ur")))
    lo, hi = F.least("_lc", "_lr"), F.greatest("_uc", "_ur")
    cut = clip(v, lo, hi)
    if shrink:
        over = F.abs(v - cut)
        width = F.greatest(hi - lo, F.lit(1e-12))
        cut = cut + F.signum(v - cut) * width * F.log1p(div(over, width)) / 10.0
    return j.withColumn(value, F.when(F.coalesce(out, F.lit(False)), cut).otherwise(v)).drop("_lc", "_uc", "_lr", "_ur")


def clip_bucketed(df: DataFrame, dt: str, region: str, sector: str, value: str, n_dev: float = 8.0, zero_tolerance: float = 0.25, small: int = 10, least: int = 6) -> DataFrame:
    """Clip inside region x sector buckets of a date.

    Buckets under ``small`` members are pooled per region; pools under ``least`` stay.
    """
    n = df.groupBy(dt, region, sector).agg(F.count("*").alias("_n"))
    pool = n.where(F.col("_n") < small).groupBy(dt, region).agg(F.sum("_n").alias("_pn"))
    n = n.join(pool, [dt, region], "left")
    bucket = F.when(F.col("_n") >= small, F.concat_ws("|", F.col(region), F.col(sector))).when(
        F.col("_pn") >= least, F.concat_ws("|", F.col(region), F.lit("*"))
    )
    x = df.join(n.select(dt, region, sector, bucket.alias("_bucket")), [dt, region, sector])
    b = _bounds(x.where("_bucket is not null"), [dt, "_bucket"], value, n_dev, "mad", zero_tolerance, False)
    j = x.join(b, [dt, "_bucket"], "left")
    v = F.when(F.col("lower").isNull(), F.col(value)).otherwise(clip(F.col(value), F.col("lower"), F.col("upper")))
    return j.withColumn(value, v).drop("lower", "upper", "_bucket")


def standard_stats(long: DataFrame, by: Sequence[str], value: str, estu: str, cap: str, eligible: str | None = None, zero_fill: Sequence[str] = (), factor: str = "factor") -> DataFrame:
    """Cap-weighted mean and equal-weighted deviation over the estimation set per key.

    The deviation counts a missing value as 0 after the mean is taken out and divides by
    n_estu - 1; under 3 members it is null. A bucket without members uses ``eligible``.
    """
    by = list(by)
    x = long
    if zero_fill:
        x = x.withColumn(value, F.when(F.col(factor).isin(*zero_fill), F.coalesce(F.col(value), F.lit(0.0))).otherwise(F.col(value)))

    def sums(flag: Column, tag: str) -> list[Column]:
        ok = flag & F.col(value).isNotNull()
        v, w = F.when(ok, F.col(value)), F.when(ok, F.col(cap))
        return [
            F.sum(F.when(flag, 1).otherwise(0)).alias(f"n{tag}"), F.count(v).alias(f"k{tag}"),
            F.sum(v * w).alias(f"wv{tag}"), F.sum(w).alias(f"w{tag}"), F.min(v).alias(f"lo{tag}"), F.max(v).alias(f"hi{tag}"),
        ]

    aggs = sums(F.col(estu), "e") + (sums(F.col(eligible), "l") if eligible else [])
    g = x.groupBy(*by).agg(*aggs)
    use = F.col("ne") > 0
    pick = lambda n: F.when(use, F.col(f"{n}e")).otherwise(F.col(f"{n}l")) if eligible else F.col(f"{n}e")
    g = g.select(*by, use.alias("_use"), pick("n").alias("n_used"), (div(pick("wv"), pick("w"))).alias("mean"))
    # deviations about the mean in a second pass: no cancellation for values far from zero
    flag = F.when(F.col("_use"), F.col(estu)).otherwise(F.col(eligible) if eligible else F.lit(False))
    d = F.when(flag, F.coalesce(F.col(value) - F.col("mean"), F.lit(0.0)))
    s = x.join(g, by).groupBy(*by, "n_used", "mean").agg(F.sum(d * d).alias("_ss"))
    std = F.when((F.col("n_used") >= 3) & (F.col("_ss") > 0), F.sqrt(div(F.col("_ss"), F.col("n_used") - 1)))
    return s.select(*by, "n_used", "mean", std.alias("std"))


def binary_factors(long: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Keys with at most two distinct values (nulls as 0): they are not standardised."""
    v = F.coalesce(F.col(value), F.lit(0.0))
    b = long.groupBy(*by).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    mid = F.sum(F.when((v != F.col("_lo")) & (v != F.col("_hi")), 1).otherwise(0))
    return long.join(b, list(by)).groupBy(*by).agg(mid.alias("_mid")).where("_mid = 0").select(*by)


def standardize(
    long: DataFrame, by: Sequence[str], value: str, estu: str, cap: str, bound: float = 5.5, mad: float | None = None,
    eligible: str | None = None, zero_fill: Sequence[str] = (), factor: str = "factor", skip_binary: bool = True,
) -> DataFrame:
    """(x - mean) / std inside each key, clipped; adds ``mean`` and ``std``.

    ``by`` is the scope: date and factor for global, plus region, country or industry.
    Keys without a deviation, and binary factors, keep their values.
    """
    by = list(by)
    x = long
    if mad is not None:
        # the clipped values feed four aggregations
        x = stored(clip_outliers(x, by, value, mad, estu=estu, zero_tolerance=1.0))
    st = standard_stats(x, by, value, estu, cap, eligible, zero_fill, factor)
    if skip_binary:
        st = st.join(binary_factors(x, by, value), by, "left_anti")
    j = x.join(st.drop("n_used"), by, "left")
    z = clip(div(F.col(value) - F.col("mean"), F.col("std")), -bound, bound)
    return j.withColumn(value, F.when(F.col("std").isNull(), F.col(value)).otherwise(z))


def style_composite(long: DataFrame, recipe: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Weighted mean of the non-missing standardised descriptors of each style.

    ``recipe``: factor, style, weight.
    """
    j = long.join(recipe, "factor")
    w = F.when(F.col(value).isNotNull(), F.col("weight"))
    return j.groupBy(*keys, "style").agg((div(F.sum(F.col(value) * F.col("weight")), F.sum(w))).alias("value"))


def proxy_exposure(
    df: DataFrame, dt: str, region: str, sector: str, value: str, size: str, cap: str, estu: str, limit: float = 2.0,
    least_good: float = 0.1, least_unique: float = 0.05,
) -> DataFrame:
    """Missing exposures from a root-cap fit on size and sector dummies per region and date.

    Each asset sits in one sector, so the normal equations collapse: a common size slope
    from within-sector sums, and one intercept per sector. A region with under 10% good to
    missing values (or too few distinct ones) is left alone. Sectors without members get none.
    """
    good = F.col(estu) & F.col(value).isNotNull()
    w, x, y = F.sqrt(F.col(cap)), F.coalesce(F.col(size), F.lit(0.0)), F.col(value)
    g = df.groupBy(dt, region, sector).agg(
        F.sum(F.when(F.col(value).isNull(), 1).otherwise(0)).alias("_miss"), F.sum(F.when(good, 1).otherwise(0)).alias("_good"), F.count("*").alias("_all"),
        F.sum(F.when(good, w)).alias("sw"), F.sum(F.when(good, w * x)).alias("sx"), F.sum(F.when(good, w * y)).alias("sy"),
        F.sum(F.when(good, w * x * x)).alias("sxx"), F.sum(F.when(good, w * x * y)).alias("sxy"),
    )
    unique = df.where(good & (y != 0)).select(dt, region, value).distinct().groupBy(dt, region).agg(F.count("*").alias("_uu"))
    within = lambda a, b, c: F.sum(F.coalesce(F.col(a) - div(F.col(b) * F.col(c), F.col("sw")), F.lit(0.0)))
    r = g.groupBy(dt, region).agg(
        within("sxy", "sx", "sy").alias("_n"), within("sxx", "sx", "sx").alias("_d"),
        F.sum("_good").alias("_g"), F.sum("_miss").alias("_m"), F.sum("_all").alias("_a"),
    ).join(unique, [dt, region], "left")
    ok = (F.col("_g") >= F.col("_m") * least_good) & (F.col("_uu") >= F.col("_a") * least_unique)
    r = r.select(dt, region, F.when(ok & (F.col("_d") > 0), div(F.col("_n"), F.col("_d"))).alias("slope"))
    c = g.join(r, [dt, region]).select(dt, region, sector, "slope", (div(F.col("sy") - F.col("slope") * F.col("sx"), F.col("sw"))).alias("level"))
    j = df.join(c, [dt, region, sector], "left")
    p = clip(F.col("level") + F.col("slope") * x, -limit, limit)
    return j.withColumn("is_proxy", F.col(value).isNull() & p.isNotNull()).withColumn(value, F.coalesce(F.col(value), p)).drop("slope", "level")


def proxy_data(df: DataFrame, by: Sequence[str], value: str, xs: Sequence[str], cap: str, estu: str, clip_caps: tuple[float, float] = (5.0, 95.0)) -> DataFrame:
    """Missing data from a root-cap fit on the given columns (dummies, ln cap) per key.

    Caps are clipped at Hazen percentiles before they weigh. Adds ``is_proxy``.
    """
    by = list(by)
    q = percentiles(df, by, cap, {"_lo": clip_caps[0], "_hi": clip_caps[1]}).drop("n")
    x = df.join(q, by).withColumn("_w", F.sqrt(F.greatest("_lo", F.least("_hi", cap)))).drop("_lo", "_hi")
    fit = cross_products(x.where(F.col(estu)), by, xs, value, "_w", intercept=True)
    fit = fit.select(*by, solve_normal("xtx", "xty").alias("_b"))
    j = x.join(fit, by, "left")
    p = dot("_b", xs, intercept=True)
    return j.withColumn("is_proxy", F.col(value).isNull() & p.isNotNull()).withColumn(value, F.coalesce(F.col(value), p)).drop("_b", "_w")


def shrink_to_mean(df: DataFrame, dt: str, region: str, sector: str, value: str, cap: str, estu: str, scale: Column) -> DataFrame:
    """x s + (1 - s) mean; missing values have s = 0.

    The mean is cap-weighted over full-history members of the sector x region bucket, else
    over all of the date. ``scale`` is the share of history, 1 when complete.
    """
    x = df.withColumn("_s", F.when(F.col(value).isNull(), 0.0).otherwise(F.least(F.lit(1.0), F.coalesce(scale, F.lit(1.0)))))
    ok = F.col(estu) & (F.col("_s") >= 1)
    v, w = F.when(ok, F.col(value) * F.col(cap)), F.when(ok, F.col(cap))
    b = x.groupBy(dt, region, sector).agg(F.sum(v).alias("_v"), F.sum(w).alias("_w"))
    t = b.groupBy(dt).agg((div(F.sum("_v"), F.sum("_w"))).alias("_all"))
    b = b.join(t, dt).select(dt, region, sector, F.coalesce(div(F.col("_v"), F.col("_w")), F.col("_all"), F.lit(0.0)).alias("_mean"))
    j = x.join(b, [dt, region, sector])
    return j.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)) * F.col("_s") + (1 - F.col("_s")) * F.col("_mean")).drop("_s", "_mean")


def fill_standardized_zero(z: DataFrame, value: str) -> DataFrame:
    """A missing standardised exposure takes the raw value 0: (0 - mean) / std of its key."""
    return z.withColumn(value, F.coalesce(F.col(value), div(-F.col("mean"), F.col("std"))))


def clone_linked(long: DataFrame, links: DataFrame, keys: Sequence[str], key: str = "asset_id", value: str = "value") -> DataFrame:
    """Linked lines share exposures.

    ``links``: key, group_id, master (for hard clones, else null), score, is_shell. Hard
    clones copy their master; the other lines get the score-weighted mean of the group's
    non-missing lines; shells keep their own.
    """
    keys = list(keys)
    x = long.join(links, key, "left")
    # most lines belong to no group and have no master: they meet no join on a null key
    alone = x.where(F.col("group_id").isNull()).withColumn("_v", F.col(value))
    x = x.where(F.col("group_id").isNotNull())
    shell = F.coalesce(F.col("is_shell"), F.lit(False))
    live = ~shell & F.col("master").isNull() & F.col(value).isNotNull()
    m = x.where(live).groupBy("group_id", *keys).agg((div(F.sum(F.col("score") * F.col(value)), F.sum("score"))).alias("_mean"))
    x = x.join(m, ["group_id", *keys], "left").withColumn("_v", F.when(shell, F.col(value)).otherwise(F.coalesce("_mean", value)))
    x = alone.unionByName(x.select(*alone.columns))
    src = x.select(F.col(key).alias("master"), *keys, F.col("_v").alias("_mv"))
    own = x.where(F.col("master").isNull()).select(key, *keys, F.col("_v").alias(value))
    clones = x.where(F.col("master").isNotNull()).join(src, ["master", *keys], "left")
    return own.unionByName(clones.select(key, *keys, F.coalesce("_mv", "_v").alias(value)))


def score_linked(lines: DataFrame, group: str, parts: Sequence[str], scale: float | None = None) -> DataFrame:
    """Product of scores, each over the group's maximum (1 where the maximum is not positive).

    With ``scale`` the product p becomes exp(scale (p - 1)).
    """
    top = lines.groupBy(group).agg(*[F.max(F.coalesce(F.col(p), F.lit(0.0))).alias(f"_m_{p}") for p in parts])
    j = lines.join(top, group)
    s = F.lit(1.0)
    for p in parts:
        s = s * F.when(F.col(f"_m_{p}") > 0, div(F.coalesce(F.col(p), F.lit(0.0)), F.col(f"_m_{p}"))).otherwise(1.0)
    s = F.exp(F.lit(scale) * (s - 1)) if scale else s
    return j.withColumn("score", s).drop(*[f"_m_{p}" for p in parts])


def orthogonalize(df: DataFrame, by: Sequence[str], y: str, xs: Sequence[str], weight: str, estu: str, intercept: bool = False) -> DataFrame:
    """Residual of a style on others (weighted, over the estimation set), scaled by its deviation there."""
    by = list(by)
    fit = cross_products(df.where(F.col(estu)), by, xs, y, weight, intercept).select(*by, solve_normal("xtx", "xty").alias("_b"))
    r = df.join(fit, by).withColumn("_e", F.col(y) - dot("_b", xs, intercept))
    s = r.where(F.col(estu)).groupBy(*by).agg(F.stddev_samp("_e").alias("_s"))
    return r.join(s, by).withColumn(y, div(F.col("_e"), F.col("_s"))).drop("_b", "_e", "_s")


def size_cubed(df: DataFrame, by: Sequence[str], cap: str, estu: str, name: str = "size_nl") -> DataFrame:
    """Cube of standardised ln cap: cap-weighted mean, N - 1 deviation over the estimation set."""
    by = list(by)
    x = df.withColumn("_l", F.log(cap))
    e = x.where(F.col(estu))
    m = e.groupBy(*by).agg((div(F.sum(F.col(cap) * F.col("_l")), F.sum(cap))).alias("_m"))
    s = e.join(m, by).groupBy(*by, "_m").agg(F.sqrt(div(F.sum((F.col("_l") - F.col("_m")) * (F.col("_l") - F.col("_m"))), F.count("*") - 1)).alias("_s"))
    z = div(F.col("_l") - F.col("_m"), F.col("_s"))
    return x.join(s, by).withColumn(name, z * z * z).drop("_l", "_m", "_s")


def china_local(univ: DataFrame, class_col: str, classes: Sequence[str] = ("A", "B"), name: str = "local") -> DataFrame:
    """1 for local share classes, else missing."""
    return univ.withColumn(name, F.when(F.col(class_col).isin(*classes), 1.0))


def cap_buckets(df: DataFrame, by: Sequence[str], cap: str, estu: str, bands: dict[str, tuple[float, float]]) -> DataFrame:
    """1 in the cap band between two Hazen percentiles of the estimation set, one column per band."""
    by = list(by)
    pts = sorted({p for b in bands.values() for p in b if 0 < p < 100})
    q = percentiles(df.where(F.col(estu)), by, cap, {f"_q{i}": p for i, p in enumerate(pts)}).drop("n")
    j = df.join(q, by, "left")
    for name, (lo, hi) in bands.items():
        ok = F.lit(True)
        if lo > 0:
            ok = ok & (F.col(cap) > F.col(f"_q{pts.index(lo)}"))
        if hi < 100:
            ok = ok & (F.col(cap) <= F.col(f"_q{pts.index(hi)}"))
        j = j.withColumn(name, F.when(ok, 1.0))
    return j.drop(*[f"_q{i}" for i in range(len(pts))])
