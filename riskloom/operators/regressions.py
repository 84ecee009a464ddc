"""Regressions across assets and along time.

Sums of products are Spark aggregates; only a k x k system per key reaches numpy. Where a
fit needs a whole series (robust fits, autoregressive errors), the group is one key's dated
history. Robust cross-sections iterate aggregates and checkpoint their small coefficients.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from riskloom.functions import linalg
from riskloom.operators.crossprod import VECTOR, cross_products, dot, inverse_sym, nonneg_solve, solve_normal
from riskloom.operators.ranks import median
from riskloom.session import cut, stored
from riskloom.functions.columns import div


def _named(fit: DataFrame, by: Sequence[str], names: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    return fit.select(*by, *[F.col("coef")[i].alias(n) for i, n in enumerate(names)], *extra)


def _pair(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join on the keys; without keys both sides are one row."""
    if by:
        return a.join(b, list(by))
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one")


def wls(df: DataFrame, by: Sequence[str], xs: Sequence[str], y: str, w: str | None = None, intercept: bool = False, solver: str = "wls") -> DataFrame:
    """Coefficients per key as an array ``coef`` with ``n``, ``sw``, ``sy``, ``yty``, ``xtx``, ``xty``.

    ``solver`` is ``wls`` or ``nnls`` (no negative coefficients).
    """
    g = cross_products(df, by, xs, y, w, intercept)
    solve = nonneg_solve if solver == "nnls" else solve_normal
    return g.withColumn("coef", solve("xtx", "xty"))


def residuals(df: DataFrame, fit: DataFrame, by: Sequence[str], xs: Sequence[str], y: str, intercept: bool = False, name: str = "resid") -> DataFrame:
    """y less the fitted value for every row, also those outside the fit."""
    c = fit.select(*by, "coef")
    if by:
        j = df.join(c, list(by), "left")
    else:
        j = df.withColumn("_one", F.lit(1)).join(c.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return j.withColumn(name, F.col(y) - dot("coef", xs, intercept)).drop("coef")


def coefficients(fit: DataFrame, by: Sequence[str], xs: Sequence[str], intercept: bool = False) -> DataFrame:
    """Coefficients under the names of their columns."""
    return _named(fit, by, (["intercept"] if intercept else []) + list(xs))


def constrained_wls(df: DataFrame, by: Sequence[str], xs: Sequence[str], y: str, r: Sequence[Sequence[float]], q: Sequence[float], w: str | None = None, intercept: bool = False) -> DataFrame:
    """Least squares subject to R b = q, by the null space of R on the k x k sums."""
    g = cross_products(df, by, xs, y, w, intercept)
    rm, qv = np.asarray(r, float), np.asarray(q, float)

    @pandas_udf(VECTOR)
    def solve(xtx: pd.Series, xty: pd.Series) -> pd.Series:
        return pd.Series([linalg.constrained_normal(np.asarray(a, float), np.asarray(b, float), rm, qv) for a, b in zip(xtx, xty)])

    return g.withColumn("coef", solve("xtx", "xty"))


def huber_cross_section(
    df: DataFrame, by: Sequence[str], xs: Sequence[str], y: str, w: str | None = None, k: float = 1.345, tol: float = 1e-6, intercept: bool = False, most: int = 100, in_task: int = 200_000
) -> DataFrame:
    """Robust coefficients per key: by, n, coef, converged, n_passes.

    The scale is the MAD of weighted residuals about their median, taken in the first passes and then
    kept (``linalg.huber_solve``), so the fit settles. Keys of up to ``in_task`` rows are fitted in tasks,
    all of them in one job. Larger keys move sums: a pass is one aggregation over the rows of those
    keys that still move, and only their coefficients are checkpointed. Once the scale stands these are
    Newton steps on the convex loss, which settle in a few passes; a key that ``NEWTON`` of them do not
    settle goes on by reweighting, which cannot swing. A key that still moves after
    ``most`` passes keeps its last fit and says so in ``converged``. Keys with fewer rows than columns get
    zeros and count as converged.
    """
    keys = list(by) or ["_one"]
    x = df if by else df.withColumn("_one", F.lit(1))
    x = stored(x.select(*keys, *xs, F.col(y).alias("_y"), (F.col(w) if w else F.lit(1.0)).alias("_w")).dropna(subset=[*xs, "_y", "_w"]))
    sizes = stored(x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    m = len(xs) + int(intercept)

    def fit_one(pdf: pd.DataFrame) -> pd.DataFrame:
        a = pdf[list(xs)].to_numpy(float)
        a = np.column_stack([np.ones(len(pdf)), a]) if intercept else a
        b, done, i = (np.zeros(m), True, 0) if len(pdf) < m else linalg.huber_solve(a, pdf["_y"].to_numpy(float), pdf["_w"].to_numpy(float), k)
        return pd.DataFrame({**{c: pdf[c].iloc[:1].array for c in keys}, "n": [len(pdf)], "coef": [b], "converged": [done], "n_passes": [i]})

    schema = T.StructType([df.schema[c] if by else T.StructField(c, T.IntegerType()) for c in keys] + T._parse_datatype_string("n bigint, coef array<double>, converged boolean, n_passes int").fields)
    out = x.join(sizes.where(F.col("n") <= in_task).select(*keys), keys, "left_semi").groupBy(*keys).applyInPandas(fit_one, schema)
    large = sizes.where(F.col("n") > in_task).select(*keys)
    if not large.isEmpty():
        out = out.unionByName(_huber_by_sums(stored(x.join(large, keys, "left_semi")), keys, xs, k, tol, intercept, most))
    return out if by else out.drop("_one")


#: Passes of Newton steps before a key of a robust fit goes on by reweighting.
NEWTON = 20


def _huber_by_sums(x: DataFrame, keys: list[str], xs: Sequence[str], k: float, tol: float, intercept: bool, most: int) -> DataFrame:
    fit = cut(wls(x, keys, xs, "_y", "_w", intercept).select(*keys, "n", "coef", F.lit(None).cast("double").alias("scale"), F.lit(False).alias("converged"), F.lit(0).alias("n_passes")))
    done, m = fit.where("converged"), len(xs) + int(intercept)
    for i in range(1, most + 1):
        rows = x if i <= linalg.SCALE_PASSES else x.join(fit.select(*keys), keys, "left_semi")  # rows of settled keys are read no more
        e = residuals(rows, fit.select(*keys, "coef"), keys, xs, "_y", intercept, "_e").withColumn("_e", F.sqrt("_w") * F.col("_e"))
        if i <= linalg.SCALE_PASSES:
            mid = median(e, keys, "_e", "_m").drop("n")
            away = e.join(mid, keys).withColumn("_d", F.abs(F.col("_e") - F.col("_m")))
            scale = median(away, keys, "_d", "_s").select(*keys, (F.col("_s") / 0.67449).alias("_s"))
        else:
            scale = fit.select(*keys, F.col("scale").alias("_s"))
        z = e.join(scale, keys)
        down = F.when(F.col("_s") > 0, F.least(F.lit(1.0), F.lit(k) * F.col("_s") / F.greatest(F.abs("_e"), F.lit(1e-300)))).otherwise(1.0)
        new = cross_products(z.withColumn("_w", F.col("_w") * down), keys, xs, "_y", "_w", intercept).select(*keys, "xtx", "xty")
        if linalg.SCALE_PASSES < i <= linalg.SCALE_PASSES + NEWTON:
            # b + H^-1 (X'Wy - X'WX b), with H of the rows inside the bends
            bent = z.withColumn("_w", F.when((F.col("_s") > 0) & (F.abs("_e") > F.lit(k) * F.col("_s")), 0.0).otherwise(F.col("_w")))
            inner = cross_products(bent, keys, xs, None, "_w", intercept).select(*keys, F.col("xtx").alias("_h"))
            new = new.join(inner, keys).join(fit.select(*keys, "coef"), keys)
            less = lambda r: sum((F.col("_h")[r * m + c] - F.col("xtx")[r * m + c]) * F.col("coef")[c] for c in range(m))
            new = new.select(*keys, F.col("_h").alias("xtx"), F.array(*[F.col("xty")[r] + less(r) for r in range(m)]).alias("xty"))
        new = new.select(*keys, solve_normal("xtx", "xty").alias("_new"))
        both = fit.drop("scale", "converged").join(new, keys).join(scale, keys)
        moved = F.array_max(F.zip_with("coef", "_new", lambda a, b: F.abs(a - b))) > tol * F.greatest(F.lit(1e-12), F.array_max(F.transform("_new", F.abs)))
        settled = (F.col("_s") <= 0) | (F.lit(i > linalg.SCALE_PASSES) & ~moved)
        step = cut(both.select(*keys, "n", F.col("_new").alias("coef"), F.col("_s").alias("scale"), settled.alias("converged"), F.lit(i).alias("n_passes")))
        done, fit = done.unionByName(step.where("converged")), step.where("NOT converged")
        if fit.isEmpty():
            break
    return done.unionByName(fit).drop("scale")


def huber_history(df: DataFrame, key: str, xs: Sequence[str], y: str, k: float = 5.0, intercept: bool = True, least: int = 4) -> DataFrame:
    """Robust time-series fit per key, and whether it settled; a group is one key's dated history. Keys with
    fewer than ``least`` full rows get zeros."""
    names = (["intercept"] if intercept else []) + list(xs)
    kt = df.schema[key].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.dropna(subset=[*xs, y])
        b, done = np.zeros(len(names)), True
        if len(p) >= max(least, len(names)):
            x = p[list(xs)].to_numpy(float)
            x = np.column_stack([np.ones(len(p)), x]) if intercept else x
            b, done, _ = linalg.huber_solve(x, p[y].to_numpy(float), k=k)
        return pd.DataFrame([[pdf[key].iloc[0], *b, done]], columns=[key, *names, "converged"])

    schema = f"{key} {kt}, " + ", ".join(f"`{n}` double" for n in names) + ", converged boolean"
    return df.select(key, *xs, y).groupBy(key).applyInPandas(fit, schema)


# --- statistics ---------------------------------------------------------------------------


@pandas_udf(T.DoubleType())
def _t_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([linalg.t_two_sided(a, b) for a, b in zip(t, dof)])


def t_probability(t: Column, dof: Column) -> Column:
    """Two-sided p-value of Student's t, in Arrow batches over rows of fitted coefficients."""
    return _t_p(t, dof.cast("double"))


def reg_stats(df: DataFrame, by: Sequence[str], xs: Sequence[str], y: str, w: str | None = None, intercept: bool = True, errors: str = "plain", constraints: int = 0, with_p: bool = True) -> DataFrame:
    """One row per key and coefficient: value, standard error, t, p, with R2 and adjusted R2.

    ``errors``: plain (homoskedastic) or white. Adjusted R2 is not under 0; ``constraints``
    gives back degrees of freedom.
    """
    by = list(by)
    names = (["intercept"] if intercept else []) + list(xs)
    k = len(names)
    fit = wls(df, by, xs, y, w, intercept).withColumn("inv", inverse_sym("xtx"))
    explained = F.aggregate(F.zip_with("coef", "xty", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    # a residual sum that is rounding noise is a perfect fit
    left = F.col("yty") - explained
    sse = F.when(left > F.lit(1e-12) * F.col("yty"), left).otherwise(F.lit(0.0))
    sst = F.col("yty") - (div(F.col("sy") * F.col("sy"), F.col("sw")) if intercept else F.lit(0.0))
    dof = F.col("n") - k + constraints
    fit = fit.withColumns({"_sse": sse, "_dof": dof, "r2": 1 - div(sse, sst)})
    fit = fit.withColumn("adj_r2", F.greatest(F.lit(0.0), 1 - div((1 - F.col("r2")) * (F.col("n") - 1), F.col("_dof"))))
    if errors == "white":
        e = residuals(df, fit, by, xs, y, intercept, "_e")
        wt = F.col(w) if w else F.lit(1.0)
        meat = cross_products(e.withColumn("_w2", wt * wt * F.col("_e") * F.col("_e")), by, xs, None, "_w2", intercept).select(*by, F.col("xtx").alias("_meat"))

        @pandas_udf(VECTOR)
        def sandwich(inv: pd.Series, meat: pd.Series) -> pd.Series:
            out = []
            for a, m in zip(inv, meat):
                a, m = np.asarray(a, float).reshape(k, k), np.asarray(m, float).reshape(k, k)
                out.append(np.diag(a @ m @ a))
            return pd.Series(out)

        fit = _pair(fit, meat, by)
        fit = fit.withColumn("_var", sandwich("inv", "_meat"))
    else:
        diag = F.array(*[F.col("inv")[i * k + i] for i in range(k)])
        fit = fit.withColumn("_var", F.transform(diag, lambda d: d))
        fit = fit.withColumn("_s2", div(F.col("_sse"), F.col("_dof"))).withColumn("_var", F.transform("_var", lambda d: d * F.col("_s2")))
    rows = F.explode(F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("name"), F.col("coef").alias("coef"), F.col("_var").alias("var"))).alias("_c")
    out = fit.select(*by, "n", "_dof", "r2", "adj_r2", rows)
    out = out.select(*by, F.col("_c")["name"].alias("term"), F.col("_c")["coef"].alias("coef"), F.sqrt(F.col("_c")["var"]).alias("se"), "n", "_dof", "r2", "adj_r2")
    out = out.withColumn("t", div(F.col("coef"), F.col("se")))
    if with_p:
        out = out.withColumn("p", t_probability(F.col("t"), F.col("_dof")))
    return out.drop("_dof")


def newey_west_errors(df: DataFrame, key: str, xs: Sequence[str], y: str, lags: int, step: str, intercept: bool = True) -> DataFrame:
    """Standard errors of time-series fits per key robust to autocorrelation."""
    names = (["intercept"] if intercept else []) + list(xs)
    k = len(names)
    fit = wls(df, [key], xs, y, None, intercept).withColumn("inv", inverse_sym("xtx"))
    e = residuals(df, fit, [key], xs, y, intercept, "_e").where("_e is not null")
    w = W.partitionBy(key).orderBy(step)
    col = lambda i: F.lit(1.0) if intercept and i == 0 else F.col(xs[i - int(intercept)])
    e = e.withColumns({f"_s{i}": col(i) * F.col("_e") for i in range(k)})
    lagged = {f"_l{l}_{i}": F.lag(f"_s{i}", l).over(w) for l in range(1, lags + 1) for i in range(k)}
    e = e.withColumns(lagged) if lagged else e
    aggs = []
    for i in range(k):
        for j in range(k):
            v = F.col(f"_s{i}") * F.col(f"_s{j}")
            for l in range(1, lags + 1):
                wt = 1.0 - l / (lags + 1.0)
                v = v + wt * (F.coalesce(F.col(f"_s{i}") * F.col(f"_l{l}_{j}"), F.lit(0.0)) + F.coalesce(F.col(f"_s{j}") * F.col(f"_l{l}_{i}"), F.lit(0.0)))
            aggs.append(F.sum(v).alias(f"_m{i}_{j}"))
    meat = e.groupBy(key).agg(*aggs).select(key, F.array(*[F.col(f"_m{i}_{j}") for i in range(k) for j in range(k)]).alias("_meat"))

    @pandas_udf(VECTOR)
    def errors(inv: pd.Series, m: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(inv, m):
            a, b = np.asarray(a, float).reshape(k, k), np.asarray(b, float).reshape(k, k)
            out.append(np.sqrt(np.maximum(np.diag(a @ b @ a), 0.0)))
        return pd.Series(out)

    j = fit.join(meat, key).withColumn("_se", errors("inv", "_meat"))
    return j.select(key, *[F.col("coef")[i].alias(n) for i, n in enumerate(names)], *[F.col("_se")[i].alias(f"se_{n}") for i, n in enumerate(names)])


def vif(df: DataFrame, by: Sequence[str], xs: Sequence[str], w: str | None = None) -> DataFrame:
    """1 / (1 - R2) of each column on the others and a constant, from one k x k cross product."""
    k = len(xs) + 1
    g = cross_products(df, by, xs, None, w, intercept=True).withColumn("inv", inverse_sym("xtx"))
    out = []
    for j in range(1, k):
        centred = F.col("xtx")[j * k + j] - div(F.col("xtx")[j] * F.col("xtx")[j], F.col("xtx")[0])
        out.append((F.col("inv")[j * k + j] * centred).alias(xs[j - 1]))
    return g.select(*by, *out).unpivot(list(by), list(xs), "factor", "vif")


# --- time-series betas --------------------------------------------------------------------


def ts_beta(df: DataFrame, key: str, ret: str, factors: Sequence[str], step: str, end: int, n: int, weights=None, intercept: bool = True, market: str | None = None, net_of: Sequence[str] = (), min_obs: int = 2) -> DataFrame:
    """Betas of each key over the last ``n`` steps.

    ``df`` holds the factor columns beside the returns. Missing returns take the market's.
    ``weights(pos, age)`` gives a column (exponential, triangle or pyramid). With ``net_of``
    the first set is fitted alone and ``factors`` explain its residual.
    """
    x = df.where((F.col(step) > end - n) & (F.col(step) <= end))
    if market:
        x = x.withColumn(ret, F.coalesce(F.col(ret), F.col(market)))
    age = F.lit(end) - F.col(step)
    x = x.withColumn("_w", weights(F.lit(n) - age, age) if weights else F.lit(1.0))
    y = ret
    first = None
    if net_of:
        first = wls(x, [key], net_of, ret, "_w", intercept)
        x = residuals(x, first, [key], net_of, ret, intercept, "_net")
        y = "_net"
    fit = wls(x, [key], factors, y, "_w", intercept).where(F.col("n") >= min_obs)
    out = coefficients(fit.select(key, "coef", "n"), [key], factors, intercept).join(fit.select(key, "n"), key)
    if first is not None:
        out = out.join(coefficients(first, [key], net_of, intercept).drop("intercept"), key)
    return out


def historic_beta(ret: DataFrame, market: DataFrame, key: str, mkt: str, step: str, end: int, n: int = 104, min_obs: int = 3, with_p: bool = True) -> DataFrame:
    """Beta, intercept, t and p-value on the market over n periods; missing returns take the market's."""
    x = ret.where((F.col(step) > end - n) & (F.col(step) <= end)).join(market.select(mkt, step, F.col("mret").alias("beta")), [mkt, step])
    x = x.withColumn("ret", F.coalesce("ret", "beta"))
    s = reg_stats(x, [key], ["beta"], "ret", intercept=True, with_p=with_p).where(F.col("n") >= min_obs)
    pick = lambda c, t: F.max(F.when(F.col("term") == t, F.col(c)))
    aggs = [pick("coef", "beta").alias("beta"), pick("coef", "intercept").alias("alpha"), pick("t", "beta").alias("t_beta"), F.max("r2").alias("r2"), F.max("n").alias("n")]
    if with_p:
        aggs.append(pick("p", "beta").alias("p_beta"))
    return s.groupBy(key).agg(*aggs)


def alpha_and_residual_vol(df: DataFrame, key: str, ret: str, market: str, dof: int = 2) -> DataFrame:
    """Intercept, slope and residual deviation of a market model, all from sums."""
    sse = F.regr_syy(F.col(ret), F.col(market)) - F.regr_sxy(F.col(ret), F.col(market)) * F.regr_slope(F.col(ret), F.col(market))
    n = F.regr_count(F.col(ret), F.col(market))
    sse = F.when(sse > F.lit(1e-12) * F.regr_syy(F.col(ret), F.col(market)), sse).otherwise(F.lit(0.0))
    return df.groupBy(key).agg(
        F.regr_intercept(F.col(ret), F.col(market)).alias("alpha"), F.regr_slope(F.col(ret), F.col(market)).alias("beta"),
        F.sqrt(div(F.greatest(sse, F.lit(0.0)), F.when(n > dof, n - dof))).alias("resid_vol"),
    )


def sensitivity(df: DataFrame, key: str, ret: str, factor: DataFrame, step: str, lag: int = 0, name: str = "sensitivity") -> DataFrame:
    """Slope on one factor series read ``lag`` steps earlier (world market, currency, rate)."""
    f = factor.select((F.col(step) + lag).alias(step), F.col("factor").alias("_f"))
    return df.join(f, step).groupBy(key).agg(F.regr_slope(F.col(ret), F.col("_f")).alias(name))


def macro_exposure(df: DataFrame, key: str, ret: str, factors: Sequence[str], step: str, method: str = "default", n: int = 20, prior: DataFrame | None = None, ridge: float = 0.0) -> DataFrame:
    """Exposures of each key to macro factors.

    ``default``: plain fit. ``overlapping``: on rolling n-step sums. ``block``: on
    non-overlapping n-step sums. ``robust``: Huber per history. ``ridge``: shrunk to a
    prior (key and one column per factor). Factors that are all zero get 0.
    """
    x = df
    if method == "robust":
        return huber_history(df, key, factors, ret, k=1.345)
    if method == "overlapping":
        w = W.partitionBy(key).orderBy(step).rangeBetween(1 - n, 0)
        full = F.count("*").over(w) == n
        x = df.withColumns({f"_{c}": F.when(full, F.sum(c).over(w)) for c in [ret, *factors]})
        x = x.select(key, step, *[F.col(f"_{c}").alias(c) for c in [ret, *factors]])
    elif method == "block":
        x = df.groupBy(key, F.floor(div(F.col(step), n)).alias(step)).agg(*[F.sum(c).alias(c) for c in [ret, *factors]])
    g = cross_products(x, [key], factors, ret, None, intercept=method != "ridge")
    if method != "ridge":
        return coefficients(g.withColumn("coef", solve_normal("xtx", "xty")), [key], factors, True).drop("intercept")
    k = len(factors)
    p = prior.select(key, F.array(*[F.col(f).alias(f) for f in factors]).alias("_p")) if prior is not None else g.select(key, F.array(*[F.lit(0.0)] * k).alias("_p"))

    @pandas_udf(VECTOR)
    def shrink(xtx: pd.Series, xty: pd.Series, p: pd.Series) -> pd.Series:
        out = []
        for a, b, q in zip(xtx, xty, p):
            a, b, q = np.asarray(a, float).reshape(k, k), np.asarray(b, float), np.asarray(q, float)
            lam = ridge * np.diag(np.diag(a))
            out.append(linalg.solve_sym((a + lam).ravel(), b + lam @ q))
        return pd.Series(out)

    fit = g.join(p, key).withColumn("coef", shrink("xtx", "xty", "_p"))
    return coefficients(fit, [key], factors)


def nested_exposure(
    df: DataFrame, key: str, ret: str, blocks: Sequence[Sequence[str]], orthogonal: bool = True, sector: str | None = None, sector_factors: dict | None = None, sector_last: bool = False
) -> DataFrame:
    """Exposures fitted block after block, each block to what the blocks before have left: one column per factor.

    With ``orthogonal`` a block's factors are first cleared of those before (a Schur complement of the sums),
    otherwise they are taken as they are. With ``sector`` (a column of ``df``, one value a key) a key meets only
    its own sector's factor of ``sector_factors`` (sector: factor) beside the general ones, in the block that
    names it, or with ``sector_last`` in a block of its own behind all others; a key of no listed sector meets all.
    A factor that is zero throughout, and those a key does not meet, get 0. All sums of a key come from one
    aggregation over the complete rows; blocks are solved on these small matrices.
    """
    names = [f for b in blocks for f in b]
    of = sector_factors or {}
    by = [key] + ([sector] if sector else [])
    g = cross_products(df, by, names, ret)
    at = {f: i for i, f in enumerate(names)}

    def stages(own) -> list[list[int]]:
        drop = {f for s, f in of.items() if s != own} if own in of else set()
        if sector_last and own in of:
            return [[at[f] for f in b if f not in of.values()] for b in blocks] + [[at[of[own]]]]
        return [[at[f] for f in b if f not in drop] for b in blocks]

    @pandas_udf(VECTOR)
    def solve(xtx: pd.Series, xty: pd.Series, own: pd.Series) -> pd.Series:
        out = []
        for a, b, o in zip(xtx, xty, own):
            n = len(names)
            out.append(linalg.nested_normal(np.asarray(a, float).reshape(n, n), np.asarray(b, float), stages(o), orthogonal))
        return pd.Series(out)

    own = F.col(sector) if sector else F.lit(None).cast("string")
    return _named(g.withColumn("coef", solve("xtx", "xty", own)), [key], names)


def cochrane_orcutt(df: DataFrame, key: str, xs: Sequence[str], y: str, step: str, passes: int = 100, tol: float = 1e-5) -> DataFrame:
    """Regression with AR(1) errors, alternating rho and coefficients; one series per group.

    The coefficients belong to the rho that is returned; ``converged`` tells whether it has settled.
    """
    names = ["intercept", *xs]
    kt = df.schema[key].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.dropna().sort_values(step)
        rho, b, done = 0.0, np.zeros(len(names)), False
        if len(p) > len(names) + 1:
            x = np.column_stack([np.ones(len(p)), p[list(xs)].to_numpy(float)])
            v = p[y].to_numpy(float)
            for _ in range(passes):
                b = np.linalg.lstsq(x[1:] - rho * x[:-1], v[1:] - rho * v[:-1], rcond=None)[0]
                e = v - x @ b
                new = float(e[1:] @ e[:-1] / max(e[:-1] @ e[:-1], 1e-300))
                done = abs(new - rho) < tol
                rho = new
                if done:
                    break
            b = np.linalg.lstsq(x[1:] - rho * x[:-1], v[1:] - rho * v[:-1], rcond=None)[0]
        return pd.DataFrame([[pdf[key].iloc[0], *b, rho, done]], columns=[key, *names, "rho", "converged"])

    schema = f"{key} {kt}, " + ", ".join(f"`{n}` double" for n in [*names, "rho"]) + ", converged boolean"
    return df.select(key, step, *xs, y).groupBy(key).applyInPandas(fit, schema)


def var1(series: DataFrame, step: str, names: Sequence[str]) -> DataFrame:
    """Coefficients of f_t on f_{t-1} and a constant: one row per equation."""
    lag = series.select((F.col(step) + 1).alias(step), *[F.col(n).alias(f"lag_{n}") for n in names])
    j = series.join(lag, step)
    xs = [f"lag_{n}" for n in names]
    out = None
    for n in names:
        e = coefficients(wls(j, [], xs, n, None, True), [], xs, True).withColumn("equation", F.lit(n))
        out = e if out is None else out.unionByName(e)
    return out.select("equation", "intercept", *xs)


def reduced_rank(df: DataFrame, xs: Sequence[str], ys: Sequence[str], rank: int) -> DataFrame:
    """Rank-r coefficient matrix of ys on xs: (x, y, coef), from one joint cross product."""
    names = [*xs, *ys]
    p, q = len(xs), len(ys)
    g = cross_products(df, [], names, intercept=True)

    @pandas_udf(VECTOR)
    def solve(xtx: pd.Series) -> pd.Series:
        out = []
        for a in xtx:
            m = np.asarray(a, float).reshape(p + q + 1, p + q + 1)
            mu = m[0, 1:] / m[0, 0]
            c = m[1:, 1:] / m[0, 0] - np.outer(mu, mu)
            sxx, sxy = c[:p, :p], c[:p, p:]
            b = np.linalg.pinv(sxx, hermitian=True) @ sxy
            d, v = np.linalg.eigh(sxy.T @ b)
            v = v[:, np.argsort(d)[::-1][:rank]]
            out.append((b @ v @ v.T).ravel())
        return pd.Series(out)

    e = g.select(F.posexplode(solve("xtx")).alias("i", "coef"))
    xn, yn = F.array(*[F.lit(c) for c in xs]), F.array(*[F.lit(c) for c in ys])
    return e.select(F.element_at(xn, (F.floor(div(F.col("i"), q)) + 1).cast("int")).alias("x"), F.element_at(yn, (F.col("i") % q + 1).cast("int")).alias("y"), "coef")


# --- cointegration ------------------------------------------------------------------------


def cointegration(ret: DataFrame, lines: DataFrame, key: str, issuer: str, step: str, lags: int = 2, low: float = 0.67, high: float = 1.5) -> DataFrame:
    """Each line of an issuer against its master line.

    Log prices start from 1; a return without a logarithm (-1 or less, or not finite) counts as missing, which
    leaves the price as it was. Regression through the origin with the coefficient clipped;
    Dickey-Fuller t and rejection level of the error, and the variance of its differences.
    ``lines``: key, issuer, master, or other pairs of an issuer's lines (``linked_pairs``). A pair is one row
    a date, then one row with its dated history.
    """
    w = W.partitionBy(key).orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    r = F.col("ret")
    px = ret.select(key, step, F.sum(F.when((r > -1) & (r < float("inf")), F.log1p(r)).otherwise(0.0)).over(w).alias("lp"))
    mine = px.join(lines.where(F.col(key) != F.col("master")).select(key, issuer, "master"), key)
    m = px.select(F.col(key).alias("master"), step, F.col("lp").alias("mlp"))
    j = mine.join(m, ["master", step])
    c = j.groupBy(issuer, "master", key).agg(
        (div(F.sum(F.col("lp") * F.col("mlp")), F.sum(F.col("mlp") * F.col("mlp")))).alias("raw"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(step, "lp", "mlp"))).alias("_h")
    )
    c = c.withColumn("coef", F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce("raw", F.lit(1.0))))).drop("raw")

    @pandas_udf("adf_t double, level double, err_var double")
    def test(errors: pd.Series) -> pd.DataFrame:
        out = []
        for v in errors:
            v = np.asarray(v, float)
            t, d = linalg.adf_t(v, lags), np.diff(v)
            out.append((t, linalg.adf_level(t, len(v)) if np.isfinite(t) else 1.0, float(np.var(d, ddof=1)) if len(d) > 1 else float("nan")))
        return pd.DataFrame(out, columns=["adf_t", "level", "err_var"])

    coef = F.col("coef")
    out = c.select(key, issuer, "master", "n", "coef", test(F.transform("_h", lambda x: x["lp"] - coef * x["mlp"])).alias("_t"))
    out = out.select(key, issuer, "master", "n", "coef", "_t.*")
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("adf_t", "err_var")})


def cointegration_report(pairs: DataFrame, level: float = 0.05) -> DataFrame:
    """Share of linked pairs whose error is stationary at a level."""
    ok = F.col("level") <= level
    return pairs.agg(F.count("*").alias("n_pairs"), F.sum(F.when(ok, 1).otherwise(0)).alias("n_stationary"), F.avg(F.when(ok, 1.0).otherwise(0.0)).alias("share"), F.avg("coef").alias("mean_coef"))


