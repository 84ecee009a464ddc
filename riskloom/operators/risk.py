"""Factor covariance, specific risk, portfolio risk and betas.

Matrices are rows (f1, f2, value), optionally per date; their side is the number of factors.
They are packed to one small row for eigenvalue work, and reach the assets as one row per
date, so exposures are neither exploded to factor pairs nor shuffled for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.functions import linalg
from riskloom.operators import aggregates as ag, tiles, timeseries as ts
from riskloom.operators.crossprod import VECTOR, pack_matrix, unpack_matrix
from riskloom.operators.ranks import mad_bounds
from riskloom.session import stored
from riskloom.functions.columns import clip, div


# --- matrices -----------------------------------------------------------------------------


def map_matrix(cov: DataFrame, fn: Callable[[list, np.ndarray], np.ndarray], by: Sequence[str] = ()) -> DataFrame:
    """Apply ``fn(names, matrix)`` to each matrix of rows (by, f1, f2, value)."""

    @pandas_udf(VECTOR)
    def run(names: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(fn(list(n), np.asarray(v, float).reshape(len(n), len(n))), float).ravel() for n, v in zip(names, values)])

    p = pack_matrix(cov, "f1", "f2", "value", by)
    return unpack_matrix(p.select(*by, "names", run("names", "values").alias("values")), "names", "values", by)


def floor_eigenvalues(cov: DataFrame, floor: float = 1e-10, by: Sequence[str] = ()) -> DataFrame:
    """Matrix without eigenvalues under the floor."""
    return map_matrix(cov, lambda n, m: linalg.floor_eigenvalues(m, floor), by)


def shrink(cov: DataFrame, n_obs: int, by: Sequence[str] = ()) -> DataFrame:
    """Optimal shrinkage of eigenvalues by the ratio of factors to observations."""
    return map_matrix(cov, lambda n, m: linalg.shrink_eigenvalues(m, n_obs), by)


def impose_blocks(cov: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rotate a covariance so that its diagonal blocks equal the targets.

    ``blocks``: block, f1, f2, value. Names outside every block move with the rotation.
    """
    b = blocks.groupBy(F.lit(1).alias("_one")).agg(F.collect_list(F.struct("block", "f1", "f2", "value")).alias("_b"))
    p = pack_matrix(cov, "f1", "f2", "value").withColumn("_one", F.lit(1)).join(b, "_one")

    @pandas_udf(VECTOR)
    def run(names: pd.Series, values: pd.Series, cells: pd.Series) -> pd.Series:
        out = []
        for nm, v, cs in zip(names, values, cells):
            nm = list(nm)
            at = {n: i for i, n in enumerate(nm)}
            m = np.asarray(v, float).reshape(len(nm), len(nm))
            t = np.eye(len(nm))
            for key in sorted({c["block"] for c in cs}):
                mine = [c for c in cs if c["block"] == key]
                ix = sorted({at[c["f1"]] for c in mine})
                pos = {i: k for k, i in enumerate(ix)}
                target = np.zeros((len(ix), len(ix)))
                for c in mine:
                    target[pos[at[c["f1"]]], pos[at[c["f2"]]]] = c["value"]
                blk = m[np.ix_(ix, ix)]
                rs, rt = linalg.matrix_root(blk), linalg.matrix_root(target)
                u, _, vt = np.linalg.svd(rt @ rs)
                t[np.ix_(ix, ix)] = rt @ (u @ vt) @ linalg.matrix_root(blk, inverse=True)
            out.append((t @ m @ t.T).ravel())
        return pd.Series(out)

    return unpack_matrix(p.select("names", run("names", "values", "_b").alias("values")), "names", "values")


def matrix_row(cov: DataFrame, xs: Sequence[str], by: Sequence[str] = (), name: str = "_F") -> DataFrame:
    """One row per key with the matrix as an array in the order of ``xs``; absent cells are 0."""
    k = len(xs)
    order = F.array(*[F.lit(x) for x in xs])
    i, j = F.array_position(order, F.col("f1")), F.array_position(order, F.col("f2"))
    c = cov.withColumn("_p", ((i - 1) * k + j - 1).cast("int")).where((i > 0) & (j > 0))
    g = c.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_p", "value"))).alias("_m"))
    return g.select(*by, F.transform(F.sequence(F.lit(0), F.lit(k * k - 1)), lambda p: F.coalesce(F.element_at("_m", p.cast("int")), F.lit(0.0))).alias(name))


def attach(df: DataFrame, row: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Join a one-row-per-key table; without keys it is a single row."""
    if by:
        return df.join(row, list(by))
    return df.withColumn("_one", F.lit(1)).join(row.withColumn("_one", F.lit(1)), "_one").drop("_one")


def product_row(a: Sequence[Column], m: str, i: int) -> Column:
    """(F a)_i for a packed matrix column, unrolled into plain arithmetic."""
    k = len(a)
    out = F.get(F.col(m), F.lit(i * k)) * a[0]
    for j in range(1, k):
        out = out + F.get(F.col(m), F.lit(i * k + j)) * a[j]
    return out


def bilinear(a: Sequence[Column], b: Sequence[Column], m: str) -> Column:
    """a' F b."""
    out = product_row(b, m, 0) * a[0]
    for i in range(1, len(a)):
        out = out + product_row(b, m, i) * a[i]
    return out


def _x(xs: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0.0)) for c in xs]


# --- factor covariance --------------------------------------------------------------------


def factor_cov(
    fret: DataFrame, factor: str = "factor", value: str = "value", step: str = "step", corr_half_life: float | None = None, var_half_life: float | None = None,
    corr_lags: int = 1, var_lags: int = 1, overlap: int | None = None, annual: float = 252.0, demean: bool = False, dead_share: float = 0.01,
    dva: int | None = None, shrink_obs: int | None = None, blocks: DataFrame | None = None, floor: float | None = 1e-10,
) -> DataFrame:
    """Composite factor covariance: correlations and deviations with their own half-lives.

    Optional volatility adjustment of the history, overlapping returns in place of lags,
    block correlations imposed by rotation, eigenvalue shrinkage. Factors with under
    ``dead_share`` non-zero returns get zeros.
    """
    x = fret.select(F.col(factor).alias("factor"), F.col(step).alias("step"), F.col(value).alias("value"))
    live = x.groupBy("factor").agg((div(F.sum(F.when(F.coalesce("value", F.lit(0.0)) != 0, 1).otherwise(0)), F.count("*")) >= dead_share).alias("_live"))
    x = x.join(live, "factor").withColumn("value", F.when(F.col("_live"), F.col("value")).otherwise(0.0)).drop("_live")
    if dva:
        x = ts.dva(x, "factor", "value", dva, dt="step").drop("scale")
    if overlap:
        w = W.partitionBy("factor").orderBy("step").rowsBetween(1 - overlap, 0)
        x = x.withColumn("value", ts.product_over(1 + F.coalesce(F.col("value"), F.lit(0.0)), w) - 1)
        corr_lags = var_lags = 0
    c = ag.to_correlation(ag.newey_west(x, "factor", "value", "step", corr_lags, corr_half_life, demean), 0.0)
    v = ag.newey_west(x, "factor", "value", "step", var_lags, var_half_life, demean).where("f1 = f2").select(F.col("f1").alias("f"), F.sqrt(F.greatest("value", F.lit(0.0))).alias("s"))
    if blocks is not None:
        c = impose_blocks(c.select("f1", "f2", F.col("corr").alias("value")), blocks).withColumnRenamed("value", "corr")
    scale = div(annual, overlap or 1)
    out = c.join(v.withColumnsRenamed({"f": "f1", "s": "_s1"}), "f1").join(v.withColumnsRenamed({"f": "f2", "s": "_s2"}), "f2")
    out = out.select("f1", "f2", (F.col("corr") * F.col("_s1") * F.col("_s2") * F.lit(scale)).alias("value"))
    if shrink_obs:
        out = shrink(out, shrink_obs)
    return floor_eigenvalues(out, floor) if floor is not None else out


def block_diagonal(cov: DataFrame, block_of: DataFrame) -> DataFrame:
    """Covariance with zeros between factors of different blocks (factor, block)."""
    b = block_of.select("factor", "block")
    j = cov.join(b.withColumnsRenamed({"factor": "f1", "block": "_b1"}), "f1").join(b.withColumnsRenamed({"factor": "f2", "block": "_b2"}), "f2")
    return j.select("f1", "f2", F.when(F.col("_b1") == F.col("_b2"), F.col("value")).otherwise(0.0).alias("value"))


def stambaugh(series: DataFrame, step: str, long: Sequence[str], short: Sequence[str]) -> DataFrame:
    """Covariance for unequal histories: short series regressed on long ones, moments extended.

    All sums are Spark aggregates over dates; the k x k algebra runs on one row.
    """
    from riskloom.operators.crossprod import cross_products

    names = [*long, *short]
    p = len(long)
    full = cross_products(series, [], long, intercept=True).select(F.col("xtx").alias("_a"))
    both = cross_products(series, [], names, intercept=True).select(F.col("xtx").alias("_b"))

    @pandas_udf(VECTOR)
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for aa, bb in zip(a, b):
            m = np.asarray(aa, float).reshape(p + 1, p + 1)
            v11 = m[1:, 1:] / m[0, 0] - np.outer(m[0, 1:], m[0, 1:]) / m[0, 0] ** 2
            k = len(names) + 1
            s = np.asarray(bb, float).reshape(k, k)
            mu = s[0, 1:] / s[0, 0]
            c = s[1:, 1:] / s[0, 0] - np.outer(mu, mu)
            beta = np.linalg.pinv(c[:p, :p], hermitian=True) @ c[:p, p:]
            left = c[p:, p:] - c[p:, :p] @ beta
            cross = v11 @ beta
            out.append(np.block([[v11, cross], [cross.T, left + beta.T @ v11 @ beta]]).ravel())
        return pd.Series(out)

    row = attach(full, both).select(F.array(*[F.lit(n) for n in names]).alias("names"), run("_a", "_b").alias("values"))
    return unpack_matrix(row, "names", "values")


def stack_cov(models: dict[str, DataFrame], link: DataFrame | None = None) -> DataFrame:
    """Block matrix of several models' covariances; ``link`` adds cross terms (f1, f2, value)."""
    u = None
    for m, c in models.items():
        x = c.select(F.concat_ws("-", F.lit(m), "f1").alias("f1"), F.concat_ws("-", F.lit(m), "f2").alias("f2"), "value")
        u = x if u is None else u.unionByName(x)
    if link is not None:
        u = u.unionByName(link.select("f1", "f2", "value")).unionByName(link.select(F.col("f2").alias("f1"), F.col("f1").alias("f2"), "value"))
    return u


def project_cov(cov: DataFrame, exposures: DataFrame, xs: Sequence[str], key: str) -> DataFrame:
    """X F X' over a short list of keys (currencies, portfolios): rows (k1, k2, value).

    The list's length must not grow with the data: the result is its square.
    """
    long = exposures.select(key, *xs).unpivot([key], list(xs), "f", "x").where("x is not null")
    left = long.join(cov, long["f"] == cov["f1"]).groupBy(F.col(key).alias("k1"), "f2").agg(F.sum(F.col("x") * F.col("value")).alias("_l"))
    return left.join(long.select(F.col(key).alias("k2"), F.col("f").alias("f2"), "x"), "f2").groupBy("k1", "k2").agg(F.sum(F.col("_l") * F.col("x")).alias("value"))


# --- specific risk ------------------------------------------------------------------------


def specific_variance(
    sret: DataFrame, key: str, step: str, ret: str, end: int, n: int, half_life: float | None = None, lags: int = 1, clip_at: float | None = None,
    overlap: int | None = None, first_step: DataFrame | None = None,
) -> DataFrame:
    """Weighted Newey-West variance per asset over the last n steps, missing returns 0.

    With ``overlap`` returns are compounded forward instead of lagged sums. Histories that
    start inside the window are scaled up by total weight over the weight of their life.
    """
    x = sret.where((F.col(step) > end - n) & (F.col(step) <= end)).select(key, step, F.col(ret).alias("_r"))
    if clip_at:
        b = mad_bounds(x, [key], "_r", clip_at, history=True)
        x = x.join(b.select(key, "lower", "upper"), key, "left").withColumn("_r", F.when(F.col("lower").isNull(), F.col("_r")).otherwise(F.greatest("lower", F.least("upper", "_r")))).drop("lower", "upper")
    x = x.withColumn("_r", F.coalesce("_r", F.lit(0.0)))
    w = W.partitionBy(key).orderBy(step)
    if overlap:
        x = x.withColumn("_r", ts.product_over(1 + F.col("_r"), w.rangeBetween(1 - overlap, 0)) - 1)
        lags = 0
    total = sum(2.0 ** (div(-i, half_life)) for i in range(n)) if half_life else float(n)
    x = x.withColumn("_w", (ts.exp_weight(F.lit(end) - F.col(step), half_life) if half_life else F.lit(1.0)) * (div(n, total)))
    v = F.col("_w") * F.col("_r") * F.col("_r")
    for l in range(1, lags + 1):
        prev = F.first(F.sqrt("_w") * F.col("_r")).over(w.rangeBetween(-l, -l))
        x = x.withColumn(f"_l{l}", F.coalesce(prev, F.lit(0.0)) * F.sqrt("_w") * F.col("_r"))
        v = v + 2.0 * (1.0 - l / (lags + 1.0)) * F.col(f"_l{l}")
    g = x.groupBy(key).agg((div(F.sum(v), n)).alias("spec_var"), F.sum(F.when(F.col("_r") != 0, 1).otherwise(0)).alias("n_ret"), F.min(step).alias("_a"))
    if first_step is not None:
        # weight of the life inside the window: a finite geometric sum
        g = g.join(first_step.select(key, F.col("first").alias("_f")), key, "left").withColumn("_life", F.least(F.lit(n), F.lit(end) - F.col("_f") + 1))
        if half_life:
            d = 2.0 ** (div(-1.0, half_life))
            part = div(1 - F.pow(F.lit(d), F.col("_life")), 1 - d)
        else:
            part = F.col("_life").cast("double")
        g = g.withColumn("spec_var", F.col("spec_var") * F.when(F.col("_life") < n, div(total, part)).otherwise(1.0)).drop("_f", "_life")
    if overlap:
        g = g.withColumn("spec_var", div(F.col("spec_var"), overlap))
    return g.drop("_a")


def blend_specific(var: DataFrame, proxy: DataFrame, key: str, half_life: float, annual: float = 252.0, floor: float = 0.0, cap: float = float("inf")) -> DataFrame:
    """Variance blended with a proxy by 2^(-n_ret / (half_life / 2)), bounded, annual."""
    j = var.join(proxy.select(key, F.col("spec_var").alias("_p")), key, "left")
    w = F.pow(F.lit(2.0), div(-F.col("n_ret"), half_life / 2.0))
    v = F.when(F.col("_p").isNull(), F.col("spec_var")).otherwise((1 - w) * F.col("spec_var") + w * F.col("_p"))
    v = F.greatest(F.lit(floor), F.least(F.lit(cap), v * annual))
    return j.select(key, "n_ret", v.alias("spec_var"), F.sqrt(v).alias("spec_risk"))


def proxy_variance(var: DataFrame, attributes: DataFrame, key: str, groups: Sequence[str], cap: str, least: int) -> DataFrame:
    """Root-cap mean variance of the group for assets, from those with enough returns."""
    j = var.join(attributes.select(key, *groups, cap), key)
    ok = F.col("n_ret") >= least
    w = F.sqrt(F.col(cap))
    g = j.where(ok).groupBy(*groups).agg((div(F.sum(w * F.col("spec_var")), F.sum(w))).alias("_v"))
    return j.select(key, *groups).join(g, list(groups), "left").select(key, F.col("_v").alias("spec_var"))


def linked_correlation(sret: DataFrame, lines: DataFrame, key: str, group: str, step: str, ret: str, end: int, half_life: float, lags: int = 1, lo: float = 0.25, hi: float = 0.99995, confidence: float = 0.67) -> DataFrame:
    """Correlation of each line with its group's master, from weighted Newey-West sums.

    Clipped to [lo, hi] and moved to 1: (1 - c) + c rho. ``lines``: key, group, master, or other pairs of a group's
    lines from ``linked_pairs``. A pair costs one row a date.
    """
    x = sret.where(F.col(step) <= end).select(key, step, F.coalesce(F.col(ret), F.lit(0.0)).alias("_r"))
    x = x.withColumn("_s", F.sqrt(ts.exp_weight(F.lit(end) - F.col(step), half_life)) * F.col("_r"))
    a = x.join(lines.where(F.col(key) != F.col("master")).select(key, group, "master"), key)
    b = x.select(F.col(key).alias("master"), step, F.col("_s").alias("_m"))
    j = a.join(b, ["master", step])
    w = W.partitionBy(group, "master", key).orderBy(step)
    sxx, syy, sxy = F.col("_s") * F.col("_s"), F.col("_m") * F.col("_m"), F.col("_s") * F.col("_m")
    for l in range(1, lags + 1):
        j = j.withColumns({f"_s{l}": F.coalesce(F.lag("_s", l).over(w), F.lit(0.0)), f"_m{l}": F.coalesce(F.lag("_m", l).over(w), F.lit(0.0))})
        f = 1.0 - l / (lags + 1.0)
        sxx = sxx + 2 * f * F.col("_s") * F.col(f"_s{l}")
        syy = syy + 2 * f * F.col("_m") * F.col(f"_m{l}")
        sxy = sxy + f * (F.col("_s") * F.col(f"_m{l}") + F.col("_m") * F.col(f"_s{l}"))
    g = j.groupBy(group, "master", key).agg(F.sum(sxx).alias("_xx"), F.sum(syy).alias("_yy"), F.sum(sxy).alias("_xy"))
    rho = F.when((F.col("_xx") > 0) & (F.col("_yy") > 0), div(F.col("_xy"), F.sqrt(F.col("_xx") * F.col("_yy")))).otherwise(0.0)
    c = F.greatest(F.lit(lo), F.least(F.lit(hi), rho))
    return g.select(group, "master", key, ((1 - confidence) + confidence * c).alias("corr"))


def linked_pairs(lines: DataFrame, key: str, group: str) -> DataFrame:
    """Every ordered pair of different lines of a group: group, master, key.

    The other line stands as ``master``, so what is measured against master lines can be measured for all pairs.
    """
    x = lines.select(group, key).distinct()
    return x.join(x.withColumnRenamed(key, "master"), group).where(F.col(key) != F.col("master")).select(group, "master", key)


def linked_covariance(spec: DataFrame, coint: DataFrame, direct: DataFrame, lines: DataFrame, key: str, group: str, lo: float = 0.75, hi: float = 0.99995, annual: float = 1.0, fewest: int = 5, most: int = 400, side: int = 512) -> dict[str, DataFrame]:
    """Variances of linked lines after cointegration, and the covariance of every pair of a group's lines.

    A line's variance becomes coef^2 x master's + error variance, by the coefficient of the line on its master or of
    the master on the line, where that is nearer the master's; the nearest stays. A pair's correlation is the larger
    of coef x risk ratio both ways, bounded; each group's matrix is then made positive semidefinite with ones on its
    diagonal. Pairs of less than ``fewest`` common dates have no fit: coefficient 1, no error. Where a variance is
    missing or zero the direct correlation stays, and ``hi`` where there is none either.

    ``spec``: key, spec_var; ``lines``: key, group, master; ``coint``: of all ``linked_pairs``; ``direct``: of each pair
    in one order. Pairs are rows; the matrix of a group of up to ``most`` lines is one task's, larger ones are tiles.
    """
    fit = coint.where(F.col("n") >= fewest).select(group, "master", key, F.col("coef").alias("_on"), F.coalesce("err_var", F.lit(0.0)).alias("_err"))
    swapped = [group, F.col("master").alias(key), F.col(key).alias("master")]
    both = fit.join(fit.select(*swapped, F.col("_on").alias("_back")), [group, "master", key], "full")
    on, back = F.coalesce("_on", F.lit(1.0)), F.coalesce("_back", F.lit(1.0))
    one = lines.select(group, key, "master").distinct()
    m = spec.select(F.col(key).alias("master"), F.col("spec_var").alias("_mv"))
    j = one.where(F.col(key) != F.col("master")).join(both, [group, "master", key], "left").join(spec.select(key, "spec_var"), key).join(m, "master")
    new, mv = F.col("spec_var"), F.col("_mv")
    for b in (on, back):
        cand = b * b * mv + F.coalesce("_err", F.lit(0.0)) * annual
        new = F.when(F.abs(cand - mv) < F.abs(new - mv), cand).otherwise(new)
    var = stored(spec.join(j.select(key, new.alias("_new")), key, "left").select(key, F.coalesce("_new", "spec_var").alias("spec_var")))

    known = direct.select(group, "master", key, F.col("corr").alias("_direct"))
    known = known.unionByName(known.select(*swapped, "_direct")).where(F.col(key) > F.col("master"))
    x = linked_pairs(lines, key, group).where(F.col(key) > F.col("master")).join(both, [group, "master", key], "left").join(known, [group, "master", key], "left")
    x = x.join(var.select(key, F.sqrt("spec_var").alias("_s2")), key).join(var.select(F.col(key).alias("master"), F.sqrt("spec_var").alias("_s1")), "master")
    ratio = F.greatest(div(on * F.col("_s1"), F.col("_s2")), div(back * F.col("_s2"), F.col("_s1")))
    rho = F.coalesce(clip(ratio, lo, hi), "_direct", F.lit(hi))
    x = x.select(group, F.col("master").alias("id1"), F.col(key).alias("id2"), rho.alias("corr"), "_s1", "_s2").join(one.select(group, F.col(key).alias("id2"), "master"), [group, "id2"])
    pairs = _semidefinite(x, one.select(group, key), key, group, most, side)
    m = F.col("master")
    return {"variance": var, "pairs": pairs.select(group, "id1", "id2", "corr", (F.col("corr") * F.col("_s1") * F.col("_s2")).alias("cov"), "master", F.when(m == F.col("id1"), F.col("id2")).when(m == F.col("id2"), F.col("id1")).alias("line"))}


def _semidefinite(pairs: DataFrame, lines: DataFrame, key: str, group: str, most: int, side: int) -> DataFrame:
    """Rows (group, id1, id2, corr, ...) of all pairs, each group's matrix without eigenvalues under 1e-8 and with ones on its diagonal."""
    columns = [c for c in pairs.columns if c != group]

    @pandas_udf(VECTOR)
    def fix(id1: pd.Series, id2: pd.Series, corr: pd.Series) -> pd.Series:
        out = []
        for a, b, c in zip(id1, id2, corr):
            n = len(a)
            _, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            m = np.eye(at.max() + 1)
            m[at[:n], at[n:]] = m[at[n:], at[:n]] = c
            out.append(linalg.unit_diagonal(m)[at[:n], at[n:]])
        return pd.Series(out)

    of = lambda c: F.col("_p")[c]
    at = lines.select(F.col(group).alias("g"), key, (F.row_number().over(W.partitionBy(group).orderBy(key)) - 1).alias("r"))
    large = stored(lines.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(group))
    g = pairs.join(large, group, "left_anti").groupBy(group).agg(F.collect_list(F.struct(*columns)).alias("_p"))
    g = g.select(group, "_p", F.when(F.size("_p") > 1, fix(of("id1"), of("id2"), of("corr"))).otherwise(of("corr")).alias("_c"))
    out = g.select(group, F.explode(F.arrays_zip("_p", "_c")).alias("_z")).select(group, *[F.col("_z._p")[c].alias(c) for c in columns if c != "corr"], F.col("_z._c").alias("corr"))
    if large.isEmpty():
        return out
    at = at.join(large.withColumnRenamed(group, "g"), "g")
    x = pairs.join(large, group).join(at.select(F.col("g").alias(group), F.col(key).alias("id1"), "r"), [group, "id1"])
    x = stored(x.join(at.select(F.col("g").alias(group), F.col(key).alias("id2"), F.col("r").alias("c")), [group, "id2"]))
    e = x.select(F.col(group).alias("g"), "r", "c", F.col("corr").alias("v"))
    e = e.unionByName(e.select("g", F.col("c").alias("r"), F.col("r").alias("c"), "v")).unionByName(at.select("g", "r", F.col("r").alias("c"), F.lit(1.0).alias("v")))
    e = tiles.to_entries(tiles.semidefinite(tiles.from_entries(e, side))).withColumnsRenamed({"g": group, "v": "corr"})
    return out.unionByName(x.drop("corr").join(e, [group, "r", "c"]).drop("r", "c"))


def merged_covariance(sret: DataFrame, members: DataFrame, linked: dict[str, DataFrame], key: str, issuer: str, step: str, ret: str, end: int, half_life: float, most: int = 400, side: int = 512) -> DataFrame:
    """One positive semidefinite covariance for each merged group of issuers: merged, id1 <= id2, corr, cov, dense.

    ``members``: (issuer, key, merged); ``linked``: result of ``linked_covariance`` on the issuers. The group's
    correlation starts from its lines' weighted specific returns; then each issuer's block is turned into the
    cointegrated one by the rotation that moves least, which leaves the whole positive semidefinite. Two lines
    without a pair in ``linked`` have the product of their correlations with the master. Variances are those of
    ``linked``. A line of two issuers is in the block of the smaller one. A group of up to ``most`` lines is one
    task's matrix (``dense``); larger ones are tiles of ``side`` lines, with the same steps and pairs.
    """
    one = members.groupBy(key).agg(F.min(issuer).alias(issuer), F.min("merged").alias("merged"))
    size = one.groupBy("merged").agg(F.count(F.lit(1)).alias("_size"), F.count_distinct(issuer).alias("_issuers")).where("_issuers > 1")
    pairs = linked["pairs"]
    star = pairs.where("line is not null").select(F.col("line").alias(key), F.col("corr").alias("_c"), F.col("master").cast("string").alias("_m"))
    info = one.join(size, "merged").join(linked["variance"], key).join(star, key, "left")
    info = stored(info.select("merged", key, F.col(issuer).cast("string").alias("_issuer"), "spec_var", "_c", "_m", "_size"))
    line = info.select("merged", "_issuer", key, "_size")
    known = pairs.select("id1", "id2", "corr").join(line.withColumnRenamed(key, "id1"), "id1").join(line.drop("_size").withColumnRenamed(key, "id2"), ["merged", "_issuer", "id2"])
    partners = known.where(F.col("_size") <= most).groupBy("merged", F.col("id1").alias(key)).agg(F.collect_list("id2").alias("_ids"), F.collect_list("corr").alias("_corrs"))
    dense = info.where(F.col("_size") <= most).join(partners, ["merged", key], "left")
    rows = sret.where(F.col(step) <= end).join(dense.select(F.col("merged").alias("_g"), key), key).select("_g", key, step, F.col(ret).alias("_r"))
    kt, gt = members.schema[key].dataType.simpleString(), members.schema["merged"].dataType.simpleString()

    def assemble(lines: pd.DataFrame, returns: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values(key).reset_index(drop=True)
        ids = lines[key].tolist()
        r = returns.pivot_table(index=step, columns=key, values="_r", aggfunc="last").reindex(columns=ids)
        w = 0.5 ** ((end - r.index.to_numpy(float)) / half_life) if len(r) else np.zeros(0)
        corr = linalg.unit_diagonal(linalg.pair_correlation(r.to_numpy(float), w))
        c, masters = lines["_c"].to_numpy(float), set(lines["_m"].dropna())
        c = np.where([str(i) in masters for i in ids], 1.0, np.where(np.isfinite(c), c, 0.0))
        pos = {x: i for i, x in enumerate(ids)}
        want = np.outer(c, c) + np.diag(1 - c**2)
        for i, (others, values) in enumerate(zip(lines["_ids"], lines["_corrs"])):
            if others is not None:
                j = [pos[x] for x in others]
                want[i, j] = want[j, i] = values
        for _, at in lines.groupby("_issuer").groups.items():
            at = list(at)
            if len(at) > 1:
                corr = linalg.impose_block(corr, at, linalg.unit_diagonal(want[np.ix_(at, at)]))
        corr = linalg.unit_diagonal(corr)
        sd = np.sqrt(lines["spec_var"].to_numpy(float))
        i, j = np.triu_indices(len(ids))
        merged = lines["merged"].iloc[0] if len(lines) else None
        return pd.DataFrame({"merged": merged, "id1": [ids[a] for a in i], "id2": [ids[a] for a in j], "corr": corr[i, j], "cov": corr[i, j] * sd[i] * sd[j], "dense": True})

    schema = f"merged {gt}, id1 {kt}, id2 {kt}, corr double, cov double, dense boolean"
    out = dense.groupBy("merged").cogroup(rows.groupBy("_g")).applyInPandas(assemble, schema)
    large = info.where(F.col("_size") > most)
    if large.isEmpty():
        return out
    masters = large.select("merged", F.col("_m").alias("_id")).distinct().where("_id is not null").withColumn("_master", F.lit(1.0))
    large = large.withColumn("_id", F.col(key).cast("string")).join(masters, ["merged", "_id"], "left").withColumn("_c", F.coalesce("_master", "_c", F.lit(0.0)))
    block = F.concat_ws("/", F.col("merged").cast("string"), "_issuer")
    order = W.partitionBy("merged").orderBy("_issuer", key)
    large = large.select(F.col("merged").alias("g"), key, "spec_var", "_c", block.alias("b"), (F.row_number().over(order) - 1).alias("r"), (F.row_number().over(W.partitionBy(block).orderBy(key)) - 1).alias("_at"), F.count(F.lit(1)).over(W.partitionBy(block)).alias("_n"))
    large = stored(large)
    other = large.select("g", "b", F.col("r").alias("c"), F.col(key).alias("_key2"), F.col("spec_var").alias("_var2"), F.col("_c").alias("_c2"), F.col("_at").alias("_at2"))
    corr = _merged_tiles(sret.where(F.col(step) <= end).select(key, F.col(step).alias("step"), F.col(ret).alias("v")), large, other, known.where(F.col("_size") > most), key, end, half_life, most, side)
    e = tiles.to_entries(corr).where("r <= c").join(large.select("g", "r", key, "spec_var"), ["g", "r"]).join(other.drop("b"), ["g", "c"])
    cov = F.col("v") * F.sqrt("spec_var") * F.sqrt("_var2")
    return out.unionByName(e.select(F.col("g").alias("merged"), F.least(key, "_key2").alias("id1"), F.greatest(key, "_key2").alias("id2"), F.col("v").alias("corr"), cov.alias("cov"), F.lit(False).alias("dense")))


def _merged_tiles(returns: DataFrame, lines: DataFrame, other: DataFrame, known: DataFrame, key: str, end: int, half_life: float, most: int, side: int) -> DataFrame:
    """What ``merged_covariance`` does in a task, on tiles: pair correlations, made semidefinite, with the blocks of issuers turned.

    Matrix functions change no entry of other issuers' blocks, so one transformation holds the turns of all. The last
    floor of eigenvalues is left out: what is turned has none under 0, and the floor of 1e-8 would move no entry by more.
    """
    start = tiles.pair_correlation(returns.join(lines.select("g", key, "r"), key).select("g", "r", "step", "v"), lines, float(end), half_life, side)
    start = tiles.semidefinite(start)
    # entries inside issuers' blocks, with what they become
    at = lines.select("g", "b", F.expr(f"cast(r div {side} as int)").alias("i")).distinct()
    near = at.join(at.withColumnRenamed("i", "j"), ["g", "b"]).select("g", "i", "j").distinct()
    inside = tiles.to_entries(start.join(near, ["g", "i", "j"], "left_semi")).join(lines.select("g", "b", "r", key, "_c", "_at", "_n"), ["g", "r"]).join(other.drop("_var2"), ["g", "b", "c"])
    known = known.select(F.col("merged").alias("g"), F.col("id1").alias(key), F.col("id2").alias("_key2"), F.col("corr").alias("_k"))
    known = known.unionByName(known.select("g", F.col("_key2").alias(key), F.col(key).alias("_key2"), "_k"))
    want = F.when(F.col("r") == F.col("c"), 1.0).otherwise(F.coalesce("_k", F.col("_c") * F.col("_c2")))
    inside = stored(inside.join(known, ["g", key, "_key2"], "left").select("g", "b", "r", "c", "v", "_n", "_at", "_at2", want.alias("_want")))

    def turn(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["_n"].iloc[0])
        m, t = np.eye(n), np.eye(n)
        i, j = pdf["_at"].to_numpy(), pdf["_at2"].to_numpy()
        m[i, j], t[i, j] = pdf["v"], pdf["_want"]
        return pdf[["g", "r", "c"]].assign(v=linalg.block_transform(m, linalg.unit_diagonal(t))[i, j] if n > 1 else 1.0)

    schema = f"g {lines.schema['g'].dataType.simpleString()}, r long, c long, v double"
    turned = inside.where(F.col("_n") <= most).groupBy("b").applyInPandas(turn, schema)
    wide = inside.where(F.col("_n") > most)
    if not wide.isEmpty():
        local = lambda v: tiles.from_entries(wide.select(F.col("b").alias("g"), F.col("_at").alias("r"), F.col("_at2").alias("c"), F.col(v).alias("v")), side)
        t = tiles.to_entries(tiles.transform(local("v"), tiles.semidefinite(local("_want")))).select(F.col("g").alias("b"), F.col("r").alias("_at"), F.col("c").alias("_at2"), "v")
        turned = turned.unionByName(wide.drop("v").join(t, ["b", "_at", "_at2"]).select("g", "r", "c", "v"))
    t = stored(tiles.from_entries(turned, side))
    return stored(tiles.unit_diagonal(tiles.multiply(tiles.multiply(t, start), t, transposed=True)))


# --- risk of assets and portfolios --------------------------------------------------------


def total_risk(exp: DataFrame, cov: DataFrame, spec: DataFrame, xs: Sequence[str], key: str = "asset_id", by: Sequence[str] = ()) -> DataFrame:
    """sqrt(x' F x + s^2) per asset, with its factor and specific parts."""
    j = attach(exp, matrix_row(cov, xs, by), by).join(spec.select(*by, key, "spec_var"), [*by, key])
    fv = bilinear(_x(xs), _x(xs), "_F")
    j = j.withColumn("factor_var", fv)
    return j.select(*by, key, "factor_var", "spec_var", F.sqrt(F.col("factor_var") + F.col("spec_var")).alias("total_risk"))


def portfolio_exposure(weights: DataFrame, exp: DataFrame, xs: Sequence[str], name: str = "name", key: str = "asset_id", by: Sequence[str] = ()) -> DataFrame:
    """h'X per portfolio: map-side sums, one column per factor."""
    j = weights.join(exp.select(*by, key, *xs), [*by, key])
    return j.groupBy(*by, name).agg(*[F.sum(F.col("weight") * F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c in xs])


def portfolio_risk(weights: DataFrame, exp: DataFrame, cov: DataFrame, spec: DataFrame, xs: Sequence[str], pairs: DataFrame | None = None, name: str = "name", key: str = "asset_id", by: Sequence[str] = ()) -> DataFrame:
    """Factor, specific and total variance and risk of many portfolios at once.

    ``pairs`` (id1, id2, cov) adds the covariances of linked lines held together.
    """
    e = attach(portfolio_exposure(weights, exp, xs, name, key, by), matrix_row(cov, xs, by), by)
    f = e.select(*by, name, bilinear(_x(xs), _x(xs), "_F").alias("factor_var"))
    s = weights.join(spec.select(*by, key, "spec_var"), [*by, key]).groupBy(*by, name).agg(F.sum(F.col("weight") * F.col("weight") * F.col("spec_var")).alias("specific_var"))
    out = f.join(s, [*by, name], "left")
    extra = F.lit(0.0)
    if pairs is not None:
        a = weights.select(*by, name, F.col(key).alias("id1"), F.col("weight").alias("_w1"))
        b = weights.select(*by, name, F.col(key).alias("id2"), F.col("weight").alias("_w2"))
        l = pairs.join(a, "id1").join(b, [*by, name, "id2"]).groupBy(*by, name).agg((2 * F.sum(F.col("_w1") * F.col("_w2") * F.col("cov"))).alias("linked_var"))
        out = out.join(l, [*by, name], "left")
        extra = F.coalesce("linked_var", F.lit(0.0))
    out = out.withColumn("specific_var", F.coalesce("specific_var", F.lit(0.0)) + extra)
    return out.select(*by, name, "factor_var", "specific_var", F.sqrt(F.col("factor_var") + F.col("specific_var")).alias("risk"))


def active_weights(weights: DataFrame, benchmark: DataFrame, name: str = "name", key: str = "asset_id") -> DataFrame:
    """Portfolio less benchmark weights.

    ``benchmark``: name (of the portfolio it belongs to), key, weight.
    """
    u = weights.select(name, key, "weight").unionByName(benchmark.select(name, key, (-F.col("weight")).alias("weight")))
    return u.groupBy(name, key).agg(F.sum("weight").alias("weight"))


def portfolio_corr(weights: DataFrame, exp: DataFrame, cov: DataFrame, spec: DataFrame, xs: Sequence[str], name: str = "name", key: str = "asset_id") -> DataFrame:
    """Covariance and correlation of a short list of standard portfolios.

    Factor parts come from exposures, specific parts from holdings that portfolios share:
    per asset one vector over the portfolios, multiplied and added up in tasks.
    """
    from riskloom.operators.crossprod import gram

    e = portfolio_exposure(weights, exp, xs, name, key)
    f = project_cov(cov, e, xs, name).select(F.col("k1").cast("string").alias("f1"), F.col("k2").cast("string").alias("f2"), "value")
    own = weights.join(spec.select(key, "spec_var"), key).withColumn("_v", F.col("weight") * F.sqrt("spec_var"))
    s = gram(own, key, name, "_v").withColumnsRenamed({"i": "f1", "j": "f2"})
    c = f.unionByName(s).groupBy("f1", "f2").agg(F.sum("value").alias("value"))
    d = c.where("f1 = f2").select(F.col("f1").alias("_f"), F.sqrt("value").alias("_s"))
    j = c.join(d.withColumnsRenamed({"_f": "f1", "_s": "_s1"}), "f1").join(d.withColumnsRenamed({"_f": "f2", "_s": "_s2"}), "f2")
    return j.select("f1", "f2", "value", (div(F.col("value"), F.col("_s1") * F.col("_s2"))).alias("corr"), F.col("_s1").alias("risk1"))


def marginal_contribution(weights: DataFrame, exp: DataFrame, cov: DataFrame, spec: DataFrame, xs: Sequence[str], with_specific: bool = False, name: str = "name", key: str = "asset_id") -> DataFrame:
    """X F X'h / total risk per portfolio and held asset; the specific part on request."""
    risk = portfolio_risk(weights, exp, cov, spec, xs, None, name, key).select(name, "risk")
    p = portfolio_exposure(weights, exp, xs, name, key).withColumnsRenamed({c: f"_p_{c}" for c in xs})
    j = weights.join(exp.select(key, *xs), key).join(p, name).join(risk, name)
    j = attach(j, matrix_row(cov, xs))
    m = bilinear(_x(xs), [F.col(f"_p_{c}") for c in xs], "_F")
    if with_specific:
        j = j.join(spec.select(key, "spec_var"), key, "left")
        m = m + F.col("weight") * F.coalesce("spec_var", F.lit(0.0))
    return j.select(name, key, "weight", (div(m, F.col("risk"))).alias("mctr"))


def predicted_beta(exp: DataFrame, cov: DataFrame, spec: DataFrame, market: DataFrame, xs: Sequence[str], key: str = "asset_id", mkt: str = "market", cash: Sequence = ()) -> DataFrame:
    """Covariance with the asset's market over the market's variance; cash is 0.

    ``exp`` carries the asset's market; ``market``: market, key, weight.
    """
    w = market.withColumnRenamed(mkt, "name")
    var = portfolio_risk(w, exp, cov, spec, xs, None, "name", key).select(F.col("name").alias(mkt), (F.col("risk") * F.col("risk")).alias("_var"))
    p = portfolio_exposure(w, exp, xs, "name", key).withColumnsRenamed({"name": mkt, **{c: f"_p_{c}" for c in xs}})
    j = attach(exp.join(p, mkt).join(var, mkt), matrix_row(cov, xs))
    own = market.select(mkt, key, F.col("weight").alias("_w"))
    j = j.join(own, [mkt, key], "left").join(spec.select(key, "spec_var"), key, "left")
    c = bilinear(_x(xs), [F.col(f"_p_{x}") for x in xs], "_F") + F.coalesce(F.col("_w") * F.col("spec_var"), F.lit(0.0))
    beta = div(c, F.col("_var"))
    if cash:
        beta = F.when(F.col(key).isin(*cash), 0.0).otherwise(beta)
    return j.select(mkt, key, beta.alias("beta"))


def beta_decomposition(exp: DataFrame, cov: DataFrame, spec: DataFrame, market: DataFrame, xs: Sequence[str], key: str = "asset_id", mkt: str = "market") -> DataFrame:
    """Contribution of each factor, and of the specific part, to the predicted beta."""
    w = market.withColumnRenamed(mkt, "name")
    var = portfolio_risk(w, exp, cov, spec, xs, None, "name", key).select(F.col("name").alias(mkt), (F.col("risk") * F.col("risk")).alias("_var"))
    p = portfolio_exposure(w, exp, xs, "name", key).withColumnsRenamed({"name": mkt, **{c: f"_p_{c}" for c in xs}})
    j = attach(exp.join(p, mkt).join(var, mkt), matrix_row(cov, xs))
    j = j.join(market.select(mkt, key, F.col("weight").alias("_w")), [mkt, key], "left").join(spec.select(key, "spec_var"), key, "left")
    b = [F.col(f"_p_{x}") for x in xs]
    parts = {f"c_{x}": div(_x(xs)[i] * product_row(b, "_F", i), F.col("_var")) for i, x in enumerate(xs)}
    parts["c_specific"] = div(F.coalesce(F.col("_w") * F.col("spec_var"), F.lit(0.0)), F.col("_var"))
    return j.select(mkt, key, *[c.alias(n) for n, c in parts.items()]).unpivot([mkt, key], list(parts), "part", "contribution").withColumn("part", F.substring("part", 3, 100))


def risk_series(weights: DataFrame, exp: DataFrame, cov: DataFrame, spec: DataFrame, xs: Sequence[str], dt: str = "dt") -> DataFrame:
    """Total risk of portfolios over dates; every table carries the date."""
    return portfolio_risk(weights, exp, cov, spec, xs, by=[dt]).select(dt, "name", "risk")


def linked_specific(assignment: DataFrame, specs: dict[str, DataFrame], key: str = "asset_id") -> DataFrame:
    """Specific variance of each asset from the model it is assigned to."""
    u = None
    for m, s in specs.items():
        x = s.select(key, "spec_var").withColumn("model", F.lit(m))
        u = x if u is None else u.unionByName(x)
    return assignment.select(key, "model").join(u, [key, "model"])


def currency_block(ccy_ret: DataFrame, ccy_exp: DataFrame, ccy: str, dt: str, ret: str, xs: Sequence[str], estu: Sequence | None = None, annual: float = 252.0) -> dict[str, DataFrame]:
    """Currency factor returns rebuilt as X f for all currencies, and their covariance X C X'.

    Statistical factor returns come from least squares over the estimation currencies.
    """
    from riskloom.operators.regressions import wls

    j = ccy_ret.join(ccy_exp, ccy)
    fit = wls(j.where(F.col(ccy).isin(*estu)) if estu else j, [dt], xs, ret).select(dt, "coef")
    rows = fit.select(dt, *[F.col("coef")[i].alias(x) for i, x in enumerate(xs)]).unpivot([dt], list(xs), "factor", "value")
    rebuilt = ccy_ret.select(ccy, dt).join(ccy_exp, ccy).join(fit, dt)
    val = sum((F.col("coef")[i] * F.col(x) for i, x in enumerate(xs)), F.lit(0.0))
    cov = ag.covariance(rows, "factor", "value", dt).withColumn("value", F.col("value") * annual)
    return {"returns": rebuilt.select(ccy, dt, val.alias("value")), "covariance": project_cov(cov, ccy_exp, xs, ccy)}


# --- parameters ---------------------------------------------------------------------------

# Half-lives in days (correlation, variance, specific), lags and bounds by horizon.
HORIZONS = [
    ("short", 125, 60, 60, 1, 0.0001, 9.0),
    ("medium", 250, 125, 125, 1, 0.0001, 9.0),
    ("long", 500, 250, 250, 2, 0.0001, 9.0),
    ("full", 500, 250, 250, 5, 0.0001, 9.0),
]


def parameters(spark: SparkSession, models: Sequence[str]) -> DataFrame:
    """Parameter rows per model and horizon."""
    rows = [(m, *h) for m in models for h in HORIZONS]
    return spark.createDataFrame(rows, "model string, horizon string, corr_half_life int, var_half_life int, spec_half_life int, lags int, min_var double, max_var double")
