"""Factor returns: cross-sectional regressions, thin factors, principal components.

Wide exposures hold one column per factor. All dates go through one aggregation; what is
solved is k x k per date, or T x T (dates of a window) for asymptotic components. The
Gramian over dates is summed from batches of asset histories, so assets never meet in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from riskloom.functions import linalg
from riskloom.operators import timeseries as ts
from riskloom.operators.crossprod import cross_products, gram, inverse_sym, pack_matrix, unpack_matrix
from riskloom.operators.regressions import huber_cross_section, residuals, wls
from riskloom.operators.standardize import clip_outliers
from riskloom.session import cut, stored
from riskloom.functions.columns import div


def regression_weight(kind: str, cap: str, spec_var: str | None = None) -> Column:
    """Root-cap, cap, equal or inverse specific variance weights."""
    return {
        "root_cap": lambda: F.sqrt(F.col(cap)), "cap": lambda: F.col(cap), "equal": lambda: F.lit(1.0),
        "inverse_variance": lambda: div(1.0, F.when(F.col(spec_var) > 0, F.col(spec_var))),
    }[kind]()


def factor_regression(
    exp: DataFrame, dt: str, xs: Sequence[str], ret: str, cap: str, estu: str | None = None, weights: str = "root_cap", spec_var: str | None = None,
    clip_at: float | None = 25.0, robust: bool = False, dummies: DataFrame | None = None,
) -> DataFrame:
    """Factor returns per date as array ``coef``, from the estimation universe.

    Returns are clipped at MAD bounds first unless the fit is robust. ``dummies`` adds rows
    (dt, factors, return, ``_w``) that support thin factors.
    """
    x = exp.where(F.col(estu)) if estu else exp
    x = x.withColumn("_w", regression_weight(weights, cap, spec_var))
    if clip_at and not robust:
        x = clip_outliers(x, [dt], ret, clip_at, zero_tolerance=0.0)
    x = x.select(dt, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in xs], ret, "_w")
    if dummies is not None:
        x = x.unionByName(dummies.select(dt, *xs, ret, "_w"))
    if robust:
        return huber_cross_section(x, [dt], xs, ret, "_w")
    return wls(x, [dt], xs, ret, "_w").select(dt, "coef", "n")


def factor_rows(fit: DataFrame, dt: str, xs: Sequence[str]) -> DataFrame:
    """Coefficients as rows (dt, factor, value)."""
    return fit.select(dt, *[F.col("coef")[i].alias(x) for i, x in enumerate(xs)]).unpivot([dt], list(xs), "factor", "value")


def specific_returns(exp: DataFrame, fit: DataFrame, dt: str, xs: Sequence[str], ret: str) -> DataFrame:
    """r - X f for every asset, in or out of the universe."""
    x = exp.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in xs})
    return residuals(x, fit, [dt], xs, ret, False, "sret")


def nested(exp: DataFrame, dt: str, ret: str, cap: str, steps: Sequence[tuple[str, Sequence[str], str]]) -> tuple[DataFrame, DataFrame]:
    """Regressions one after another on what the former left.

    ``steps``: (name, factor columns, universe flag). Returns factor rows and residuals.
    """
    x, rows = exp.withColumn("_y", F.col(ret)), None
    for name, xs, estu in steps:
        fit = factor_regression(x, dt, xs, "_y", cap, estu, clip_at=None)
        r = factor_rows(fit, dt, xs).withColumn("regression", F.lit(name))
        rows = r if rows is None else rows.unionByName(r)
        x = specific_returns(x, fit, dt, xs, "_y").withColumn("_y", F.col("sret")).drop("sret")
    return rows, x.withColumnRenamed("_y", "sret")


def factor_widths(exp: DataFrame, dt: str, xs: Sequence[str], weight: str, styles: Sequence[str] = ()) -> DataFrame:
    """Effective number, total weight and mean style exposures per (dt, factor)."""
    aggs = []
    for c in xs:
        fw = F.abs(F.coalesce(F.col(weight) * F.col(c), F.lit(0.0)))
        aggs += [F.sum(fw).alias(f"t|{c}"), F.sum(fw * fw).alias(f"q|{c}")]
        on = F.coalesce(F.col(c), F.lit(0.0)) != 0
        for s in styles:
            aggs.append((div(F.sum(F.when(on, F.col(weight) * F.col(s))), F.sum(F.when(on, F.col(weight))))).alias(f"{s}|{c}"))
    g = exp.groupBy(dt).agg(*aggs)
    per = [F.struct(F.lit(c).alias("factor"), F.col(f"t|{c}").alias("total"), F.col(f"q|{c}").alias("sq"), *[F.col(f"{s}|{c}").alias(s) for s in styles]) for c in xs]
    e = g.select(dt, F.explode(F.array(*per)).alias("_r")).select(dt, "_r.*")
    return e.withColumn("eff_n", F.when(F.col("total") > 0, div(F.col("total") * F.col("total"), F.col("sq"))).otherwise(0.0)).drop("sq")


def thin_dummies(exp: DataFrame, dt: str, xs: Sequence[str], thin: Sequence[str], ret: str, weight: str, threshold: float = 6.0, form: str = "linear", styles: Sequence[str] = (), sector_ret: DataFrame | None = None) -> DataFrame:
    """One supporting row per thin factor and date.

    Its weight is (threshold - N) total / N, or the fourth-power form; its return is the
    weighted market return (or the sector's, by factor); its style exposures are the means
    of the factor's members. Empty factors get none.
    """
    w = factor_widths(exp, dt, thin, weight, styles).where((F.col("total") > 0) & (F.col("eff_n") < threshold))
    m = exp.where(F.col(ret).isNotNull()).groupBy(dt).agg((div(F.sum(F.col(weight) * F.col(ret)), F.sum(weight))).alias("_mkt"))
    w = w.join(m, dt)
    r = F.col("_mkt")
    if sector_ret is not None:
        w = w.join(sector_ret.select(dt, "factor", F.col(ret).alias("_sec")), [dt, "factor"], "left")
        r = F.coalesce("_sec", "_mkt")
    n = F.col("eff_n")
    if form == "fourth_power":
        top = threshold**4
        wt = div(div((threshold - 1.0) * (F.pow(n, F.lit(4.0)) - top), 1.0 - top) * F.col("total"), n)
    else:
        wt = div((threshold - n) * F.col("total"), n)
    cols = [(F.col(c) if c in styles else F.when(F.col("factor") == c, 1.0).otherwise(0.0)).alias(c) for c in xs]
    return w.select(dt, "factor", "eff_n", *cols, r.alias(ret), wt.alias("_w"))


def screen_factors(exp: DataFrame, dt: str, xs: Sequence[str], styles: Sequence[str], zero: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Chosen exposures set to 0; per date and factor: ok, empty (no exposure) or constant (style without spread)."""
    x = exp.withColumns({c: F.lit(0.0) for c in zero}) if zero else exp
    aggs = []
    for c in xs:
        v = F.coalesce(F.col(c), F.lit(0.0))
        aggs += [F.sum(F.when(v != 0, 1).otherwise(0)).alias(f"n|{c}"), F.min(v).alias(f"a|{c}"), F.max(v).alias(f"b|{c}")]
    g = x.groupBy(dt).agg(*aggs)
    per = []
    for c in xs:
        st = F.when(F.col(f"n|{c}") == 0, "empty")
        if c in styles:
            st = st.when(F.col(f"a|{c}") == F.col(f"b|{c}"), "constant")
        per.append(F.struct(F.lit(c).alias("factor"), F.col(f"n|{c}").alias("n"), st.otherwise("ok").alias("status")))
    return x, g.select(dt, F.explode(F.array(*per)).alias("_r")).select(dt, "_r.*")


def mimicking_portfolios(exp: DataFrame, dt: str, key: str, xs: Sequence[str], weight: str) -> DataFrame:
    """Weights (X'WX)^-1 X'W per asset, one column per factor: their return is the factor's."""
    k = len(xs)
    inv = cross_products(exp, [dt], xs, None, weight).select(dt, inverse_sym("xtx").alias("_i"))
    j = exp.join(inv, dt)
    cols = []
    for i, f in enumerate(xs):
        c = sum((F.col("_i")[i * k + m] * F.col(x) for m, x in enumerate(xs)), F.lit(0.0))
        cols.append((F.col(weight) * c).alias(f"fmp_{f}"))
    return j.select(key, dt, *cols)


# --- principal components -----------------------------------------------------------------

_EIG = T.StructType([T.StructField("vectors", T.ArrayType(T.DoubleType())), T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("trace", T.DoubleType())])


def eigen(packed: DataFrame, k: int, n_rows: Column | None = None, jones: bool = False) -> DataFrame:
    """Top k vectors of each packed Gramian (names, values), in tasks, one row per matrix.

    With ``jones`` each date is deflated by its residual deviation, the decomposition is
    repeated and the vectors are brought back to the dates' scale.
    """

    @pandas_udf(_EIG)
    def run(values: pd.Series) -> pd.DataFrame:
        out = {"vectors": [], "values": [], "trace": []}
        for a in values:
            t = int(round(np.sqrt(len(a))))
            g = np.asarray(a, float).reshape(t, t)
            d, v = linalg.top_vectors(g, min(k, t))
            if jones:
                left = np.diag(g) - (v * v) @ d
                s = np.sqrt(np.maximum(left, 1e-12 * max(np.trace(g) / t, 1e-300)))
                s = s / s.mean()
                d, v = linalg.top_vectors(g / np.outer(s, s), min(k, t))
                v = v * s[:, None]
                v = v / np.linalg.norm(v, axis=0)
            out["vectors"].append(v.ravel()), out["values"].append(d), out["trace"].append(float(np.trace(g)))
        return pd.DataFrame(out)

    return packed.withColumn("_e", run("values")).select(*[c for c in packed.columns if c != "values"], "_e.vectors", F.col("_e.values").alias("eigenvalues"), "_e.trace")


def apca(returns: DataFrame, key: str, dt: str, ret: str, k: int, estu: str | None = None, scale: DataFrame | None = None, jones: bool = False, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Asymptotic principal components of a window of returns.

    Returns (factor returns: by, dt, f1..fk; exposures: by, key, f1..fk; stats: by, share
    explained). ``scale``: key and ``root`` by which a history is divided before the
    Gramian. Missing returns count as 0 there.
    """
    by = list(by)
    x = returns.where(F.col(estu)) if estu else returns
    if scale is not None:
        x = x.join(scale.select(key, "root"), key).withColumn(ret, div(F.col(ret), F.col("root")))
    packed = pack_matrix(gram(x, key, dt, ret, by), "i", "j", "value", by)
    e = eigen(packed, k, jones=jones)
    stats = e.select(*by, (div(F.aggregate("eigenvalues", F.lit(0.0), lambda a, b: a + b), F.col("trace"))).alias("explained"))
    m = F.size("eigenvalues")
    rows = e.select(*by, F.posexplode("names").alias("_i", "_d"), "vectors", m.alias("_m"))
    names = [f"f{i + 1}" for i in range(k)]
    f = rows.select(
        *by, F.col("_d").cast(returns.schema[dt].dataType).alias(dt),
        *[F.when(F.lit(i) < F.col("_m"), F.get("vectors", (F.col("_i") * F.col("_m") + i).cast("int"))).otherwise(0.0).alias(n) for i, n in enumerate(names)],
    )
    j = returns.join(f, [*by, dt])
    exp = j.groupBy(*by, key).agg(*[F.sum(F.coalesce(F.col(ret), F.lit(0.0)) * F.col(n)).alias(n) for n in names])
    return f, exp, stats


def subspace_components(returns: DataFrame, key: str, dt: str, ret: str, k: int, more: int = 10, tol: float = 1e-8, most: int = 30, seed: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leading components of a long window by randomised subspace iteration, without a date x date matrix.

    Returns (factor returns: dt, f1..fk; exposures: key, f1..fk; stats: explained, converged, n_passes), as
    ``apca`` does. A pass multiplies the returns with k + ``more`` directions: each task takes its assets' histories
    one after another and adds up one table of dates x directions, so what moves is that table per task and
    what reaches the driver is dates x directions numbers, whatever the assets. Passes end when the leading
    values move by less than ``tol`` of the largest one; after ``most`` the last are taken and ``converged`` says
    so. Missing returns count as 0; an asset's history is one row.
    """
    spark = returns.sparkSession
    names = [f"f{i + 1}" for i in range(k)]
    calendar = [r[0] for r in returns.select(dt).distinct().orderBy(dt).collect()]
    t = len(calendar)
    place = spark.createDataFrame([(d, i) for i, d in enumerate(calendar)], T.StructType([returns.schema[dt], T.StructField("_i", T.IntegerType())]))
    dated = returns.where(F.col(ret).isNotNull()).join(F.broadcast(place), dt).groupBy(key, "_i").agg(F.sum(ret).cast("double").alias("_r"))
    hist = stored(dated.groupBy(key).agg(F.collect_list("_i").alias("_at"), F.collect_list("_r").alias("_x")))
    width = min(k + more, t)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(t, width)))[0]
    trace = hist.select(F.sum(F.aggregate("_x", F.lit(0.0), lambda a, x: a + x * x)).alias("s")).first().s or 0.0
    before, converged, passes = np.zeros(width), False, 0
    while passes < most and t:
        passes += 1
        z = _gram_times(hist, q)
        values, turn = np.linalg.eigh(q.T @ z)
        values, turn = values[::-1], turn[:, ::-1]
        if np.abs(values[:k] - before[:k]).max(initial=0.0) <= tol * max(float(values[0]), 1e-300):
            converged = True
            q = q @ turn
            break
        before = values
        q = np.linalg.qr(z @ turn)[0]
    m = min(k, t)
    v = q[:, :m] * np.where(q[:, :m].sum(axis=0) < 0, -1.0, 1.0)
    v = np.column_stack([v, np.zeros((t, k - m))])
    f = spark.createDataFrame([(d, *map(float, row)) for d, row in zip(calendar, v)], T.StructType([returns.schema[dt], *[T.StructField(n, T.DoubleType()) for n in names]]))
    kt = returns.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast(v)

    def load(batches):
        for b in batches:
            rows = np.array([shared.value[i].T @ r for i, r in _histories(b.column(1), b.column(2))]).reshape(b.num_rows, k)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(rows[:, j]) for j in range(k)]], names=[key, *names])

    exp = hist.select(key, "_at", "_x").mapInArrow(load, f"`{key}` {kt}, " + ", ".join(f"{n} double" for n in names))
    share = float(values[:m].sum() / trace) if t and trace else 0.0
    return f, exp, spark.createDataFrame([(share, converged, passes)], "explained double, converged boolean, n_passes int")


def _histories(at: pa.ListArray, x: pa.ListArray):
    """Places and values of one asset after another, as views of the batch's own memory."""
    i, r = at.values.to_numpy(zero_copy_only=False), x.values.to_numpy(zero_copy_only=False)
    ends, xends = at.offsets.to_numpy(), x.offsets.to_numpy()
    for n in range(len(at)):
        yield i[ends[n] : ends[n + 1]], r[xends[n] : xends[n + 1]]


def _gram_times(hist: DataFrame, q: np.ndarray) -> np.ndarray:
    """R' (R q) for histories (_at, _x): one partial table of dates x directions a task, summed by date."""
    shared = hist.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        out, any_ = np.zeros(shared.value.shape), False
        for b in batches:
            for at, r in _histories(b.column(0), b.column(1)):
                rows = shared.value[at]
                out[at] += np.outer(r, r @ rows)
                any_ = True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out), dtype=np.int32)), pa.array(list(out))], names=["i", "z"])

    parts = hist.select("_at", "_x").mapInArrow(run, "i int, z array<double>")
    sums = parts.groupBy("i").agg(F.array(*[F.sum(F.col("z")[j]) for j in range(q.shape[1])]).alias("z")).collect()
    shared.unpersist()
    z = np.zeros(q.shape)
    for r in sums:
        z[r.i] = r.z
    return z


def component_residuals(returns: DataFrame, f: DataFrame, exp: DataFrame, key: str, dt: str, ret: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Return less the part explained by components."""
    names = [f"f{i + 1}" for i in range(k)]
    b = exp.withColumnsRenamed({n: f"_b_{n}" for n in names})
    j = returns.join(f, [*by, dt]).join(b, [*by, key])
    fit = sum((F.col(n) * F.col(f"_b_{n}") for n in names), F.lit(0.0))
    return j.withColumn("fitted", fit).withColumn("sret", F.col(ret) - F.col("fitted")).drop(*names, *[f"_b_{n}" for n in names])


def former_signs(now: DataFrame, before: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """One row with, for each component, -1 where its exposures disagree with the former ones and 1 otherwise."""
    b = before.select(key, *[F.col(n).alias(f"_o_{n}") for n in names])
    return now.join(b, key).agg(*[F.when(F.sum(F.col(n) * F.col(f"_o_{n}")) < 0, -1.0).otherwise(1.0).alias(f"_s_{n}") for n in names])


def align_signs(now: DataFrame, signs: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns times the signs of ``former_signs``."""
    j = now.withColumn("_one", F.lit(1)).join(signs.withColumn("_one", F.lit(1)), "_one")
    return j.withColumns({n: F.col(n) * F.col(f"_s_{n}") for n in names}).drop("_one", *[f"_s_{n}" for n in names])


def statistical_model(returns: DataFrame, key: str, dt: str, ret: str, k: int, currency: DataFrame | None = None, before: DataFrame | None = None) -> dict[str, DataFrame]:
    """Components, exposures aligned to the former day, specific returns and factor rows.

    A component that is turned to agree with ``before`` is turned in exposures and factor returns alike, so
    their products stay. ``currency``: factor rows (dt, factor, value) of the currency block, appended.
    """
    x = stored(returns.select(key, dt, ret))
    f, exp, stats = apca(x, key, dt, ret, k)
    names = [f"f{i + 1}" for i in range(k)]
    spec = component_residuals(x, f, exp, key, dt, ret, k)
    if before is not None:
        signs = cut(former_signs(exp, before, key, names))
        f, exp = align_signs(f, signs, names), align_signs(exp, signs, names)
    rows = f.unpivot([dt], names, "factor", "value")
    if currency is not None:
        rows = rows.unionByName(currency.select(dt, "factor", "value"))
    return {"factor_returns": rows, "exposures": exp, "specific": spec, "stats": stats}


def currency_model(fx: DataFrame, ccy: str, dt: str, ret: str, k: int, pegged: Sequence = (), n_dev: float = 8.0) -> dict[str, DataFrame]:
    """Statistical currency model: currencies across, dates summed.

    Returns are clipped, the currency x currency matrix is decomposed, factor returns are
    regressions of each date on the loadings, pegged currencies get no exposure.
    """
    x = stored(clip_outliers(fx.select(ccy, dt, ret).where(F.col(ret).isNotNull()), [dt], ret, n_dev, zero_tolerance=0.0))
    live = x.where(~F.col(ccy).isin(*pegged)) if pegged else x
    e = eigen(pack_matrix(gram(live, dt, ccy, ret), "i", "j", "value"), k)
    names = [f"f{i + 1}" for i in range(k)]
    load = e.select(F.posexplode("names").alias("_i", "_c"), "vectors").select(
        F.col("_c").cast(fx.schema[ccy].dataType).alias(ccy), *[F.col("vectors")[(F.col("_i") * k + i).cast("int")].alias(n) for i, n in enumerate(names)]
    )
    j = live.join(load, ccy)
    f = wls(j, [dt], names, ret)
    spec = residuals(j, f, [dt], names, ret, False, "sret").select(ccy, dt, "sret")
    risk = spec.groupBy(ccy).agg(F.var_samp("sret").alias("spec_var"))
    out = fx.select(ccy).distinct().join(load, ccy, "left").withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})
    rows = f.select(dt, *[F.col("coef")[i].alias(n) for i, n in enumerate(names)]).unpivot([dt], names, "factor", "value")
    return {"exposures": out, "factor_returns": rows, "specific": spec, "spec_risk": risk}


def fill_by_components(panel: DataFrame, key: str, step: str, ret: str, proxy: str, n_assets: int, k: int | None = None, least: int = 21, n_dev: float = 3.0, lo: float = -0.75, hi: float = 1.5) -> DataFrame:
    """Missing returns from a component model of the filled panel.

    Start from proxies (filled and smoothed), clip per date, fit min(20, n/5) components,
    clip the fitted values and fill and smooth again. ``panel`` is dense; windows under
    ``least`` dates keep the first fill.
    """
    start = stored(ts.fill_smooth(panel, key, ret, proxy, step))
    if start.select(step).distinct().count() < least:
        return start
    k = k or max(1, min(20, n_assets // 5))
    x = start.select(key, step, F.coalesce("filled", F.lit(0.0)).alias("_r"))
    x = stored(clip_outliers(x, [step], "_r", n_dev, zero_tolerance=0.0))
    f, exp, _ = apca(x, key, step, "_r", k)
    fit = component_residuals(x, f, exp, key, step, "_r", k).select(key, step, F.greatest(F.lit(lo), F.least(F.lit(hi), "fitted")).alias("_p"))
    j = start.drop("filled").join(fit, [key, step], "left").withColumn(proxy, F.coalesce("_p", proxy)).drop("_p")
    return ts.fill_smooth(j, key, ret, proxy, step)


def residual_block(df: DataFrame, by: Sequence[str], ys: Sequence[str], xs: Sequence[str]) -> DataFrame:
    """A block of series less its fit on an earlier block, column by column."""
    out = df
    for y in ys:
        fit = wls(df, by, xs, y, None, True)
        out = residuals(out, fit, by, xs, y, True, f"_res_{y}").withColumn(y, F.col(f"_res_{y}")).drop(f"_res_{y}")
    return out


def project(cov: DataFrame, source: Sequence[str], target: Sequence[str]) -> dict[str, DataFrame]:
    """Betas of target factors on source factors, cov(target, source) pinv(cov(source)), and the residual covariance."""
    packed = pack_matrix(cov, "f1", "f2", "value")
    src, tgt = list(source), list(target)
    typ = T.StructType([T.StructField("b", T.ArrayType(T.DoubleType())), T.StructField("r", T.ArrayType(T.DoubleType()))])

    @pandas_udf(typ)
    def run(names: pd.Series, values: pd.Series) -> pd.DataFrame:
        bs, rs = [], []
        for nm, v in zip(names, values):
            at = {n: i for i, n in enumerate(nm)}
            m = np.asarray(v, float).reshape(len(nm), len(nm))
            s, t = [at[n] for n in src], [at[n] for n in tgt]
            b = m[np.ix_(t, s)] @ np.linalg.pinv(m[np.ix_(s, s)], hermitian=True)
            bs.append(b.ravel()), rs.append((m[np.ix_(t, t)] - b @ m[np.ix_(s, t)]).ravel())
        return pd.DataFrame({"b": bs, "r": rs})

    e = packed.select(run("names", "values").alias("_o")).withColumn("tn", F.array(*[F.lit(x) for x in tgt])).withColumn("sn", F.array(*[F.lit(x) for x in src]))
    ns = len(src)
    b = e.select(F.posexplode("_o.b").alias("_i", "beta"), "tn", "sn").select(
        F.element_at("tn", (F.floor(div(F.col("_i"), ns)) + 1).cast("int")).alias("factor"), F.element_at("sn", (F.col("_i") % ns + 1).cast("int")).alias("macro"), "beta"
    )
    r = unpack_matrix(e.select(F.col("tn").alias("names"), F.col("_o.r").alias("values")), "names", "values")
    return {"betas": b, "residual_cov": r}


def link_returns(models: dict[str, DataFrame], dt: str = "dt") -> DataFrame:
    """Factor rows of several models under one table; names that clash carry their model."""
    u = None
    for m, df in models.items():
        x = df.select(dt, "factor", "value").withColumn("model", F.lit(m))
        u = x if u is None else u.unionByName(x)
    n = u.groupBy("factor").agg(F.count_distinct("model").alias("_n"))
    return u.join(n, "factor").withColumn("factor", F.when(F.col("_n") > 1, F.concat_ws("-", "model", "factor")).otherwise(F.col("factor"))).drop("_n")


def regression_stats(exp: DataFrame, dt: str, xs: Sequence[str], ret: str, weight: str) -> DataFrame:
    """t, p and R2 per date and factor."""
    from riskloom.operators.regressions import reg_stats

    return reg_stats(exp, [dt], xs, ret, weight, intercept=False)
