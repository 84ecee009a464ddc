"""Macro factors: what was released when, state-space factors of it, and their daily expansion."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskloom.functions import statespace


def vintages(releases: DataFrame, keys: Sequence[str], value: str, released: str, as_of: Sequence[date]) -> DataFrame:
    """What was known on each of some days: keys, as_of, value.

    ``releases`` has a row for every publication of a value, revisions included; on a day the last one
    published by then counts (of several of one day the largest). Values published later do not appear, so
    the end of a vintage is ragged. A release meets only the days on which it counts as known; each
    (keys, day) is one aggregation.
    """
    days = F.array(*[F.lit(d) for d in as_of])
    known = releases.where(F.col(value).isNotNull()).withColumn("as_of", F.explode(F.filter(days, lambda d: d >= F.col(released))))
    return known.groupBy(*keys, "as_of").agg(F.max_by(value, F.struct(released, value)).alias(value))


def state_space_factors(series: DataFrame, by: Sequence[str], name: str, step: str, value: str, k: int, tol: float = 1e-5, most: int = 200) -> dict[str, DataFrame]:
    """Factors with first-order dynamics and autoregressive noise of each series (``statespace.dynamic_factors``).

    A key of ``by`` is one small table (months by up to about a hundred series); steps are the integers from its
    first to its last, also those without any value. Null values are not released and enter nowhere. Gives
    ``factors`` (by, step, f1..fk, converged, n_passes) and ``loadings`` (by, name, f1..fk, rho, sigma2). Both run
    the fit; store them if both are needed often.
    """
    names = [f"f{i + 1}" for i in range(k)]
    by = list(by)
    keys = ", ".join(f"`{c}` {series.schema[c].dataType.simpleString()}" for c in by)
    columns = ", ".join(f"`{n}` double" for n in names)

    def table(pdf: pd.DataFrame) -> tuple[pd.DataFrame, statespace.FactorFit]:
        m = pdf.pivot_table(index=step, columns=name, values=value, aggfunc="last", dropna=False)
        m = m.reindex(range(int(pdf[step].min()), int(pdf[step].max()) + 1))
        return m, statespace.dynamic_factors(m.to_numpy(float), k, tol, most)

    def wide(a: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(np.column_stack([a, np.zeros((len(a), k - a.shape[1]))]), columns=names)

    def factors(pdf: pd.DataFrame) -> pd.DataFrame:
        m, fit = table(pdf)
        out = wide(fit.factors).assign(**{step: m.index.to_numpy(), "converged": fit.converged, "n_passes": len(fit.loglik)})
        return out.assign(**{c: pdf[c].iloc[0] for c in by})[[*by, step, *names, "converged", "n_passes"]]

    def loadings(pdf: pd.DataFrame) -> pd.DataFrame:
        m, fit = table(pdf)
        out = wide(fit.loadings).assign(**{name: m.columns.to_numpy(), "rho": fit.rho, "sigma2": fit.sigma2})
        return out.assign(**{c: pdf[c].iloc[0] for c in by})[[*by, name, *names, "rho", "sigma2"]]

    rows = series.select(*by, name, step, F.col(value).cast("double").alias(value)).groupBy(*by)
    types = {c: series.schema[c].dataType.simpleString() for c in (name, step)}
    return {
        "factors": rows.applyInPandas(factors, f"{keys}, `{step}` {types[step]}, {columns}, converged boolean, n_passes int"),
        "loadings": rows.applyInPandas(loadings, f"{keys}, `{name}` {types[name]}, {columns}, rho double, sigma2 double"),
    }


def daily_expansion(monthly: DataFrame, daily: DataFrame, by: Sequence[str], step: str, day: str, value: str, indicators: Sequence[str], rho: float | None = None) -> DataFrame:
    """(by, day, value, rho): monthly values made daily so that the days of a month add up to it.

    ``daily`` has a row for each (by, day) with its ``step`` and indicators; a missing indicator counts as its mean.
    A key is one series of some thousand days. Months without a value are expanded from indicators and
    neighbours; a value without days is left out.
    """
    by = list(by)
    joined = daily.select(*by, step, day, *indicators).join(monthly.select(*by, step, F.col(value).alias("_total")), [*by, step], "left")
    schema = ", ".join(f"`{c}` {daily.schema[c].dataType.simpleString()}" for c in [*by, day]) + f", `{value}` double, rho double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([step, day])
        x = pdf[list(indicators)].to_numpy(float)
        mean = np.array([c[np.isfinite(c)].mean() if np.isfinite(c).any() else 0.0 for c in x.T])
        x = np.column_stack([np.ones(len(x)), np.where(np.isfinite(x), x, mean)])
        _, start, counts = np.unique(pdf[step].to_numpy(), return_index=True, return_counts=True)
        total = pdf["_total"].to_numpy(float)[start]
        if np.isfinite(total).any():
            out, _, r = statespace.spread(total, counts, x, rho)
        else:
            out, r = np.full(len(pdf), np.nan), np.nan
        return pdf[[*by, day]].assign(**{value: out, "rho": r})

    out = joined.groupBy(*by).applyInPandas(run, schema)
    return out.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in (value, "rho")})
