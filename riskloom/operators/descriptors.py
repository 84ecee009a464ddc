"""The catalogue of return descriptors, made by rule: a family, its windows, and what it is measured against.

Each family is one expression over a trailing window of an asset's steps. All descriptors of a panel are columns
of one plan that share the asset's partitioning and one sort; equal windows share their frames. A window
holds one asset's steps, never a cross-section. Spark's windows go over all steps of a frame for every row, so a
catalogue of many long windows is worked out in Arrow batches of whole assets instead (``rolling.py``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from riskloom.operators import fundamentals as fu, rolling


@dataclass(frozen=True)
class Descriptor:
    """``window`` steps up to now, less the last ``gap``; ``against`` is a factor's column, ``net`` clears it of the market."""

    name: str
    family: str
    window: int
    gap: int = 0
    against: str = ""
    net: str = ""

    @property
    def is_local(self) -> bool:
        """Whether the value depends on the currency or market it is measured in."""
        return self.family in LOCAL


# Windows in steps (months here) of each family, gaps of momentum, markets and families in local terms.
WINDOWS = {
    "momentum": [1, 3, 6, 9, 12, 24], "hist_vol": [6, 12, 24, 36], "mean_return": [12, 24], "skewness": [12, 24], "high_low": [3, 6, 12, 24], "turnover": [1, 3, 6, 12], "dollar_volume": [1, 3, 6, 12],
    "amihud": [3, 6, 12], "traded": [1, 3, 6, 12, 24], "nonzero": [1, 3, 6, 12, 24], "beta": [12, 24, 36], "alpha": [12, 24], "residual_vol": [12, 24], "correlation": [12, 24], "sensitivity": [24, 36],
}
GAPS = {3: 1, 6: 1, 9: 1, 12: 1, 24: 2}
AGAINST_MARKET = ["beta", "alpha", "residual_vol", "correlation"]
LOCAL = {"momentum", "hist_vol", "mean_return", "skewness", "high_low", "amihud", "beta", "alpha", "residual_vol", "correlation", "sensitivity"}


def catalogue(markets: Sequence[str], series: Sequence[str], market: str) -> list[Descriptor]:
    """All descriptors for some markets (columns of market returns) and macro series, the latter as they are and
    net of ``market``."""
    out = []
    for family, windows in WINDOWS.items():
        for n in windows:
            if family in AGAINST_MARKET:
                out += [Descriptor(f"{family}_{m}_{n}", family, n, against=m) for m in markets]
            elif family == "sensitivity":
                out += [Descriptor(f"{family}_{s}_{n}", family, n, against=s) for s in series]
                out += [Descriptor(f"{family}_{s}_net_{n}", family, n, against=s, net=market) for s in series if s != market]
            else:
                out.append(Descriptor(f"{family}_{n}", family, n))
                if family == "momentum" and n in GAPS:
                    out.append(Descriptor(f"{family}_{n}x{GAPS[n]}", family, n, GAPS[n]))
    return out


def fundamental_catalogue() -> list[tuple[str, str, str]]:
    """(name, group, frequency) of the ratio tables' descriptors, each in quarterly and in annual form."""
    groups = {"price": fu.PRICE_RATIOS, "profit": fu.PROFIT_RATIOS, "balance": fu.BALANCE_RATIOS, "item": fu.ITEMS}
    return [(f"{name}_{f}", group, f) for group, table in groups.items() for name in table for f in ("quarterly", "annual")]


def least(n: int) -> int:
    """Values that a window of ``n`` steps needs: half of them, and three for a fit."""
    return max(3, -(-n // 2))


def _fit_parts(d: Descriptor, w: W) -> dict[str, Column]:
    """What a fit on one factor is made of, over the steps that have return and factor. A window's cost is its
    functions times its steps, so all fits of one factor and window share these."""
    whole = F.col("ret").isNotNull() & F.col(d.against).isNotNull()
    y, x = F.when(whole, F.col("ret")), F.when(whole, F.col(d.against))
    sums = {"n": F.count(y), "xx": F.var_pop(x), "yy": F.var_pop(y), "yx": F.covar_pop(y, x), "x": F.avg(x), "y": F.avg(y)}
    return {_fit(d, k): sums[k].over(w) for k in FIT_PARTS[d.family]}


def _fit(d: Descriptor, part: str) -> str:
    return f"_fit_{d.against}_{d.window}_{part}"


def _fitted(d: Descriptor) -> Column:
    """Slope, intercept, correlation or residual deviation from the columns of ``_fit_parts``."""
    n, xx, yy, yx, x, y = (F.col(_fit(d, k)) for k in ("n", "xx", "yy", "yx", "x", "y"))
    slope = F.when(xx != 0, yx / xx)
    value = {
        "beta": lambda: slope,
        "sensitivity": lambda: slope,
        "alpha": lambda: y - slope * x,
        "correlation": lambda: F.when(xx != 0, F.when(yy == 0, 1.0).otherwise(F.sqrt(yx / xx * (yx / F.nullif(yy, F.lit(0.0)))))),
        "residual_vol": lambda: F.sqrt(F.greatest(n * yy - F.when(xx != 0, n * yx * yx / xx), F.lit(0.0)) / F.when(n > 2, n - 2)),
    }[d.family]()
    return F.when(n >= least(d.window), value)


def _net_parts(d: Descriptor, w: W) -> dict[str, Column]:
    """What the slope beside the market is made of, over the steps that have return, series and market."""
    whole = F.col("ret").isNotNull() & F.col(d.against).isNotNull() & F.col(d.net).isNotNull()
    y, x, m = (F.when(whole, F.col(c)) for c in ("ret", d.against, d.net))
    sums = {"n": F.count(y), "xx": F.var_pop(x), "mm": F.var_pop(m), "xm": F.covar_pop(x, m), "yx": F.covar_pop(y, x), "ym": F.covar_pop(y, m)}
    return {f"_{d.name}_{k}": c.over(w) for k, c in sums.items()}


def _net(d: Descriptor) -> Column:
    """Slope on a series beside the market and an intercept, from the columns of ``_net_parts``."""
    n, xx, mm, xm, yx, ym = (F.col(f"_{d.name}_{k}") for k in ("n", "xx", "mm", "xm", "yx", "ym"))
    det = xx * mm - xm * xm
    return F.when((n >= least(d.window) + 1) & (det > xx * mm * 1e-6), (yx * mm - ym * xm) / det)


def _ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0).cast("double"))


FORMS: dict[str, Callable[[Descriptor, W], Column]] = {
    "momentum": lambda d, w: F.when(F.count("ret").over(w) > 0, F.exp(F.sum(F.log1p(F.greatest(F.coalesce("ret", F.lit(0.0)), F.lit(-0.999)))).over(w)) - 1),
    "hist_vol": lambda d, w: F.sqrt(F.sum(F.coalesce(F.col("ret") * F.col("ret"), F.lit(0.0))).over(w) / d.window),
    "mean_return": lambda d, w: F.when(F.count("ret").over(w) >= least(d.window), F.avg("ret").over(w)),
    "skewness": lambda d, w: F.when(
        (F.count("ret").over(w) >= least(d.window)) & (F.var_pop("ret").over(w) > 1e-12),
        (F.avg(F.col("ret") ** 3).over(w) - 3 * F.avg("ret").over(w) * F.avg(F.col("ret") ** 2).over(w) + 2 * F.avg("ret").over(w) ** 3) / F.nullif(F.var_pop("ret").over(w) ** 1.5, F.lit(0.0)),
    ),
    "high_low": lambda d, w: F.log(_ratio(F.max("mcap").over(w), F.min("mcap").over(w))),
    "turnover": lambda d, w: F.log(F.nullif(_ratio(F.avg(F.col("volume").cast("double")).over(w), F.avg("mcap").over(w)), F.lit(0.0))),
    "dollar_volume": lambda d, w: F.avg(F.col("volume").cast("double") * F.col("price")).over(w),
    "amihud": lambda d, w: F.avg(_ratio(F.abs("ret"), F.col("volume").cast("double") * F.col("price"))).over(w),
    "traded": lambda d, w: F.count("ret").over(w) / float(d.window),
    "nonzero": lambda d, w: F.sum(F.when(F.col("ret") != 0, 1).otherwise(0)).over(w) / float(d.window),
} | {f: lambda d, w: _fitted(d) for f in ("beta", "alpha", "correlation", "residual_vol", "sensitivity")}
#: Sums that each family of fits on one factor needs.
FIT_PARTS = {"beta": ["n", "xx", "yx"], "sensitivity": ["n", "xx", "yx"], "alpha": ["n", "xx", "yx", "x", "y"], "correlation": ["n", "xx", "yx", "yy"], "residual_vol": ["n", "xx", "yx", "yy"]}


#: Steps of all functions' frames for a row, from which on batches are cheaper than Spark's windows.
MANY_STEPS = 500


def build(panel: DataFrame, wanted: Sequence[Descriptor], key: str = "asset_id", step: str = "mi", many: int = MANY_STEPS) -> DataFrame:
    """``panel`` (key, step, ret, mcap, volume, price and the factors' columns) with a column for each descriptor.

    A window is by the step's number, so months without a row shorten what it holds and not where it begins. What
    has too few values, no spread or a zero divisor is null.
    """
    def over(d: Descriptor) -> W:
        return W.partitionBy(key).orderBy(step).rangeBetween(1 - d.window, -d.gap)

    fits = {_fit(d, k): d.window for d in wanted if d.against and not d.net for k in FIT_PARTS[d.family]}
    if sum(fits.values()) + sum(6 * d.window if d.net else d.window for d in wanted if d.net or not d.against) >= many and isinstance(panel.schema[step].dataType, T.IntegralType):
        return rolling.build(panel, wanted, key, step, least)
    parts = {k: c for d in wanted if d.net for k, c in _net_parts(d, over(d)).items()}
    parts |= {k: c for d in wanted if d.against and not d.net for k, c in _fit_parts(d, over(d)).items()}
    plain = panel.select("*", *[FORMS[d.family](d, over(d)).alias(d.name) for d in wanted if not d.against], *[c.alias(k) for k, c in parts.items()])
    return plain.select(*panel.columns, *[(_net(d) if d.net else FORMS[d.family](d, over(d)) if d.against else F.col(d.name)).alias(d.name) for d in wanted])


def table(spark: SparkSession, wanted: Sequence[Descriptor]) -> DataFrame:
    """The catalogue as rows, fundamentals included."""
    rows = [(d.name, d.family, d.window, d.gap, d.against or None, d.net or None, d.is_local) for d in wanted]
    rows += [(name, group, 4 if f == "annual" else 1, 0, None, None, False) for name, group, f in fundamental_catalogue()]
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], "id int, name string, family string, window int, gap int, against string, net string, is_local boolean")


def factor_columns(panel: DataFrame, by_key: dict[str, tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """``panel`` with factor columns: name -> (table, join keys, value); tables have a row a key and step, or a step."""
    out = panel
    for name, (df, keys, value) in by_key.items():
        out = out.join(df.select(*keys, F.col(value).alias(name)), list(keys), "left")
    return out
