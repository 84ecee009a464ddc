"""Report tables: each function returns the rows of one extract, :func:`save` writes them.

Column names and order of a receiver are data (a layout), not code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from riskloom.operators.bitemporal import as_of_item, valid_on
from riskloom.operators.joins import anti_by_change
from riskloom.functions.columns import div


def save(df: DataFrame, path: str, sep: str = "|", partition_by: Sequence[str] = ()) -> None:
    """Write an extract as delimited text."""
    w = df.write.mode("overwrite").option("header", True).option("sep", sep)
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)


def exposure_triplets(wide: DataFrame, keys: Sequence[str], factors: Sequence[str]) -> DataFrame:
    """One row per asset and factor, missing exposures left out."""
    return wide.unpivot(list(keys), list(factors), "factor", "value").where("value is not null")


def exposure_wide(long: DataFrame, keys: Sequence[str], factors: Sequence[str]) -> DataFrame:
    """One row per asset. The factor list is given, so no extra pass looks for it."""
    return long.groupBy(*keys).pivot("factor", list(factors)).agg(F.first("value"))


def exposure_compact(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Binary factor types as one column: the factor with the largest value per asset."""
    return long.groupBy(*keys, "factor_type").agg(F.max_by("factor", F.struct("value", "factor")).alias("factor"))


def square(cov: DataFrame, factors: Sequence[str]) -> DataFrame:
    """Covariance rows (f1, f2, value) as a square table."""
    return cov.groupBy("f1").pivot("f2", list(factors)).agg(F.first("value"))


def correlation(cov: DataFrame) -> DataFrame:
    """Correlation per pair, with the first factor's annual variance and risk."""
    d = cov.where("f1 = f2").select(F.col("f1").alias("f"), F.col("value").alias("v"))
    j = cov.join(d.withColumnsRenamed({"f": "f1", "v": "variance"}), "f1").join(d.withColumnsRenamed({"f": "f2", "v": "_v2"}), "f2")
    return j.select(
        "f1", "f2", (div(F.col("value"), F.sqrt(F.col("variance") * F.col("_v2")))).alias("corr"), "variance", F.sqrt("variance").alias("risk")
    )


def identifier_map(assets: DataFrame, histories: Mapping[str, DataFrame], key: str, on_date) -> DataFrame:
    """Identifiers in force on a date, one column per history (key, value, from_dt, thru_dt)."""
    d = F.lit(on_date).cast("date")
    out = assets
    for name, h in histories.items():
        live = h.where((F.col("from_dt") <= d) & (d < F.col("thru_dt"))).select(key, F.col("value").alias(name))
        out = out.join(live, key, "left")
    return out


def identifier_updates(prev: DataFrame, curr: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Rows of ``curr`` whose identifiers are new or differ from ``prev``."""
    return anti_by_change(prev, curr, [key], cols)


def currency_rates(fx: DataFrame, rf: DataFrame, ccy: str = "ccy", dt: str = "dt") -> DataFrame:
    """Rate against the numeraire, risk-free rate and its cumulative."""
    return fx.join(rf, [ccy, dt], "left")


def factor_history(fret: DataFrame, factors: Sequence[str]) -> DataFrame:
    """Factor returns, dates down and factors across."""
    return fret.groupBy("dt").pivot("factor", list(factors)).agg(F.first("value"))


def hierarchy(nodes: DataFrame, depth: int, child: str = "child", parent: str = "parent") -> DataFrame:
    """Leaf to parent chain of a tree of fixed depth."""
    parents = nodes.select(F.col(parent).alias("_p")).where("_p is not null").distinct()
    out = nodes.join(parents, F.col(child) == F.col("_p"), "left_anti").select(F.col(child).alias("leaf"), F.col(parent).alias("level_1"))
    for i in range(2, depth + 1):
        up = nodes.select(F.col(child).alias(f"level_{i-1}"), F.col(parent).alias(f"level_{i}"))
        out = out.join(up, f"level_{i-1}", "left")
    return out.select("leaf", *[f"level_{i}" for i in range(1, depth + 1)])


def asset_attributes(panel: DataFrame, adv_steps: int = 20, key: str = "asset_id", dt: str = "dt") -> DataFrame:
    """Price, cap, average volume, one-step return and whether the price was rolled over."""
    w = W.partitionBy(key).orderBy(dt)
    return panel.select(
        key, dt, "price", "mcap",
        F.avg("volume").over(w.rowsBetween(1 - adv_steps, 0)).alias("adv"),
        (div(F.col("price"), F.lag("price").over(w)) - 1).alias("ret"),
        F.coalesce(F.col("price") == F.lag("price").over(w), F.lit(False)).alias("rolled"),
    )


def upper_triangle(pairs: DataFrame, a: str = "id1", b: str = "id2") -> DataFrame:
    """Stored covariances with the smaller id first."""
    return pairs.where(F.col(a) < F.col(b))


def complete_composites(members: DataFrame, mapped: DataFrame, composite: str, key: str) -> DataFrame:
    """Constituents of composites in which every member is mapped."""
    open_ = members.join(mapped.select(key).distinct(), key, "left_anti").select(composite).distinct()
    return members.join(open_, composite, "left_anti")


def benchmark(weights: DataFrame, corrections: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Weights with corrections (action replace, add or remove, and a weight)."""
    c = corrections.select(*keys, "action", F.col("weight").alias("_w"))
    j = weights.select(*keys, "weight").join(c, list(keys), "full_outer")
    return j.where("coalesce(action, '') <> 'remove'").select(*keys, F.coalesce("_w", "weight").alias("weight"))


def trading_calendar(markets: DataFrame, traded: DataFrame, key: str, start, end) -> DataFrame:
    """Every day of a range per market with a flag whether it traded."""
    days = markets.withColumn("dt", F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))))
    return days.join(traded.select(key, "dt", F.lit(True).alias("_t")).distinct(), [key, "dt"], "left").select(
        key, "dt", F.col("_t").isNotNull().alias("trading")
    )


def period_returns(cum: DataFrame, dates: DataFrame, key: str = "asset_id", value: str = "cum", name: str = "ret") -> DataFrame:
    """Return between consecutive chosen dates: ratio of cumulative values less 1."""
    d = cum.join(dates.select("dt").distinct(), "dt", "left_semi")
    w = W.partitionBy(key).orderBy("dt")
    return d.select(key, "dt", (div(F.col(value), F.lag(value).over(w)) - 1).alias(name)).where(F.col(name).isNotNull())


def with_layout(df: DataFrame, layout: Sequence[tuple[str, str]]) -> DataFrame:
    """Rename and order columns by a layout of (column, heading) pairs."""
    return df.select(*[F.col(c).alias(h) for c, h in layout])


# Headings of the four receivers whose files carry the same data.
LAYOUTS: dict[str, list[tuple[str, str]]] = {
    "index_provider": [("asset_id", "Constituent"), ("country", "Country"), ("mcap", "Mcap"), ("price", "Close")],
    "exchange": [("asset_id", "ID"), ("price", "PX"), ("volume", "VOL"), ("mcap", "MKTCAP")],
    "country_classification": [("asset_id", "SecurityID"), ("country", "CountryCode"), ("region", "RegionCode")],
    "research_platform": [("dt", "DATE"), ("asset_id", "SYMBOL"), ("ret", "TOTAL_RETURN"), ("mcap", "MARKET_VALUE")],
}


def factor_library(exposures: DataFrame, columns: Mapping[str, str], percent: Sequence[str] = ()) -> DataFrame:
    """Chosen exposures under library names, as text; listed ones in percent."""
    cols = []
    for c, name in columns.items():
        v = F.col(c) * 100 if c in percent else F.col(c)
        cols.append(F.format_number(v, 4).alias(name))
    return exposures.select("asset_id", "dt", *cols)


def fundamental_extract(items: DataFrame, codes: Sequence[str], as_of) -> DataFrame:
    """Latest known value per item, one row per asset."""
    known = as_of_item(items, ["asset_id", "item"], as_of)
    return known.groupBy("asset_id").pivot("item", list(codes)).agg(F.first("value"))


def table_extract(df: DataFrame, on_date, market: str, value, dt: str = "dt") -> DataFrame:
    """Raw rows of a table for one date and market."""
    return df.where((F.col(dt) == F.lit(on_date).cast("date")) & (F.col(market) == value))


def rekey(file: DataFrame, id_map: DataFrame, vendor: str, model: str, dt: str = "dt") -> DataFrame:
    """Vendor ids replaced by the model ids valid on each row's date."""
    return valid_on(file, id_map.select(vendor, model, "from_dt", "thru_dt"), [vendor], dt).drop(vendor, "from_dt", "thru_dt")


def curve_history(curve: DataFrame, nodes: Sequence[str]) -> DataFrame:
    """Node values per curve and date, one column per node."""
    return curve.where(F.col("node").isin(*nodes)).groupBy("curve", "dt").pivot("node", list(nodes)).agg(F.first("value"))
