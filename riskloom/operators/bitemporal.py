"""Reads and writes of revisioned tables, validity intervals and table differences.

The newest revision of a key is found with ``max_by`` on a struct, a map-side aggregate:
no window sorts a key's revisions, so a key with very many of them costs one small buffer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T
from riskloom.functions.columns import div
from riskloom.session import spread
from riskloom.sources.manifest import CommittedTable

OPEN_END = "9999-12-31"


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key, ties broken by row content."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ties = [c for c in sorted(rest) if c not in order]
    pick = F.max_by(F.struct(*rest), F.struct(*order, *ties)).alias("_r")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def active(df: DataFrame, keys: Sequence[str], rev_col: str = "rev_dt", del_col: str = "rev_del_flag", then: Sequence[str] = ()) -> DataFrame:
    """Latest revision per key; a deleted latest revision hides the key."""
    return newest(df, keys, [rev_col, *then]).where(F.col(del_col) == "N")


def as_of_item(df: DataFrame, keys: Sequence[str], as_of, eff_col: str = "eff_dt", del_col: str | None = None) -> DataFrame:
    """Value per key as known on ``as_of`` (a date literal or column)."""
    known = df.where(F.col(eff_col) <= (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")))
    out = newest(known, keys, [eff_col])
    return out.where(F.col(del_col) == "N") if del_col else out


def active_classification(const: DataFrame, ref: DataFrame, keys: Sequence[str], ref_key: str) -> DataFrame:
    """Active classification rows, newest taken inside one revision of the scheme."""
    return active(const.join(ref, ref_key), [*keys, ref_key])


def to_intervals(df: DataFrame, keys: Sequence[str], change_dt: str = "change_dt", del_col: str | None = None) -> DataFrame:
    """Change records to half-open [from_dt, thru_dt); a deletion closes and yields none.

    Records are one per key and day, so a window holds at most the calendar.
    """
    w = W.partitionBy(*keys).orderBy(change_dt)
    out = df.withColumn("from_dt", F.col(change_dt)).withColumn(
        "thru_dt", F.coalesce(F.lead(change_dt).over(w), F.lit(OPEN_END).cast("date"))
    )
    if del_col:
        out = out.where(F.col(del_col) == "N").drop(del_col)
    return out.drop(change_dt) if change_dt != "from_dt" else out


def _years(frm: Column, thru: Column, first: Column, last: Column) -> Column:
    """Years an interval covers, limited to the years that can be asked for."""
    lo = F.greatest(F.year(frm), first)
    hi = F.least(F.year(F.date_sub(thru, 1)), last)
    return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def valid_on(
    dates: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    dt: str = "dt",
    how: str = "inner",
    from_col: str = "from_dt",
    thru_col: str = "thru_dt",
    first_year: int | None = None,
    last_year: int | None = None,
) -> DataFrame:
    """Attribute in force: ``from <= dt < thru``.

    Joined on the keys and the calendar year, so the work of one hot key is split by year
    and no inequality-only join is planned. An interval is repeated only for years in which
    a date asks for it: the given years, or those of the dates (one row, aggregated first).
    """
    keys = list(keys)
    if first_year is None or last_year is None:
        span = dates.agg(F.min(F.year(dt)).alias("_y0"), F.max(F.year(dt)).alias("_y1")).withColumn("_one", F.lit(1))
        bounded = intervals.withColumn("_one", F.lit(1)).join(span, "_one").drop("_one")
        lo, hi = F.col("_y0"), F.col("_y1")
    else:
        bounded, lo, hi = intervals, F.lit(first_year), F.lit(last_year)
    iv = bounded.withColumn("_y", F.explode(_years(F.col(from_col), F.col(thru_col), lo, hi))).drop("_y0", "_y1").withColumnsRenamed({from_col: "_from", thru_col: "_thru", **{k: f"_k_{k}" for k in keys}})
    d = dates.withColumn("_yd", F.year(dt))
    on = (F.col("_yd") == F.col("_y")) & (F.col("_from") <= F.col(dt)) & (F.col(dt) < F.col("_thru"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    out = d.join(iv, on, how).drop("_y", "_yd", *[f"_k_{k}" for k in keys])
    return out.withColumnsRenamed({"_from": from_col, "_thru": thru_col})


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Intersection of two interval tables on ``keys``: greatest from, least thru."""
    b = b.withColumnsRenamed({"from_dt": "_from", "thru_dt": "_thru"})
    out = a.join(b, list(keys))
    out = out.withColumn("from_dt", F.greatest("from_dt", "_from")).withColumn("thru_dt", F.least("thru_dt", "_thru"))
    return out.where("from_dt < thru_dt").drop("_from", "_thru")


def id_history(issue_map: DataFrame, sub_issue: DataFrame, key: str) -> DataFrame:
    """Ids per model id with their date ranges."""
    return overlap_join(issue_map, sub_issue, [key])


def find_updates(df: DataFrame, validity: DataFrame, key: str, dt: str, rev_dt: str, on_date) -> DataFrame:
    """Rows touched on a date: new revisions, full history of starting ids, future rows of ending ids."""
    d = F.lit(on_date).cast("date")
    start = validity.where(F.col("from_dt") == d).select(key).distinct()
    end = validity.where(F.col("thru_dt") == d).select(key).distinct()
    parts = [
        df.where(F.col(rev_dt) == d),
        df.join(start, key, "left_semi"),
        df.where(F.col(dt) >= d).join(end, key, "left_semi"),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.dropDuplicates()


def table_diff(src: DataFrame, tgt: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Actions that bring ``tgt`` to ``src``: insert, update or terminate."""
    keys = list(keys)
    s = src.select(*keys, F.col(value).alias("new_value"), F.lit(True).alias("_s"))
    t = tgt.select(*keys, F.col(value).alias("old_value"), F.lit(True).alias("_t"))
    j = s.join(t, keys, "full_outer")
    action = (
        F.when(F.col("_t").isNull(), "insert")
        .when(F.col("_s").isNull(), "terminate")
        .when(~F.col("new_value").eqNullSafe(F.col("old_value")), "update")
    )
    return j.withColumn("action", action).where("action is not null").select(*keys, "action", "old_value", "new_value")


def revisions_to_write(src: DataFrame, tgt: DataFrame, keys: Sequence[str], value: str, rev_dt) -> DataFrame:
    """New revisions where the value differs from the active one; deletions as tombstones."""
    d = table_diff(src, active(tgt, keys), keys, value)
    return d.select(
        *keys,
        F.col("new_value").alias(value),
        F.lit(rev_dt).cast("date").alias("rev_dt"),
        F.when(F.col("action") == "terminate", "Y").otherwise("N").alias("rev_del_flag"),
    )


def revision_table(spark: SparkSession, path: str, keys: Sequence[T.StructField], value: T.StructField) -> CommittedTable:
    """A table of revisions by year, to be written by ``write_revisions`` only."""
    more = [T.StructField("rev_dt", T.DateType()), T.StructField("rev_del_flag", T.StringType()), T.StructField("year", T.IntegerType())]
    return CommittedTable(spark, path, T.StructType([*keys, value, *more]), "year")


def write_revisions(src: DataFrame, table: CommittedTable, keys: Sequence[str], value: str, rev_dt, dt: str = "dt", name: str | None = None) -> bool:
    """Append what ``src`` changes against the table's active rows, once for each ``name`` (the revision date unless
    given). A job that is killed leaves nothing visible; one that runs again after it has committed writes
    nothing and returns False."""
    name = name or f"{value}-{rev_dt}"
    return table.append(revisions_to_write(src, table.read(), keys, value, rev_dt).withColumn("year", F.year(dt)), name)


def sync_cumulative(src: DataFrame, tgt: DataFrame, key: str, dt: str, value: str, on_date, tolerance: float = 1e-9) -> DataFrame:
    """Scale the target's values up to a date by source / target on that date.

    Ids whose relative difference is under ``tolerance``, or missing on a side, give no rows.
    """
    d = F.lit(on_date).cast("date")
    s = src.where(F.col(dt) == d).select(key, F.col(value).alias("_s"))
    t = tgt.where(F.col(dt) == d).select(key, F.col(value).alias("_t"))
    scale = s.join(t, key).where(F.col("_t") != 0).select(key, (div(F.col("_s"), F.col("_t"))).alias("scale"))
    scale = scale.where(F.abs(F.col("scale") - 1) >= F.lit(tolerance))
    out = tgt.where(F.col(dt) <= d).join(scale, key)
    return out.withColumn(value, F.col(value) * F.col("scale")).drop("scale")


def merge_intervals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join touching or overlapping intervals of a key.

    Intervals that start on one day are first reduced to the longest, so a key's window
    holds at most one row per day.
    """
    keys = list(keys)
    d = spread(df.groupBy(*keys, "from_dt").agg(F.max("thru_dt").alias("thru_dt")), keys)
    w = W.partitionBy(*keys).orderBy("from_dt")
    d = d.withColumn("_reach", F.max("thru_dt").over(w.rowsBetween(W.unboundedPreceding, -1)))
    d = d.withColumn("_new", F.when(F.col("_reach").isNull() | (F.col("from_dt") > F.col("_reach")), 1).otherwise(0))
    d = d.withColumn("_g", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return d.groupBy(*keys, "_g").agg(F.min("from_dt").alias("from_dt"), F.max("thru_dt").alias("thru_dt")).drop("_g")
