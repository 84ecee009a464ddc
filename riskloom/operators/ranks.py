"""Order statistics and running totals over groups of any size.

A window over one date sorts the whole cross-section in one task, and the built-in
``percentile`` keeps every distinct value of a group in one buffer. Neither holds when a
single date carries a third of all rows. Here values are first counted in buckets whose
number does not grow with the data; only the buckets that contain a wanted position are
looked at again. Results are exact.

``history=True`` says that a group is one key's dated series (at most one row per date, so
bounded by the calendar); then a plain window is the cheaper plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.session import stored

SCALE = 1e6
RESOLUTION = 256


def order_bucket(v: Column) -> Column:
    """Bucket number that never decreases with ``v``: 0 for zero, logarithmic each side.

    ``log1p`` is semi-monotonic, so equal or larger values never fall in a lower bucket.
    About 10,000 buckets a side cover 1e-6 to 1e12.
    """
    size = F.floor(F.log1p(F.abs(v) * F.lit(SCALE)) * F.lit(RESOLUTION)) + 1
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("long")


def _position(p: float, n: Column, method: str) -> Column:
    """Zero-based fractional position of percentile ``p`` among ``n`` sorted values."""
    if method == "hazen":
        pos = F.lit(float(p)) * n / F.lit(100.0) - F.lit(0.5)
    elif method == "linear":
        pos = F.lit(float(p)) / F.lit(100.0) * (n - 1)
    else:
        raise ValueError(f"unknown percentile method {method!r}")
    return F.greatest(F.lit(0.0), F.least(pos, (n - 1).cast("double")))


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    points: Mapping[str, float],
    method: str = "hazen",
    history: bool = False,
    count: str | None = None,
) -> DataFrame:
    """Percentiles of ``value`` per ``keys``, one output column per entry of ``points``.

    Missing values are ignored; ``count`` names a column with the multiplicity of a row.
    Output: keys, ``n`` (values used) and the named columns.
    """
    keys = list(keys)
    m = F.col(count).cast("long") if count else F.lit(1).cast("long")
    x = df.select(*keys, F.col(value).cast("double").alias("_v"), m.alias("_m"))
    x = x.where(F.col("_v").isNotNull() & (F.col("_m") > 0))
    if history:
        w = W.partitionBy(*keys)
        upto = w.orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
        ranked = x.select(
            *keys, "_v", F.sum("_m").over(w).alias("_n"), F.sum("_m").over(upto).alias("_e"), "_m"
        ).withColumn("_s", F.col("_e") - F.col("_m"))
    else:
        x = x.withColumn("_b", order_bucket(F.col("_v")))
        w = W.partitionBy(*keys)
        hist = x.groupBy(*keys, "_b").agg(F.sum("_m").alias("_c"))
        hist = hist.select(
            *keys,
            "_b",
            "_c",
            F.sum("_c").over(w).alias("_n"),
            (
                F.sum("_c").over(w.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)) - F.col("_c")
            ).alias("_o"),
        )
        wanted = F.lit(False)
        for p in points.values():
            lo = F.floor(_position(p, F.col("_n"), method))
            # the wanted positions are lo and lo + 1
            wanted = wanted | ((lo + 1 >= F.col("_o")) & (lo < F.col("_o") + F.col("_c")))
        hit = hist.where(wanted).select(*keys, "_b", "_o", "_n")
        inside = (
            _join_null_safe(x, hit, keys + ["_b"])
            .groupBy(*keys, "_b", "_o", "_n", "_v")
            .agg(F.sum("_m").alias("_c"))
        )
        wb = W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
        ranked = inside.withColumn("_e", F.col("_o") + F.sum("_c").over(wb)).withColumn(
            "_s", F.col("_e") - F.col("_c")
        )
    aggs = []
    for i, p in enumerate(points.values()):
        pos = _position(p, F.col("_n"), method)
        lo = F.floor(pos)
        hi = F.least(lo + 1, F.col("_n") - 1)
        aggs += [
            F.max(F.when((lo >= F.col("_s")) & (lo < F.col("_e")), F.col("_v"))).alias(f"_l{i}"),
            F.max(F.when((hi >= F.col("_s")) & (hi < F.col("_e")), F.col("_v"))).alias(f"_h{i}"),
        ]
    out = ranked.groupBy(*keys, "_n").agg(*aggs)
    cols = []
    for i, (name, p) in enumerate(points.items()):
        pos = _position(p, F.col("_n"), method)
        cols.append(
            (
                F.col(f"_l{i}") + (pos - F.floor(pos)) * (F.col(f"_h{i}") - F.col(f"_l{i}"))
            ).alias(name)
        )
    return out.select(*keys, F.col("_n").alias("n"), *cols)


def median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median", history: bool = False) -> DataFrame:
    """Median per key (mean of the middle two)."""
    return percentiles(df, keys, value, {name: 50.0}, "linear", history)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``; with none, the right side is a single row per construction."""
    if keys:
        return left.join(right, list(keys), how)
    return left.withColumn("_one", F.lit(1)).join(right.withColumn("_one", F.lit(1)), "_one", how).drop("_one")


def running_by_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    id_col: str,
    sums: Mapping[str, str] | None = None,
    descending: bool = True,
    numeric_id: bool = True,
) -> DataFrame:
    """Rank and running sums inside each key, in order of ``order`` then ``id_col``.

    Adds ``rank`` (from 1), ``n`` (group size) and, for each ``name: column`` of ``sums``,
    ``name`` (running total including the row) and ``name_total``. The work of a group is
    split by value bucket, and rows tied at zero by id range, so no task sees a whole group.
    Rows with a null in ``order`` are left out.
    """
    keys = list(keys)
    sums = dict(sums or {})
    sign = -1 if descending else 1
    x = df.where(F.col(order).isNotNull()).withColumn("_b", order_bucket(F.col(order).cast("double")) * sign)
    tie = F.floor(F.col(id_col) / F.lit(1_000_000)) if numeric_id else F.lit(0)
    x = x.withColumn("_t", F.when(F.col("_b") == 0, tie).otherwise(F.lit(0)).cast("long"))
    cells = x.groupBy(*keys, "_b", "_t").agg(
        F.count("*").alias("_c"), *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()]
    )
    w = W.partitionBy(*keys)
    before = w.orderBy("_b", "_t").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select(
        *keys,
        "_b",
        "_t",
        F.sum("_c").over(w).alias("n"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c0"),
        *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0.0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_s_{n}").over(w).alias(f"{n}_total") for n in sums],
    )
    x = x.join(cells, keys + ["_b", "_t"])
    o = F.col(order).desc() if descending else F.col(order).asc()
    wi = W.partitionBy(*keys, "_b", "_t").orderBy(o, F.col(id_col))
    run = wi.rowsBetween(W.unboundedPreceding, 0)
    x = x.withColumn("rank", (F.row_number().over(wi) + F.col("_c0")).cast("long"))
    for n, c in sums.items():
        x = x.withColumn(n, F.coalesce(F.sum(c).over(run), F.lit(0.0)) + F.col(f"_o_{n}"))
    return x.drop("_b", "_t", "_c0", *[f"_o_{n}" for n in sums])


def scale_of_mad() -> float:
    """Fixed value: the normal-consistency divisor of a median absolute deviation."""
    return 0.67449


def limit_zeros(df: DataFrame, keys: Sequence[str], value: str, zero_tolerance: float) -> DataFrame:
    """Non-zero values with multiplicity 1, and one row per key for the zeros that count.

    Zeros count up to ``zero_tolerance`` times the number of values; with a tolerance of 0
    none does. Output: keys, ``_x``, ``_m``.
    """
    v = F.col(value)
    v = F.when(F.abs(v) < 1e-12, F.lit(0.0)).otherwise(v)
    x = df.select(*keys, v.alias("_x")).where(F.col("_x").isNotNull())
    if zero_tolerance == 0:
        return x.where(F.col("_x") != 0).withColumn("_m", F.lit(1).cast("long"))
    allowed = F.floor(F.lit(float(zero_tolerance)) * F.count("*"))
    zeros = x.groupBy(*keys).agg(
        F.least(F.sum(F.when(F.col("_x") == 0, 1).otherwise(0)), allowed).cast("long").alias("_m")
    )
    rest = x.where(F.col("_x") != 0).withColumn("_m", F.lit(1).cast("long"))
    return rest.unionByName(zeros.where("_m > 0").withColumn("_x", F.lit(0.0)).select(*keys, "_x", "_m"))


def mad_bounds(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    n_dev: float,
    zero_tolerance: float = 0.25,
    history: bool = False,
) -> DataFrame:
    """Median, MAD scale and clip bounds per key, surplus zeros left out.

    Several passes read the values, so the (key, value) pairs are stored once. Keys with
    fewer than two values get no row. Output: keys, ``centre``, ``scale``,
    ``lower``, ``upper``.
    """
    keys = list(keys)
    x = limit_zeros(stored(df.select(*keys, value)), keys, value, zero_tolerance)
    med = percentiles(x, keys, "_x", {"centre": 50.0}, "linear", history, "_m")
    med = med.where("n > 1").drop("n")
    dev = _join_null_safe(x, med, keys).select(*keys, F.abs(F.col("_x") - F.col("centre")).alias("_x"), "_m")
    mad = percentiles(dev, keys, "_x", {"_mad": 50.0}, "linear", history, "_m").drop("n")
    out = _join_null_safe(med, mad, keys).withColumn("scale", F.col("_mad") / F.lit(scale_of_mad()))
    return out.select(
        *keys,
        "centre",
        "scale",
        (F.col("centre") - F.lit(float(n_dev)) * F.col("scale")).alias("lower"),
        (F.col("centre") + F.lit(float(n_dev)) * F.col("scale")).alias("upper"),
    )


def spread_bounds(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    n_dev: float,
    lo: float = 25.0,
    hi: float = 75.0,
    zero_tolerance: float = 1.0,
    history: bool = False,
) -> DataFrame:
    """Bounds at Hazen percentiles ``lo`` and ``hi`` moved out by ``n_dev`` times their distance."""
    keys = list(keys)
    x = limit_zeros(stored(df.select(*keys, value)), keys, value, zero_tolerance)
    q = percentiles(x, keys, "_x", {"q_lo": lo, "q_hi": hi}, "hazen", history, "_m").where("n > 1")
    spread = F.col("q_hi") - F.col("q_lo")
    return q.select(
        *keys,
        "q_lo",
        "q_hi",
        (F.col("q_lo") - F.lit(float(n_dev)) * spread).alias("lower"),
        (F.col("q_hi") + F.lit(float(n_dev)) * spread).alias("upper"),
    )
