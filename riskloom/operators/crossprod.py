"""Cross products inside Spark, small solves beside them.

Regressions never move a group's rows together: sums of products are map-side aggregates
(k(k+1)/2 of them for k columns), one row of sums per key comes out, and only that row,
whose size depends on k alone, is solved with numpy in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from riskloom.functions import linalg
from riskloom.functions.columns import div

VECTOR = T.ArrayType(T.DoubleType())
COLUMN_LIMIT = 14
# First-level groups of partial matrices for each key.
SALTS = 64
FLUSH_BYTES = 64 << 20  # partial matrices held by a task before it emits them


def cross_products(
    df: DataFrame,
    by: Sequence[str],
    xs: Sequence[str],
    y: str | None = None,
    w: str | None = None,
    intercept: bool = False,
) -> DataFrame:
    """Weighted sums of products per key over the complete rows.

    Output: keys, ``n``, ``sw``, ``xtx`` (k*k, row by row), and with ``y`` also ``xty``,
    ``yty``, ``sy``. An intercept is the first column. Up to :data:`COLUMN_LIMIT` columns
    the sums are generated code; beyond it tasks multiply Arrow batches with numpy.
    """
    by = list(by)
    need = [F.col(c).isNotNull() for c in [*xs, *([y] if y else []), *([w] if w else [])]]
    ok = need[0] if need else F.lit(True)
    for c in need[1:]:
        ok = ok & c
    one = F.lit(1.0)
    cols: list[Column] = ([one] if intercept else []) + [F.col(c) for c in xs]
    wt = F.col(w) if w else one
    k = len(cols)
    if k > COLUMN_LIMIT:
        return _blocked_products(df.where(ok), by, cols, y, wt)
    aggs = [F.count("*").alias("n"), F.sum(wt).alias("sw")]
    for i in range(k):
        for j in range(i, k):
            aggs.append(F.sum(wt * cols[i] * cols[j]).alias(f"_p{i}_{j}"))
        if y:
            aggs.append(F.sum(wt * cols[i] * F.col(y)).alias(f"_q{i}"))
    if y:
        aggs += [F.sum(wt * F.col(y) * F.col(y)).alias("yty"), F.sum(wt * F.col(y)).alias("sy")]
    g = df.where(ok).groupBy(*by).agg(*aggs)
    xtx = F.array(*[F.col(f"_p{min(i, j)}_{max(i, j)}") for i in range(k) for j in range(k)])
    out = [*by, "n", "sw", xtx.alias("xtx")]
    if y:
        out += [F.array(*[F.col(f"_q{i}") for i in range(k)]).alias("xty"), "yty", "sy"]
    return g.select(*out)


def _blocked_products(df: DataFrame, by: list[str], cols: list[Column], y: str | None, wt: Column) -> DataFrame:
    """Cross products of many columns: partial matrices per task and key, then their sum.

    What is shuffled is one k x k matrix per key and task, never the rows.
    """
    k = len(cols)
    src = df.select(
        *by, *[c.cast("double").alias(f"_x{i}") for i, c in enumerate(cols)],
        (F.col(y).cast("double") if y else F.lit(0.0)).alias("_y"), wt.cast("double").alias("_w"),
    )
    xs = [f"_x{i}" for i in range(k)]
    schema = ", ".join([f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by] + ["n bigint", "sw double", "sy double", "yty double", "xtx array<double>", "xty array<double>"])

    def emit(part: dict) -> pd.DataFrame:
        rows = [(*key, int(a[0]), a[1], a[2], a[3], m.ravel(), q) for key, (a, m, q) in part.items()]
        return pd.DataFrame(rows, columns=[*by, "n", "sw", "sy", "yty", "xtx", "xty"])

    def partial(batches):
        part: dict = {}
        for pdf in batches:
            groups = pdf.groupby(by, sort=False, dropna=False) if by else [((), pdf)]
            for key, g in groups:
                key = key if isinstance(key, tuple) else (key,)
                x, v, w = g[xs].to_numpy(), g["_y"].to_numpy(), g["_w"].to_numpy()
                xw = x * w[:, None]
                a = np.array([len(g), w.sum(), w @ v, (w * v) @ v])
                have = part.get(key)
                new = (a, xw.T @ x, xw.T @ v)
                part[key] = new if have is None else tuple(p + q for p, q in zip(have, new))
            if len(part) * k * k * 8 > FLUSH_BYTES:
                yield emit(part)
                part = {}
        if part:
            yield emit(part)

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.iloc[[0]][by].copy()
        for c in ("n", "sw", "sy", "yty"):
            out[c] = pdf[c].sum()
        for c in ("xtx", "xty"):
            out[c] = [np.sum(np.stack(pdf[c].to_list()), axis=0)]
        return out

    # two levels of sums, so that the matrices of all tasks never meet in one group
    salted = src.mapInPandas(partial, schema).withColumn("_salt", F.spark_partition_id() % SALTS)
    g = salted.groupBy(*by, "_salt").applyInPandas(total, schema).groupBy(*by).applyInPandas(total, schema)
    return g if y else g.drop("xty", "yty", "sy")


@pandas_udf(VECTOR)
def solve_normal(xtx: pd.Series, xty: pd.Series) -> pd.Series:
    """Coefficients from normal equations, one small system per row."""
    return pd.Series([linalg.solve_sym(np.asarray(a, float), np.asarray(b, float)) for a, b in zip(xtx, xty)])


@pandas_udf(VECTOR)
def inverse_sym(xtx: pd.Series) -> pd.Series:
    """Pseudo-inverse of each k x k matrix, row by row."""
    out = []
    for a in xtx:
        a = np.asarray(a, float)
        k = int(round(np.sqrt(a.size)))
        out.append(np.linalg.pinv(a.reshape(k, k), hermitian=True).ravel())
    return pd.Series(out)


@pandas_udf(VECTOR)
def nonneg_solve(xtx: pd.Series, xty: pd.Series) -> pd.Series:
    """Non-negative least squares on the normal equations."""
    return pd.Series([linalg.nnls_normal(np.asarray(a, float), np.asarray(b, float)) for a, b in zip(xtx, xty)])


def dot(coef: str, xs: Sequence[str], intercept: bool = False) -> Column:
    """Fitted value: coefficients (an array column) times columns."""
    cols = ([F.lit(1.0)] if intercept else []) + [F.col(c) for c in xs]
    out = F.col(coef)[0] * cols[0]
    for i, c in enumerate(cols[1:], 1):
        out = out + F.col(coef)[i] * c
    return out


def gram(df: DataFrame, row: str, col: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Gramian over rows: ``sum over row of value[i] * value[j]`` for column pairs i, j.

    ``col`` has a bounded number of levels (dates of a window, or factors). Each row's values
    become one vector; tasks multiply whole batches of vectors with numpy and emit partial
    matrices, which Spark adds up. Missing counts as zero. Output: by, ``i``, ``j``, ``value``,
    with ``i`` and ``j`` levels of ``col`` as strings.
    """
    by = list(by)
    vec = df.where(F.col(value).isNotNull()).groupBy(*by, row).agg(
        F.collect_list(F.struct(F.col(col).cast("string").alias("k"), F.col(value).cast("double").alias("v"))).alias("vec")
    )
    key = F.concat_ws("\u0001", *[F.col(b).cast("string") for b in by]) if by else F.lit("")
    vec = vec.select(key.alias("g"), F.col("vec.k").alias("ks"), F.col("vec.v").alias("vs"))

    def partial(batches):
        total: dict = {}
        for pdf in batches:
            for g, part in pdf.groupby("g", sort=False):
                names = sorted({k for ks in part["ks"] for k in ks})
                at = {k: i for i, k in enumerate(names)}
                m = np.zeros((len(part), len(names)))
                for r, (ks, vs) in enumerate(zip(part["ks"], part["vs"])):
                    m[r, [at[k] for k in ks]] = vs
                have = total.setdefault(g, ([], np.zeros((0, 0))))
                total[g] = linalg.add_labelled(have, (names, m.T @ m))
        for g, (names, m) in total.items():
            n = len(names)
            yield pd.DataFrame(
                {"g": g, "i": np.repeat(names, n), "j": np.tile(names, n), "value": m.ravel()}
            )

    out = vec.mapInPandas(partial, "g string, i string, j string, value double")
    out = out.groupBy("g", "i", "j").agg(F.sum("value").alias("value"))
    if not by:
        return out.drop("g")
    parts = F.split("g", "\u0001")
    return out.select(
        *[parts[i].cast(df.schema[b].dataType).alias(b) for i, b in enumerate(by)], "i", "j", "value"
    )


def pack_matrix(df: DataFrame, i: str, j: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Long matrix to one row per key: sorted ``names`` and ``values`` (k*k, row by row, gaps 0).

    For matrices whose side is a number of factors or dates, never of assets.
    """
    cells = df.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(F.col(i).cast("string").alias("i"), F.col(j).cast("string").alias("j"), F.col(value).alias("v")))).alias("cells")
    )

    @pandas_udf("struct<names:array<string>,values:array<double>>")
    def dense(cells: pd.Series) -> pd.DataFrame:
        names_out, values_out = [], []
        for c in cells:
            names = sorted({x["i"] for x in c} | {x["j"] for x in c})
            at = {k: n for n, k in enumerate(names)}
            m = np.zeros((len(names), len(names)))
            for x in c:
                m[at[x["i"]], at[x["j"]]] = 0.0 if x["v"] is None else x["v"]
            names_out.append(names)
            values_out.append(m.ravel())
        return pd.DataFrame({"names": names_out, "values": values_out})

    d = cells.withColumn("_d", dense("cells"))
    return d.select(*by, F.col("_d.names").alias("names"), F.col("_d.values").alias("values"))


def unpack_matrix(df: DataFrame, names: str, values: str, by: Sequence[str] = (), out: str = "value") -> DataFrame:
    """The reverse of :func:`pack_matrix`: columns ``f1``, ``f2`` and ``out``."""
    k = F.size(names)
    e = df.select(*by, names, F.posexplode(values).alias("_p", out))
    return e.select(
        *by,
        F.element_at(F.col(names), (F.floor(div(F.col("_p"), F.size(names))) + 1).cast("int")).alias("f1"),
        F.element_at(F.col(names), (F.col("_p") % F.size(names) + 1).cast("int")).alias("f2"),
        out,
    )
