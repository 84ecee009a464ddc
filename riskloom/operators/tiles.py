"""Symmetric matrices of many lines as square tiles, so no task holds a whole one.

A matrix is rows (g, i, j, t): tile (i, j) of group ``g``, ``side`` x ``side`` numbers. What lies beyond the last line is
padded with the identity, which takes no part. Products join tiles; eigenvalues come from one-sided Jacobi rotations
of strips (all rows of ``side`` columns), two strips a task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.session import stored

#: Sweeps of rotations until an error is raised; they converge quadratically, mostly in less than ten.
MOST_SWEEPS = 60


def _square(t: bytes) -> np.ndarray:
    m = np.frombuffer(t)
    return m.reshape(int(round(m.size**0.5)), -1)


def _key(df: DataFrame) -> str:
    return "g " + df.schema["g"].dataType.simpleString()


def from_entries(entries: DataFrame, side: int) -> DataFrame:
    """Tiles of rows (g, r, c, v) with positions from 0; what is not given is 0, and 1 on the diagonal."""

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        g, i, j = key
        t = np.eye(side) if i == j else np.zeros((side, side))
        t[pdf["r"].to_numpy() - i * side, pdf["c"].to_numpy() - j * side] = pdf["v"].to_numpy(float)
        return pd.DataFrame({"g": [g], "i": [i], "j": [j], "t": [t.tobytes()]})

    at = entries.select("g", "r", "c", "v", F.expr(f"cast(r div {side} as int)").alias("i"), F.expr(f"cast(c div {side} as int)").alias("j"))
    return at.groupBy("g", "i", "j").applyInPandas(pack, f"{_key(entries)}, i int, j int, t binary")


def to_entries(a: DataFrame) -> DataFrame:
    """Rows (g, r, c, v) of all tiles, with those of the padding."""

    def unpack(frames):
        for pdf in frames:
            for g, i, j, t in pdf[["g", "i", "j", "t"]].itertuples(index=False):
                m = _square(t)
                r, c = np.indices(m.shape)
                yield pd.DataFrame({"g": g, "r": r.ravel() + i * len(m), "c": c.ravel() + j * len(m), "v": m.ravel()})

    return a.select("g", "i", "j", "t").mapInPandas(unpack, f"{_key(a)}, r long, c long, v double")


def multiply(a: DataFrame, b: DataFrame, transposed: bool = False) -> DataFrame:
    """a b, or a b'; a tile that is not there is zero."""

    @pandas_udf("binary")
    def product(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([(_square(p) @ (_square(q).T if transposed else _square(q))).tobytes() for p, q in zip(x, y)])

    @pandas_udf("binary")
    def total(x: pd.Series) -> bytes:
        return np.sum([np.frombuffer(t) for t in x], axis=0).tobytes()

    k, j = ("j", "i") if transposed else ("i", "j")
    y = b.select("g", F.col(k).alias("k"), F.col(j).alias("j"), F.col("t").alias("y"))
    z = a.select("g", "i", F.col("j").alias("k"), F.col("t").alias("x")).join(y, ["g", "k"])
    return z.select("g", "i", "j", product("x", "y").alias("t")).groupBy("g", "i", "j").agg(total("t").alias("t"))


def unit_diagonal(a: DataFrame) -> DataFrame:
    """Rows and columns divided by the roots of their diagonal."""

    @pandas_udf("array<double>")
    def root(t: pd.Series) -> pd.Series:
        return pd.Series([np.sqrt(np.diag(_square(x))) for x in t])

    @pandas_udf("binary")
    def divide(t: pd.Series, r: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([(_square(x) / np.outer(p, q)).tobytes() for x, p, q in zip(t, r, c)])

    d = a.where("i = j").select("g", "i", root("t").alias("r"))
    z = a.join(d, ["g", "i"]).join(d.select("g", F.col("i").alias("j"), F.col("r").alias("c")), ["g", "j"])
    return z.select("g", "i", "j", divide("t", "r", "c").alias("t"))


def spectral(a: DataFrame, *fns: Callable[[np.ndarray, float], np.ndarray]) -> list[DataFrame]:
    """The symmetric matrix with its eigenvalues replaced by ``fn(values, the largest)``, for each ``fn``.

    The matrix is shifted by twice its Frobenius norm, so that its columns are as good as independent; rotations
    from the right then make them orthogonal, and each is an eigenvector times its shifted value. A task holds two strips.
    """
    a = stored(a.select("g", "i", "j", "t"))

    @pandas_udf("double")
    def squares(t: pd.Series) -> pd.Series:
        return pd.Series([float(np.square(np.frombuffer(x)).sum()) for x in t])

    groups = a.groupBy("g").agg((2 * F.sqrt(F.sum(squares("t")))).alias("s"), (F.max("i") + 1).alias("k"))
    schema = f"{_key(a)}, p int, k int, s double, off double, w binary"

    def strip(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        g, p = key
        k, s, side = int(pdf["k"].iloc[0]), float(pdf["s"].iloc[0]), len(_square(pdf["t"].iloc[0]))
        w = np.zeros((k * side, side))
        for i, t in zip(pdf["i"], pdf["t"]):
            w[i * side : (i + 1) * side] = _square(t)
        w[p * side : (p + 1) * side] += s * np.eye(side)
        return pd.DataFrame({"g": [g], "p": [p], "k": [k], "s": [s], "off": [0.0], "w": [w.tobytes()]})

    def rotate(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("p")
        k, s = int(pdf["k"].iloc[0]), float(pdf["s"].iloc[0])
        w = np.hstack([_strip(x, k) for x in pdf["w"]])
        gram = w.T @ w
        off = float(np.linalg.norm(gram - np.diag(np.diag(gram)))) / s**2
        w = w @ np.linalg.eigh(gram)[1][:, ::-1]
        return pdf.assign(off=np.maximum(pdf["off"], off), w=[x.tobytes() for x in np.hsplit(w, len(pdf))])

    strips = a.join(groups, "g").groupBy("g", F.col("j").alias("p")).applyInPandas(strip, schema)
    rounds = groups.agg(F.max(F.col("k") + F.col("k") % 2)).first()[0] or 0
    for sweep in range(MOST_SWEEPS if rounds else 0):
        # all pairs of strips, as in a round-robin tournament; an odd strip is alone for a round
        strips = strips.withColumn("off", F.lit(0.0))
        for r in range(rounds - 1):
            p, m = F.col("p"), F.col("k") + F.col("k") % 2 - 1
            rest = F.lit(r) % m
            other = F.when(p == m, rest).when(p == rest, m).otherwise(F.pmod(2 * rest - p, m))
            strips = strips.groupBy("g", F.least(p, other).alias("_pair")).applyInPandas(rotate, schema)
        strips = stored(strips)
        if strips.agg(F.max("off")).first()[0] <= 1e-9:
            break
    else:
        if rounds:
            raise ArithmeticError(f"eigenvectors did not settle in {MOST_SWEEPS} sweeps")

    @pandas_udf("double")
    def top(w: pd.Series, k: pd.Series, s: pd.Series) -> pd.Series:
        return pd.Series([float(np.linalg.norm(_strip(x, int(y)), axis=0).max()) - z for x, y, z in zip(w, k, s)])

    strips = strips.join(strips.groupBy("g").agg(F.max(top("w", "k", "s")).alias("top")), "g")

    def parts(fn):
        def cut(frames):
            for pdf in frames:
                for g, p, k, s, w, most in pdf[["g", "p", "k", "s", "w", "top"]].itertuples(index=False):
                    w = _strip(w, k)
                    size = np.linalg.norm(w, axis=0)
                    v = w / size
                    x = v * fn(size - s, most)
                    yield pd.DataFrame({"g": g, "i": range(k), "j": p, "t": [b.tobytes() for b in np.vsplit(x, k)], "u": [b.tobytes() for b in np.vsplit(v, k)]})

        return cut

    out = []
    for fn in fns:
        x = strips.mapInPandas(parts(fn), f"{_key(a)}, i int, j int, t binary, u binary")
        out.append(stored(multiply(x, x.select("g", "i", "j", F.col("u").alias("t")), transposed=True)))
    return out


def _strip(w: bytes, k: int) -> np.ndarray:
    m = np.frombuffer(w)
    side = int(round((m.size / k) ** 0.5))
    return m.reshape(k * side, side)


def floored(values: np.ndarray, top: float, floor: float = 1e-8) -> np.ndarray:
    """Eigenvalues not under the floor."""
    return np.maximum(values, floor)


def root(values: np.ndarray, top: float) -> np.ndarray:
    """Roots of eigenvalues, tiny ones dropped."""
    return np.where(values > 1e-12 * max(top, 1e-300), np.sqrt(np.maximum(values, 0.0)), 0.0)


def inverse_root(values: np.ndarray, top: float) -> np.ndarray:
    """Inverse roots of eigenvalues, tiny ones dropped."""
    keep = values > 1e-12 * max(top, 1e-300)
    return np.where(keep, 1 / np.sqrt(np.where(keep, values, 1.0)), 0.0)


def semidefinite(a: DataFrame) -> DataFrame:
    """No eigenvalue under 1e-8 and ones on the diagonal."""
    return stored(unit_diagonal(spectral(a, floored)[0]))


def transform(block: DataFrame, target: DataFrame) -> DataFrame:
    """T with T block T' = target that moves least: block^(-1/2) (block^(1/2) target block^(1/2))^(1/2) block^(-1/2)."""
    half, back = spectral(block, root, inverse_root)
    inner = spectral(multiply(multiply(half, target), half), root)[0]
    return stored(multiply(multiply(back, inner), back))


def pair_correlation(values: DataFrame, lines: DataFrame, end: float, half_life: float, side: int) -> DataFrame:
    """Weighted correlations about zero, each pair over the steps that both have.

    ``lines``: (g, r), positions of all lines; ``values``: (g, r, step, v). A task holds the histories of two blocks.
    """
    from riskloom.functions import linalg

    block = F.expr(f"cast(r div {side} as int)").alias("i")

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        g, i = key
        x = pdf.pivot_table(index="step", columns="r", values="v", aggfunc="last").reindex(columns=range(i * side, (i + 1) * side))
        return pd.DataFrame({"g": [g], "i": [i], "step": [x.index.to_numpy(float)], "x": [x.to_numpy(float).tobytes()]})

    packed = values.select("g", block, "r", F.col("step").cast("double").alias("step"), "v").groupBy("g", "i").applyInPandas(pack, f"{_key(values)}, i int, step array<double>, x binary")
    packed = stored(lines.select("g", block).distinct().join(packed, ["g", "i"], "left"))

    def correlate(frames):
        for pdf in frames:
            for g, i, j, s1, x1, s2, x2 in pdf[["g", "i", "j", "s1", "x1", "s2", "x2"]].itertuples(index=False):
                t = np.zeros((side, side))
                if x1 is not None and x2 is not None:
                    both, a, b = np.intersect1d(s1, s2, return_indices=True)
                    w = 0.5 ** ((end - both) / half_life)
                    t = linalg.cross_correlation(np.frombuffer(x1).reshape(-1, side)[a], np.frombuffer(x2).reshape(-1, side)[b], w)
                if i == j:
                    np.fill_diagonal(t, 1.0)
                    yield pd.DataFrame({"g": [g], "i": [i], "j": [j], "t": [t.tobytes()]})
                else:
                    yield pd.DataFrame({"g": [g, g], "i": [i, j], "j": [j, i], "t": [t.tobytes(), t.T.tobytes()]})

    one, two = (packed.select("g", F.col("i").alias(n), F.col("step").alias(f"s{k}"), F.col("x").alias(f"x{k}")) for n, k in (("i", 1), ("j", 2)))
    return one.join(two, "g").where("i <= j").mapInPandas(correlate, f"{_key(values)}, i int, j int, t binary")
