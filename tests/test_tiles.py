"""Matrices in tiles against the same in one piece."""

import numpy as np
import pandas as pd
import pytest

from riskloom.functions import linalg
from riskloom.operators import risk as rk, tiles


@pytest.fixture
def rng():
    return np.random.default_rng(4)


def tiled(spark, groups, side):
    rows = [(g, r, c, float(m[r, c])) for g, m in groups.items() for r in range(len(m)) for c in range(len(m))]
    return tiles.from_entries(spark.createDataFrame(rows, "g string, r long, c long, v double"), side)


def whole(a, sizes):
    out = {g: np.zeros((n, n)) for g, n in sizes.items()}
    for x in tiles.to_entries(a).toPandas().itertuples():
        if max(x.r, x.c) < sizes[x.g]:
            out[x.g][x.r, x.c] = x.v
    return out


def test_eigenvalues_of_tiles(spark, rng):
    m = {g: np.cov(rng.normal(size=(n, n + 3))) - 0.3 * np.eye(n) for g, n in (("a", 17), ("b", 4), ("c", 10))}
    m["d"] = np.ones((9, 9))  # equal eigenvalues
    sizes = {g: len(x) for g, x in m.items()}
    got = [whole(x, sizes) for x in tiles.spectral(tiled(spark, m, 4), lambda v, top: np.maximum(v, 1e-8), lambda v, top: v / top)]
    for g, x in m.items():
        d, v = np.linalg.eigh(x)
        assert np.allclose(got[0][g], (v * np.maximum(d, 1e-8)) @ v.T, atol=1e-10)
        top = max(d.max(), 1.0 if sizes[g] % 4 else d.max())  # the padding's eigenvalue is 1
        assert np.allclose(got[1][g], x / top, atol=1e-10)


def test_transform_of_tiles(spark, rng):
    m, t = (linalg.unit_diagonal(np.corrcoef(rng.normal(size=(9, 12)))) for _ in range(2))
    got = whole(tiles.transform(tiled(spark, {"a": m}, 4), tiled(spark, {"a": t}, 4)), {"a": 9})["a"]
    assert np.allclose(got, linalg.block_transform(m, t)) and np.allclose(got @ m @ got.T, t)


def test_merged_groups_of_any_size_have_all_pairs(spark, rng):
    n, steps = 13, 30
    x = 0.6 * rng.normal(size=steps)[:, None] + rng.normal(size=(steps, n))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 12] = np.nan  # a line without returns
    issuer = [1, 1, 1, 1, 1, 2, 2, 2, 3, 3, 4, 1, 2]
    ret = spark.createDataFrame(pd.DataFrame([(i, t, float(x[t, i])) for t in range(steps) for i in range(n) if np.isfinite(x[t, i])], columns=["id", "t", "r"]))
    members = spark.createDataFrame([(issuer[i], i, 1) for i in range(n)] + [(9, 90, 9), (8, 91, 9)], "issuer long, id long, merged long")
    var = rng.uniform(0.5, 2, n)
    master = {1: 0, 2: 5, 3: 8}
    pairs = []
    for a in range(n):
        for b in range(a + 1, n):
            m = master.get(issuer[a])
            if issuer[a] == issuer[b] and (a, b) != (2, 3):
                c = float(rng.uniform(0.8, 0.95))
                pairs.append((issuer[a], a, b, c, c * float(np.sqrt(var[a] * var[b])), m, b if a == m else a if b == m else None))
    pairs = spark.createDataFrame(pairs, "issuer long, id1 long, id2 long, corr double, cov double, master long, line long")
    linked = {"variance": spark.createDataFrame([(i, float(var[i])) for i in range(n)] + [(90, 1.0), (91, 2.0)], "id long, spec_var double"), "pairs": pairs}
    run = lambda **o: rk.merged_covariance(ret, members, linked, "id", "issuer", "t", "r", steps, 40.0, **o).toPandas().sort_values(["merged", "id1", "id2"], ignore_index=True)
    want = run()
    assert len(want) == n * (n + 1) // 2 + 3 and want.dense.all()
    for most in (4, 6):  # with a block of an issuer in tiles, and in a task
        got = run(most=most, side=4)
        assert (got.dense == (got.merged == 9)).all()
        pd.testing.assert_frame_equal(got.drop(columns="dense"), want.drop(columns="dense"), rtol=0, atol=1e-6)
    one = want[want.merged == 1]
    m = np.zeros((n, n))
    m[one.id1, one.id2] = m[one.id2, one.id1] = one["corr"]
    assert np.linalg.eigvalsh(m).min() > 0 and abs(m[4, 9]) > 1e-3


def test_large_issuers_are_semidefinite_in_tiles(spark, rng):
    n = 11
    lines = spark.createDataFrame([(i, 1, 0) for i in range(n)] + [(50 + i, 2, 50) for i in range(3)], "id long, issuer long, master long")
    spec = spark.createDataFrame([(x.id, float(rng.uniform(0.9, 1.1))) for x in lines.collect()], "id long, spec_var double")
    fits = [(x.issuer, x.master, x.id, float(rng.uniform(0.67, 1.1)), 0.01, 60) for x in rk.linked_pairs(lines, "id", "issuer").orderBy("issuer", "master", "id").collect()]
    fits = spark.createDataFrame(fits, "issuer long, master long, id long, coef double, err_var double, n long")
    none = spark.createDataFrame([], "issuer long, master long, id long, corr double")
    want, got = (rk.linked_covariance(spec, fits, none, lines, "id", "issuer", most=most, side=4)["pairs"].toPandas().sort_values(["id1", "id2"], ignore_index=True) for most in (400, 5))
    assert len(want) == n * (n - 1) // 2 + 3
    pd.testing.assert_frame_equal(got, want, rtol=0, atol=1e-8)
