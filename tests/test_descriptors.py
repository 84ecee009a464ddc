"""The catalogue's names and rules; values are held against SQL by the queries."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from riskloom.operators import descriptors as ds


def test_catalogue_by_rule(spark):
    all_ = ds.catalogue(["local", "world"], ["a", "b", "world"], "world")
    names = [d.name for d in all_]
    assert len(names) == len(set(names)) and {"momentum_12", "momentum_12x1", "beta_local_24", "sensitivity_a_36", "sensitivity_a_net_36"} <= set(names)
    assert not any(d.net and d.against == d.net for d in all_) and all(d.family in ds.FORMS for d in all_)
    t = ds.table(spark, all_).toPandas()
    assert t.id.is_unique and t.name.is_unique and {"quarterly", "annual"} == {n.rsplit("_", 1)[1] for n in t.name[len(all_) :]}
    assert len(ds.catalogue(["local", "regional", "world"], ["s0", "s1", "s2", "s3", "s4"], "world")) + len(ds.fundamental_catalogue()) > 140


def test_values_of_one_asset(spark):
    rng = np.random.default_rng(3)
    n = 40
    ret, m, s = rng.normal(0, 0.1, (3, n))
    pdf = pd.DataFrame({"asset_id": 1, "mi": np.arange(n), "ret": ret, "mcap": rng.uniform(1, 2, n), "volume": rng.integers(1, 9, n), "price": rng.uniform(1, 2, n), "m": m, "s": s})
    pdf.loc[35, "ret"] = np.nan
    df = spark.createDataFrame(pdf).selectExpr("asset_id", "mi", "nanvl(ret, NULL) AS ret", "mcap", "volume", "price", "m", "s")
    got = ds.build(df, ds.catalogue(["m"], ["s"], "m")).orderBy("mi").toPandas().iloc[-1]
    last = pdf.iloc[-24:].dropna()
    a = np.column_stack([np.ones(len(last)), last.s, last.m])
    assert got.sensitivity_s_net_24 == pytest.approx(np.linalg.lstsq(a, last.ret, rcond=None)[0][1])
    slope, icept = np.polyfit(last.m, last.ret, 1)
    assert got.beta_m_24 == pytest.approx(slope) and got.alpha_m_24 == pytest.approx(icept)
    left = last.ret - slope * last.m - icept
    assert got.residual_vol_m_24 == pytest.approx(np.sqrt((left**2).sum() / (len(last) - 2)))
    assert got.momentum_12x1 == pytest.approx((1 + pdf.ret.fillna(0)).iloc[-12:-1].prod() - 1)
    assert got.traded_24 == pytest.approx(23 / 24)


def test_too_few_values_and_no_spread(spark):
    rows = [(1, t, 0.0 if t > 1 else None, 1.0, 0, 1.0, 0.5, float(t)) for t in range(30)] + [(2, 0, 0.1, 0.0, 1, 2.0, 0.1, 0.2)]
    df = spark.createDataFrame(rows, "asset_id int, mi int, ret double, mcap double, volume int, price double, m double, s double")
    out = ds.build(df, ds.catalogue(["m"], ["s"], "m")).toPandas().set_index(["asset_id", "mi"])
    one, two = out.loc[(1, 29)], out.loc[(2, 0)]
    assert pd.isna(one.beta_m_24) and pd.isna(one.sensitivity_s_net_24) and one.sensitivity_s_24 == 0 and pd.isna(one.turnover_12) and pd.isna(one.amihud_12) and pd.isna(one.skewness_12)
    assert pd.isna(two.beta_m_24) and two.momentum_1 == pytest.approx(0.1) and pd.isna(two.high_low_3) and pd.isna(two.mean_return_12)


def test_fits_of_one_factor_and_window_share_their_sums(spark):
    df = spark.createDataFrame([(1, 1, 0.1, 0.2)], "asset_id int, mi int, ret double, m double")
    wanted = [ds.Descriptor(f"{f}_m_12", f, 12, against="m") for f in ("beta", "alpha", "residual_vol", "correlation")]
    plan = ds.build(df, wanted)._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [" in line)
    assert window.count("windowspecdefinition(") == 6


def odd_panel(spark, rng):
    """Assets with gaps, repeated steps, steps and keys without a value, zeros, constants and missing values."""
    rows = []
    for a in [None, *range(12)]:
        n = int(rng.integers(1, 70))
        steps = np.sort(rng.choice(np.arange(100), n, replace=False)).tolist()
        steps = [None, None, *steps, *steps[: n // 4]] if a in (1, 2) else [*steps, *([steps[-1] + 10**12] if a == 3 else [])]
        flat = a in (4, 5)
        for t in steps:
            maybe = lambda v, p=0.1: None if rng.random() < p else v
            ret = 0.1 if flat and rng.random() < 0.9 else float(rng.choice([0.0, rng.normal() * 0.1]))
            rows.append((a, t, maybe(ret), maybe(float(rng.integers(0, 4)), 0.2), maybe(int(rng.integers(0, 3))), maybe(float(rng.uniform(1, 2))), maybe(0.3 if a == 5 else float(rng.normal()) * 0.05), maybe(float(rng.normal()) * 0.05), "x"))
    return spark.createDataFrame(rows, "asset_id int, mi long, ret double, mcap double, volume int, price double, m double, s double, note string")


def test_batches_and_windows_are_the_same(spark, rng=np.random.default_rng(5)):
    df = odd_panel(spark, rng).withColumn("row", F.monotonically_increasing_id()).localCheckpoint()
    wanted = ds.catalogue(["m"], ["s"], "m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        one, two = (ds.build(df, wanted, many=many).orderBy("row").toPandas() for many in (10**9, 0))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert list(one.columns) == list(two.columns) and len(one) == df.count()
    pd.testing.assert_frame_equal(two, one, rtol=1e-9, atol=1e-12)
    assert one[[d.name for d in wanted]].notna().sum().min() > 0


def test_a_catalogue_does_not_go_over_every_frame(spark):
    df = spark.createDataFrame([(1, 1, 0.1, 1.0, 1, 1.0, 0.2, 0.1)], "asset_id int, mi int, ret double, mcap double, volume int, price double, m double, s double")
    plan = ds.build(df, ds.catalogue(["m"], ["s"], "m"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan and "MapInArrow" in plan
