"""Sources chosen by configuration, and sub-indexes against a plain loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import aggregates as ag, catalogue as ct


def registry():
    reg = ct.Registry()
    reg.register("plus", lambda d, p: d.withColumn("v", F.col("v") + float(p["by"])), by="0")
    return reg


def test_configured_sections(spark):
    t = spark.createDataFrame([(1, 1.0), (2, None)], "k int, v double")
    u = spark.createDataFrame([(1, 5.0), (2, 7.0)], "k int, v double")
    text = "[DEFAULT]\nkeys = k\nvalue = v\n[a]\nsources = plus:t, plus:u:by=1\nlogic = first\n[b]\nsources = plus:t:by=3, plus:u\nlogic = min\n"
    got = {(r.section, r.k): r.value for r in ct.configured(text, registry(), {"t": t, "u": u}).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 8.0, ("b", 1): 4.0, ("b", 2): 7.0}
    assert ct.configured(text, registry(), {"t": t, "u": u}, ["b"]).select("section").distinct().count() == 1


@pytest.mark.parametrize("text", ["", "[a]\nsources = plus:t\nkeys = k\nvalue = v\n", "[a]\nsources = nope:t\nkeys = k\nvalue = v\nlogic = max\n", "[a]\nsources = plus:nope\nkeys = k\nvalue = v\nlogic = max\n", "[a]\nsources = plus:t\nkeys = k\nvalue = v\nlogic = eval\n"])
def test_faulty_sections(spark, text):
    with pytest.raises(KeyError):
        ct.configured(text, registry(), {"t": spark.createDataFrame([(1, 1.0)], "k int, v double")})


def test_subindexes_against_a_loop(spark):
    rng = np.random.default_rng(4)
    stages = [("core", 3, None, 9), ("core", 3, 8, 9), ("large", 6, 16, 20), ("mid", 30, 30, 32)]
    rows = [(d, i, float(rng.integers(1, 40)), float(rng.integers(1, 40)), bool(rng.random() < 0.8)) for d in range(4) for i in range(50 if d else 5)]
    out = ag.replicate_subindexes(spark.createDataFrame(rows, "d int, id int, cap double, vol double, ok boolean"), ["d"], "id", "cap", "vol", stages, "ok")
    got = {(r.d, r.id): r.sub_index for r in out.collect()}
    for d in range(4):
        mine = [r for r in rows if r[0] == d]
        cap = [r[1] for r in sorted(mine, key=lambda r: (-(r[2] if r[4] else 0), r[1]))]
        vol = [r[1] for r in sorted(mine, key=lambda r: (-r[3], r[1]))]
        taken = {}
        for name, n, caps, volumes in stages:
            new = [i for i in cap[:caps] if i in vol[:volumes] and i not in taken][:n]
            new += [i for i in vol[:volumes] if i not in taken and i not in new][: n - len(new)]
            taken.update(dict.fromkeys(new, name))
        assert {i: taken.get(i, "small" if ok else None) for _, i, _, _, ok in mine} == {i: got[d, i] for _, i, *_ in mine}
