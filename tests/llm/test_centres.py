"""Centres of lists are found where the lists are made."""

import numpy as np
import pyarrow as pa

from riskloom.llm import near


def test_rows_of_centres_do_not_grow_with_lists(spark, scratch):
    from riskloom.session import ship

    ship(spark)
    rng = np.random.default_rng(5)
    rows = [(k % 2, k, int(n)) for k in range(90) for n in rng.choice(200, int(rng.integers(2, 150)), replace=False)]
    rows += [(1, k, n) for b, k, n in rows if b == 0 and k < 10]  # lists that two buckets make
    buckets = spark.createDataFrame(rows, "bucket int, list long, node long").repartition(40)
    lists, met = near.met_in_lists(buckets, lambda t: t.select(["list", "node"]).sort_by([("list", "ascending"), ("node", "ascending")]), scratch)
    assert sorted(map(tuple, lists.collect())) == sorted({r[1:] for r in rows})
    made = spark.read.parquet(scratch.paths[0]).filter("turn IS NOT NULL").count()
    assert made <= 2 * near.CENTRES * 200
    one = pa.table(list(zip(*sorted({r[1:] for r in rows}), strict=True)), names=["list", "node"])
    want = {(x, turn): c for b in near._centres(one.to_batches()) for x, turn, _, c in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    assert {(r.node, r.turn): r.centre for r in met.collect()} == want
