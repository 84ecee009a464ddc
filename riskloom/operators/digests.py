"""Differences of large tables by a tree of digests: equal ranges of keys are neither read nor joined.

A table is written in ranges of its keys' hash, with one small table of digests beside it: for every node of
a tree over the ranges the number of rows and sums of the rows' hashes. Two tables are compared level by
level; only the ranges under nodes that differ are read and joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.operators.bitemporal import table_diff
from riskloom.session import stored

#: Ranges of a table and children of a node; the last level has as many nodes as there are ranges.
RANGES, FAN = 256, 16
SEEDS = (11, 23)


def range_of(keys: Sequence[str], ranges: int = RANGES) -> Column:
    """The range of a row: the same for the same key in every table."""
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def _tree(leaves: DataFrame, ranges: int, fan: int) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ["n", *[f"h{i}" for i in range(2 * len(SEEDS))]]]
    out, level, width = leaves.withColumn("level", F.lit(0)), 0, ranges
    below = leaves
    while width > 1:
        level, width = level + 1, -(-width // fan)
        below = below.groupBy(F.floor(F.col("node") / fan).cast("int").alias("node")).agg(*sums)
        out = out.unionByName(below.withColumn("level", F.lit(level)))
    return out


def digests(rows: DataFrame, keys: Sequence[str], values: Sequence[str], ranges: int = RANGES, fan: int = FAN) -> DataFrame:
    """(level, node, n, h0..): digests of the ranges (level 0) and of all nodes above them up to one root.

    A row counts with two seeded 64-bit hashes of all its columns, null telling apart from every value; sums of their
    halves do not depend on order and see repeated rows. Different tables of one digest are as unlikely as
    a meeting of 128-bit hashes.
    """
    columns = [*keys, *values]
    gone = F.concat_ws("", *[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    hashes = [F.xxhash64(F.lit(s), gone, *columns) for s in SEEDS]
    halves = [h for x in hashes for h in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32))]
    leaves = rows.groupBy(range_of(keys, ranges).alias("node")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(halves)])
    return _tree(stored(leaves), ranges, fan)


def write_digested(rows: DataFrame, keys: Sequence[str], values: Sequence[str], path: str, ranges: int = RANGES, fan: int = FAN) -> None:
    """Write rows under ``{path}/rows`` by range, their digests under ``{path}/digests`` and their columns under ``{path}/schema``."""
    kept = rows.select(*keys, *values).withColumn("range", range_of(keys, ranges))
    kept.repartition("range").write.partitionBy("range").parquet(f"{path}/rows")
    back = rows.sparkSession.read.schema(rows.select(*keys, *values).schema).parquet(f"{path}/rows")
    digests(back, keys, values, ranges, fan).coalesce(1).write.parquet(f"{path}/digests")
    rows.select(*keys, *values).limit(0).coalesce(1).write.parquet(f"{path}/schema")  # an empty table has no range to tell it


def differing_ranges(spark: SparkSession, a: str, b: str, fan: int = FAN) -> list[int]:
    """Ranges whose digests differ, found from the root down; a range of one table only differs. Digests are as many
    as ranges, whatever the tables hold."""
    left, right = (spark.read.parquet(f"{p}/digests") for p in (a, b))
    top = max(int(d.agg(F.max("level")).first()[0] or 0) for d in (left, right))
    names = [c for c in left.columns if c not in ("level", "node")]
    open_: list[int] | None = None
    for level in range(top, -1, -1):
        x, y = (d.where(F.col("level") == level) for d in (left, right))
        if open_ is not None:
            under = F.floor(F.col("node") / fan).cast("int").isin(open_)
            x, y = x.where(under), y.where(under)
        both = x.select("node", F.struct(*names).alias("x")).join(y.select("node", F.struct(*names).alias("y")), "node", "full_outer")
        open_ = sorted(r.node for r in both.where(~F.col("x").eqNullSafe(F.col("y"))).select("node").collect())
        if not open_:
            return []
    return open_ or []


def read_ranges(spark: SparkSession, path: str, ranges: Sequence[int]) -> DataFrame:
    """Rows of some ranges; the folders of the others are not opened."""
    schema = spark.read.parquet(f"{path}/schema").schema.add("range", "integer")
    return spark.read.schema(schema).parquet(f"{path}/rows").where(F.col("range").isin(list(ranges))).drop("range")


def digest_diff(spark: SparkSession, src: str, tgt: str, keys: Sequence[str], value: str, fan: int = FAN) -> DataFrame:
    """``table_diff`` of two tables written by ``write_digested`` with the same keys and ranges."""
    found = differing_ranges(spark, src, tgt, fan)
    return table_diff(read_ranges(spark, src, found), read_ranges(spark, tgt, found), keys, value)
