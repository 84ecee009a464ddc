"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution; sizes are left to the cluster unless given."""
    b = (
        SparkSession.builder.appName("riskloom")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="riskloom-ship-"), "riskloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a fresh one only where that is unset and all tasks
    run on this machine. On a cluster a folder that executors do not share would lose data, so there an
    unset folder is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="riskloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint.

    Used between passes of iterated fits, on the small table of coefficients only.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as ``spark.sql.shuffle.partitions`` says.

    Adaptive execution joins small partitions to few, by the size of what is shuffled; where a stage then sorts
    the same rows several times, each of these tasks holds all its sorts. A number given here stays.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and read it back.

    For inputs that several passes will read: the passes then scan narrow columns instead of
    repeating the work that led to them, and a lost executor costs one scan.
    """
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
