"""Incremental forms of the daily steps on Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.operators.bitemporal import newest
from riskloom.session import shared_dir
from riskloom.sources.manifest import CompactedLog

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet folder (or one file pattern) as a stream, schema taken from the files."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def run_available(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process what is there now into a parquet table of the shared folder and read it. State is kept in RocksDB,
    which reads single entries."""
    spark = stream.sparkSession
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    out = f"{base}/data"
    q = (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{base}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
    )
    try:
        q.awaitTermination()
    finally:
        spark.conf.set(STORE, before) if before else spark.conf.unset(STORE)
    return spark.read.schema(stream.schema).parquet(out)


#: Steps of one block of a cumulative stream's state.
BLOCK = 64


class Cumulative(StatefulProcessor):
    """Cumulative returns of one id, kept in blocks of ``BLOCK`` steps.

    A block holds its steps, returns and the cumulative values before and after it; a second value holds the first and
    the last block and a version. A row at the end reads and writes the last block; a late or corrected one
    reads and writes its own block and those after it, never those before it.
    """

    def __init__(self, key: str, step: str, ret: str):
        self.names = (key, step, ret)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.span = handle.getValueState("span", "first bigint, last bigint, version bigint")
        self.blocks = handle.getMapState("blocks", "block bigint", "before double, after double, steps array<bigint>, rets array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        id_, step, ret = self.names
        x = pd.concat(list(rows)).dropna(subset=[step])
        new: dict[int, dict[int, float]] = {}
        for s, r in zip(x[step], x[ret]):
            new.setdefault(int(s) // BLOCK, {})[int(s)] = 0.0 if pd.isna(r) else float(r)
        out = []
        if new:
            b0, known = min(new), self.span.get()
            first, last, version = known if known else (b0, b0 - 1, 0)
            version += 1
            begin = min(new[b0])
            cum = self._before(b0, first, last)
            for b in range(b0, max(last, max(new)) + 1):
                old = self.blocks.getValue((b,)) if first <= b <= last else None
                if old is not None:
                    _, _, steps, rets = old
                elif b in new:
                    steps, rets = [], []
                else:
                    continue
                have = dict(zip(steps, rets)) | new.get(b, {})
                before, steps = cum, sorted(have)
                for s in steps:
                    cum *= 1.0 + have[s]
                    if s >= begin:
                        out.append((s, cum))
                self.blocks.updateValue((b,), (before, cum, steps, [have[s] for s in steps]))
            self.span.update((min(first, b0), max(last, max(new)), version))
            yield pd.DataFrame({id_: [key[0]] * len(out), step: [s for s, _ in out], "cum": [c for _, c in out], "version": [version] * len(out)})

    def _before(self, b: int, first: int, last: int) -> float:
        """The cumulative value before block ``b``: of itself, or after the nearest one ahead of it."""
        for a in range(min(b, last), first - 1, -1):
            old = self.blocks.getValue((a,))
            if old is not None:
                return old[0] if a == b else old[1]
        return 1.0

    def close(self) -> None:
        pass


def stream_cumulative(stream: DataFrame, key: str, step: str, ret: str) -> DataFrame:
    """Cumulative return per id and step as returns arrive, in any order; ids start at 1.

    A late or corrected return replaces the stored one and every step from there on comes out again under a higher
    ``version``; of equal steps in one batch the last value wins. A missing return counts as 0, a missing step
    for nothing. ``latest`` takes the result's newest. Run it by ``run_available``, which sets the state store.
    """
    kt, st = stream.schema[key].dataType.simpleString(), stream.schema[step].dataType.simpleString()
    return stream.select(key, step, ret).groupBy(key).transformWithStateInPandas(Cumulative(key, step, ret), f"{key} {kt}, {step} {st}, cum double, version bigint", "Append", "None")


def latest(log: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of each step of a cumulative stream's output."""
    return log.groupBy(*keys).agg(F.max_by("cum", "version").alias("cum"))


def _into(log: CompactedLog, stream: DataFrame, checkpoint: str, reduce) -> CompactedLog:
    """Append each available batch to the log; its number is the batch's, so a batch that is run again is known."""
    q = stream.writeStream.foreachBatch(lambda batch, i: log.append(reduce(batch), int(i)) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return log


def stream_active(stream: DataFrame, keys: list[str], rev_col: str, del_col: str, base: str | None = None, fanout: int = 8) -> DataFrame:
    """Latest revision per key as batches arrive; late revisions lose by ``rev_col``.

    Each batch is reduced to its newest row per key and appended to a compacted log: a read opens a few folders
    however many batches have come, and the log holds about one row a key and level. Deleted keys stay as
    tombstones, because an older revision may still arrive. With the same ``base`` a later call goes on.
    """
    spark = stream.sparkSession
    base = base or f"{shared_dir(spark)}/active-{uuid.uuid4().hex}"

    def reduce(rows: DataFrame) -> DataFrame:
        return newest(rows, keys, [rev_col]).select(*stream.schema.names)

    log = _into(CompactedLog(spark, base, stream.schema, reduce, fanout), stream, f"{base}/checkpoint", lambda b: b)
    return log.read().where(F.col(del_col) == "N")


def merge_moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per group from several rows of counts, means and squared deviations."""
    n, weighted = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    mean = F.when(n > 0, weighted / n)
    about = F.sum("m2") + F.sum(F.col("n") * F.col("mean") * F.col("mean")) - F.when(n > 0, weighted * weighted / n)
    return rows.groupBy(*by).agg(n.alias("n"), mean.alias("mean"), F.greatest(about, F.lit(0.0)).alias("m2"), F.sum("rows").alias("rows"))


def stream_windows(stream: DataFrame, key: str, ts: str, value: str, length: str, slide: str, base: str | None = None, fanout: int = 8) -> DataFrame:
    """Mean, deviation and count per key over sliding windows of everything that has arrived.

    Each batch adds its own counts, means and squared deviations per window to a compacted log, whose rows are
    merged: late rows and open windows are never lost, and a read opens a few folders however many batches
    have come. With the same ``base`` a later call goes on.
    """
    spark = stream.sparkSession
    base = base or f"{shared_dir(spark)}/windows-{uuid.uuid4().hex}"
    by = ["start", "end", key]
    moments = [F.count(value).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("m2"), F.count("*").alias("rows")]
    kind = stream.schema[key]
    schema = T.StructType([T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType()), T.StructField(key, kind.dataType), T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()), T.StructField("rows", T.LongType())])

    def own(batch: DataFrame) -> DataFrame:
        x = batch.withColumn("_ts", F.col(ts).cast("timestamp")).groupBy(F.window("_ts", length, slide), key).agg(*moments)
        return x.select("window.start", "window.end", key, "n", "mean", "m2", "rows")

    log = _into(CompactedLog(spark, base, schema, lambda r: merge_moments(r, by), fanout), stream, f"{base}/checkpoint", own)
    n = F.col("n")
    return log.read().select("start", "end", key, "mean", F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("std"), F.col("rows").alias("n"))
