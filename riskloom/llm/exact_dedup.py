"""Exact dedup by two passes over a Bloom filter: only rows whose hash may repeat are shuffled.

The filter has two planes, "set once" and "set again", in segments of 65,536 bits; a hash picks one
segment and two bits in it. Tasks fill planes for their own rows, planes of one segment are merged by
(once, again) + (once', again') = (once | once', again | again' | once & once'). A row whose two bits
are both set again may have an equal; every other row is known to be alone and passes straight through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, attach

SEGMENT_BITS = 1 << 16
BITS_PER_ROW = 8
#: Segments at most: the filter that is broadcast has no more than 32 MB. Beyond 33 million rows more
#: rows are sent on as possible repeats; the result stays exact.
MOST_SEGMENTS = 1 << 12


def normalised(text: Column) -> Column:
    """The text without blanks and the characters 9 to 13; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _bits(h: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (h & np.uint64(segments - 1)).astype(np.int64), (h >> np.uint64(20)) & np.uint64(0xFFFF), (h >> np.uint64(40)) & np.uint64(0xFFFF)


def _plane(positions: np.ndarray) -> np.ndarray:
    bits = np.zeros(SEGMENT_BITS, np.uint8)
    bits[positions] = 1
    return np.packbits(bits, bitorder="little")


def _fill(segments: int):
    """Planes of a task's rows: one row per touched segment. Equal hashes of a task set a bit again,
    and so do different hashes that meet in a bit."""

    def run(batches):
        parts = [b.column(0).to_numpy().view(np.uint64) for b in batches]
        h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(h):
            return
        h, times = np.unique(h, return_counts=True)
        seg, p, q = _bits(h, segments)
        # a hash whose two bits are one bit sets it once
        slot = np.concatenate([seg * SEGMENT_BITS + p.astype(np.int64), (seg * SEGMENT_BITS + q.astype(np.int64))[p != q]])
        count = np.concatenate([times, times[p != q]])
        slot, where = np.unique(slot, return_inverse=True)
        count = np.bincount(where, count)
        edge = np.searchsorted(slot, np.arange(segments + 1) * SEGMENT_BITS)
        for s in np.flatnonzero(np.diff(edge)):
            at = slot[edge[s] : edge[s + 1]] - s * SEGMENT_BITS
            again = at[count[edge[s] : edge[s + 1]] > 1]
            small = len(at) < SEGMENT_BITS // 32
            rows = [at.astype("<u2").tobytes(), again.astype("<u2").tobytes()] if small else [_plane(at).tobytes(), _plane(again).tobytes()]
            yield pa.RecordBatch.from_pylist([{"seg": int(s), "listed": small, "once": rows[0], "again": rows[1]}], FILL)

    return run


FILL = pa.schema([("seg", pa.int32()), ("listed", pa.bool_()), ("once", pa.binary()), ("again", pa.binary())])


def _merge(batches):
    """Merged planes of the segments of a partition, as 64-bit words; holds 16 kB a segment."""
    planes: dict[int, list[np.ndarray]] = {}
    for b in batches:
        for s, listed, once, again in zip(*(c.to_pylist() for c in b.columns), strict=True):
            one, two = (_plane(np.frombuffer(x, "<u2")) if listed else np.frombuffer(x, np.uint8) for x in (once, again))
            if s in planes:
                had = planes[s]
                planes[s] = [had[0] | one, had[1] | two | (had[0] & one)]
            else:
                planes[s] = [one, two]
    for s, (_, two) in planes.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([two.view("<i8")], pa.list_(pa.int64()))], names=["__seg", "__again"])


def again_plane(hashes: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """First pass. ``hashes`` has one 64-bit column; returns (__seg int, __again array of 1024 longs) and the number of segments."""
    segments = 1
    while segments < MOST_SEGMENTS and segments * SEGMENT_BITS < rows * BITS_PER_ROW:
        segments *= 2
    filled = hashes.mapInArrow(_fill(segments), "seg int, listed boolean, once binary, again binary")
    return filled.repartition("seg").mapInArrow(_merge, "__seg int, __again array<bigint>"), segments


def flagged(rows: DataFrame, hash_col: str, plane: DataFrame, segments: int) -> DataFrame:
    """Second pass: ``rows`` with __maybe, false where the hash is certainly alone. The plane is at
    most ``MOST_SEGMENTS`` x 8 kB, so it is broadcast whatever the input."""
    h = F.col(hash_col)

    def again(shift: int) -> Column:
        p = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(0xFFFF))
        return F.getbit(F.get("__again", F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1

    joined = rows.withColumn("__seg", h.bitwiseAND(F.lit(segments - 1)).cast("int")).join(F.broadcast(plane), "__seg", "left")
    return joined.withColumn("__maybe", F.coalesce(again(20) & again(40), F.lit(False))).drop("__seg", "__again")


def decisions(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. Of equal texts the row with most code points stays, then the smallest
    doc_id (null last). Rows that repeat in full: they share the group, and each row whose doc_id is
    the kept one is reported as kept. An empty table gives no rows.
    """
    d = docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("chars"), digest(F.col("text")).alias("text_sha256"))
    d = scratch.keep(d.withColumn("h", F.xxhash64("text_sha256")))
    total = d.count()
    plane, segments = again_plane(d.select("h"), total)
    d = flagged(d, "h", scratch.keep(plane), segments)
    alone = d.filter(~F.col("__maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = d.filter("__maybe")
    order = F.struct(F.col("chars"), F.col("doc_id").isNotNull(), -F.col("doc_id"))
    groups = maybe.groupBy("text_sha256").agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = scratch.keep(groups.select("text_sha256", (-F.col("best.col3")).alias("keep_id"), "group_size"))
    met = attach(maybe, groups, "text_sha256", "group_size", total).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return alone.unionByName(met)


def dedup(docs: DataFrame, scratch: Scratch, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without copies, all columns kept.

    Exactly one row of each group of equal texts stays, by the order of ``decisions``; further ties
    (one doc_id, as many code points) fall to the larger text, then to any of the fully equal rows.
    Rows that are certainly alone are not shuffled.
    """
    keys = ["__sha", "__h"]
    d = docs.withColumn("__sha", digest(F.col(text_col))).withColumn("__h", F.xxhash64("__sha"))
    hashes = scratch.keep(d.select("__h"))
    plane, segments = again_plane(hashes, hashes.count())
    d = flagged(d, "__h", scratch.keep(plane), segments)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.char_length(F.coalesce(F.col(text_col), F.lit(""))), F.col(id_col).isNotNull(), -F.col(id_col), F.col(text_col))
    best = d.filter("__maybe").groupBy("__sha").agg(F.max_by(row, order).alias("__row")).select("__row.*")
    return d.filter(~F.col("__maybe")).drop("__maybe", *keys).unionByName(best)
