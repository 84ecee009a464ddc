"""Token ids in raw binary shards, with a minimal perfect hash index from document key to place.

A shard is one file of fixed-width little-endian ids, documents one after another in ascending doc_id
order over all shards. The index is dealt out by key hash into buckets of a bounded number of keys;
a bucket holds the bit levels of its hash and, by slot, a fingerprint, shard, offset and length. A
lookup tests a few bits, compares a fingerprint and reads one byte range of one file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import Scratch, mix, slices
from riskloom.llm.word_tokens import END_ID, encoder, in_groups
from riskloom.session import shared_dir

U = np.uint64
#: Keys in a bucket of the index, bits for each key at each level, levels at most.
KEYS, SPARE, LEVELS = 1 << 16, 2, 40
ENTRY = "shard int, file string, doc_id bigint, copy bigint, offset bigint, length bigint"
ENTRY_SCHEMA = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()), ("copy", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
INDEX = "bucket int, sizes array<int>, bits binary, prints binary, shards binary, offsets binary, lengths binary"


def open_store(folder: str):
    """File system and path of a shared folder; its scheme must be one that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}" if folder.startswith("/") else folder.replace("file:", "file://", 1))


def write_shards(docs: DataFrame, vocabulary: str, folder: str, width: int = 2) -> DataFrame:
    """Write the ids of (doc_id, text), each document closed by the end id, and return one entry a row.

    Null text is empty; a null doc_id comes first; rows of one doc_id follow each other by text and
    are told apart by ``copy``. A file is named by its task's attempt and only files of attempts whose
    entries were committed are ever read, so lost executors and repeated tasks do no harm.
    """
    kind = {2: "<u2", 4: "<u4"}[width]
    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())

    def run(batches):
        context = TaskContext.get()
        encode, end = encoder(vocabulary).encode, np.array([END_ID], "<u4").tobytes()
        fs, root = open_store(folder)
        name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}.ids"
        out, at, before, copy = None, 0, (), 0
        try:
            for b in slices(batches, 2048):
                ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
                for i, j in in_groups(texts, 1 << 22):
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(f"{root}/{name}")
                    rows = []
                    for doc, raw in zip(ids[i:j], encode(texts[i:j]), strict=True):
                        tokens = np.frombuffer(raw + end, "<u4")
                        if width == 2 and int(tokens.max()) > 0xFFFF:
                            raise ValueError("an id needs more than two bytes")
                        out.write(tokens.astype(kind).tobytes())
                        copy = copy + 1 if before == (doc,) else 0
                        before = (doc,)
                        rows.append((context.partitionId(), name, doc, copy, at, len(tokens)))
                        at += len(tokens)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ENTRY_SCHEMA, strict=True)], schema=ENTRY_SCHEMA)
        finally:
            if out is not None:
                out.close()

    return ordered.mapInArrow(run, ENTRY)


# --- minimal perfect hashing ------------------------------------------------------------------


def key_hash(doc_id: pa.Array, copy: pa.Array) -> np.ndarray:
    """64-bit keys, distinct for distinct doc_id of the same copy."""
    if isinstance(doc_id, pa.ChunkedArray):
        doc_id, copy = doc_id.combine_chunks(), copy.combine_chunks()
    with np.errstate(over="ignore"):
        h = mix(doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U)) + mix(copy.to_numpy(zero_copy_only=False).astype(np.int64).view(U) * U(0x9E3779B97F4A7C15))
        null = np.asarray(doc_id.is_null().to_numpy(zero_copy_only=False), bool)
        return mix(h ^ np.where(null, U(0x5851F42D4C957F2D), U(0)))


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys + U(level + 1) * U(0xD6E8FEB86659FD93)) % U(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys ^ U(0xA0761D6478BD642F)) >> U(32)).astype("<u4")


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit levels: at each, keys that meet no other set a bit, the rest go on to the next level."""
    levels, rest = [], keys
    for level in range(LEVELS):
        if not len(rest):
            return levels
        size = max(64, SPARE * len(rest))
        at = _place(rest, level, size)
        single = np.bincount(at, minlength=size) == 1
        levels.append(single)
        rest = rest[~single[at]]
    raise ValueError("keys are not distinct")


def slots(keys: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each key, from 0 to the number of keys; -1 for keys that no level holds."""
    out, base = np.full(len(keys), -1, np.int64), 0
    todo = np.arange(len(keys))
    for level, bits in enumerate(levels):
        at = _place(keys[todo], level, len(bits))
        rank = np.cumsum(bits)
        hit = bits[at]
        out[todo[hit]] = base + rank[at[hit]] - 1
        base += int(rank[-1])
        todo = todo[~hit]
    return out


def _bucket_of(t: pa.Table, buckets: int) -> np.ndarray:
    return (key_hash(t.column("doc_id"), t.column("copy")) % U(buckets)).astype(np.int32)


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` (doc_id, copy, ...) with the index bucket of their key."""
    names = [f.name for f in rows.schema]

    def run(batches):
        for b in batches:
            t = pa.table(b.columns, names=names)
            yield from t.append_column("bucket", pa.array(_bucket_of(t, buckets))).to_batches()

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", bucket int")


def build_index(entries: DataFrame, buckets: int) -> DataFrame:
    """One row for each bucket that has keys."""

    def run(t: pa.Table) -> pa.Table:
        keys = key_hash(t.column("doc_id"), t.column("copy"))
        levels = build_levels(keys)
        slot = slots(keys, levels)

        def by_slot(values, kind):
            out = np.empty(len(keys), kind)
            out[slot] = values
            return [out.tobytes()]

        col = lambda c: t.column(c).to_numpy()
        row = {
            "bucket": pa.array([t.column("bucket")[0].as_py()], pa.int32()),
            "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int32())),
            "bits": [np.packbits(np.concatenate(levels), bitorder="little").tobytes()],
            "prints": by_slot(fingerprints(keys), "<u4"), "shards": by_slot(col("shard"), "<i4"), "offsets": by_slot(col("offset"), "<i8"), "lengths": by_slot(col("length"), "<i8"),
        }
        return pa.table(row)

    keyed = with_bucket(entries.select("doc_id", "copy", "shard", "offset", "length"), buckets)
    return keyed.groupBy("bucket").applyInArrow(run, INDEX)


def locate(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, copy, shard, offset, length) of keys (doc_id, copy); keys that the index does not hold are left out."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        base = left.select(["doc_id", "copy"])
        if not right.num_rows or not left.num_rows:
            none = base.slice(0, 0)
            return none.append_column("shard", pa.array([], pa.int32())).append_column("offset", pa.array([], pa.int64())).append_column("length", pa.array([], pa.int64()))
        row = right.slice(0, 1).to_pylist()[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little").astype(bool)
        edges = np.cumsum([0, *row["sizes"]])
        keys = key_hash(left.column("doc_id"), left.column("copy"))
        slot = slots(keys, [bits[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])
        found = (slot >= 0) & (np.frombuffer(row["prints"], "<u4")[slot] == fingerprints(keys))
        at = slot[found]
        out = base.filter(pa.array(found))
        for name, field, kind in (("shard", "shards", "<i4"), ("offset", "offsets", "<i8"), ("length", "lengths", "<i8")):
            out = out.append_column(name, pa.array(np.frombuffer(row[field], kind)[at]))
        return out

    ddl = "doc_id bigint, copy bigint, shard int, offset bigint, length bigint"
    keyed = with_bucket(keys.select("doc_id", "copy"), buckets)
    return keyed.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(run, ddl)


def read_places(places: DataFrame, folder: str, width: int, take, ddl: str) -> DataFrame:
    """Read the ids of places (doc_id, copy, shard, file, offset, length, before) and give each
    ``take(place, ids)`` as a row; a task keeps one file open at a time."""
    kind = {2: "<u2", 4: "<u4"}[width]
    names = [part.split()[0] for part in ddl.split(", ")]

    def run(batches):
        fs, root = open_store(folder)
        name, file = None, None
        for b in slices(batches):
            rows = []
            for p in b.to_pylist():
                if p["file"] != name:
                    if file is not None:
                        file.close()
                    name, file = p["file"], fs.open_input_file(f"{root}/{p['file']}")
                raw = file.read_at(p["length"] * width, p["offset"] * width)
                if len(raw) != p["length"] * width:
                    raise ValueError(f"{name} is shorter than its index says")
                rows.append(take(p, np.frombuffer(raw, kind)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
        if file is not None:
            file.close()

    return places.sortWithinPartitions("file", "offset").mapInArrow(run, ddl)


def keyed_digest(docs: DataFrame, vocabulary: str, spark: SparkSession, scratch: Scratch, width: int = 2) -> DataFrame:
    """Write shards and index of ``docs``, look every document up by key and digest what its bytes hold:
    doc_id, start, n_tokens, ids_crc32. Repeated doc_ids give a row each; an empty table gives none."""
    import uuid

    folder = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    entries = scratch.keep(write_shards(docs, vocabulary, folder, width))
    buckets = max(1, -(-entries.count() // KEYS))
    index = scratch.keep(build_index(entries, buckets))
    # one row a shard: its file and the ids before it
    shards = entries.groupBy("shard", "file").agg(F.sum("length").alias("ids"))
    shards = shards.select("shard", "file", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    keys = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    places = locate(keys, index, buckets).join(shards, "shard")

    def take(p, ids):
        return p["doc_id"], p["before"] + p["offset"], p["length"], zlib.crc32(ids.astype("<u4").tobytes())

    return read_places(places, folder, width, take, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
