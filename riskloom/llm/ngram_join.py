"""Self-join of documents on the Jaccard similarity of their word shingles, by count vectors and blocks.

Every document's set of shingles becomes a point of counts by hash group, the bound of which prunes
pairs and boxes of an R-tree. Points of large sets are much alike, so the tree over all documents would
visit nearly all pairs of like size; documents are therefore met in blocks first, without loss: the
shingles of every set are put in one common order, rare ones first, and two sets that link share one of
the first n - ceil(3 n / 4) + 1 of each. Documents of equal sets are one node throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, attach, let_go, mix, semi, shingle_sets
from riskloom.llm.count_tree import point
from riskloom.llm.near import connect, met_in_lists

U = np.uint64
#: Slots of the counts that order shingles, and the fewest occurrences in a task that are told. The
#: table of counts has at most 4 million entries of 8 bytes, whatever the input.
SLOT_BITS, TOLD = 22, 8
#: Shingles gathered in one bucket, and held by a task before it hands them on.
PER_BUCKET, HELD = 1_000_000, 2_000_000
PROFILE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("second", pa.int64()), ("point", pa.binary()), ("slots", pa.binary()), ("counts", pa.binary())])
PROFILE_DDL = "doc_id bigint, n bigint, node bigint, second bigint, point binary, slots binary, counts binary"


def set_keys(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    """Two 64-bit keys of a set, as signed numbers; 0 for the empty set."""
    with np.errstate(over="ignore"):
        one, two = (mix(shingles + U(2 * seed + i + 1) * U(0x9E3779B97F4A7C15)).sum(dtype=U) for i in range(2))
    return int(np.asarray(one, U).view(np.int64)), int(np.asarray(two, U).view(np.int64))


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles & U((1 << SLOT_BITS) - 1)).astype(np.int64)


def profile(docs: DataFrame, seed: int) -> DataFrame:
    """A row for each document: its size, set keys and point; and rows without a key for the frequent slots of a task."""

    def run(batches):
        let_go()
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        total = 0
        for b in batches:
            rows, seen = [], []
            for doc, s in zip(b.column("doc_id").to_pylist(), shingle_sets(b.column("text")), strict=True):
                node, second = set_keys(s, seed)
                rows.append((doc, len(s), node, second, point(s), None, None))
                seen.append(_slot(s))
                total += len(s)
                if len(seen) == 2000:
                    counts += np.bincount(np.concatenate(seen), minlength=len(counts))
                    seen = []
            if seen:
                counts += np.bincount(np.concatenate(seen), minlength=len(counts))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PROFILE, strict=True)], schema=PROFILE)
        often = np.flatnonzero(counts >= TOLD + 4 * (total >> SLOT_BITS))
        if len(often):
            row = (None, None, None, None, None, often.astype("<i4").tobytes(), counts[often].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, PROFILE, strict=True)], schema=PROFILE)

    return docs.select("doc_id", "text").mapInArrow(run, PROFILE_DDL)


def frequent(profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Slots that tasks have told, and their counts; at most 4 million of each."""

    def run(batches):
        for b in batches:
            for s, c in zip(b.column("slots").to_pylist(), b.column("counts").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s, "<i4")), pa.array(np.frombuffer(c, "<i8"))], names=["slot", "n"])

    told = profiles.filter("slots IS NOT NULL").select("slots", "counts").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    return told.column("slot").to_numpy(), told.column("n").to_numpy()


def prefix(shingles: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first n - ceil(3 n / 4) + 1 of a sorted set, in the order of (how often, hash)."""
    n = len(shingles)
    k = n - (3 * n + 3) // 4 + 1
    count = often[_slot(shingles)]
    return shingles[:k] if not count.any() else shingles[np.argsort(count, kind="stable")[:k]]


BLOCK = pa.schema([("bucket", pa.int32()), ("tokens", pa.binary()), ("nodes", pa.binary()), ("sizes", pa.binary())])


def blocks(docs: DataFrame, seed: int, buckets: int, told) -> DataFrame:
    """Prefix shingles of every document, packed by bucket of their hash."""

    def run(batches):
        let_go()
        slots, counts = told.value
        often = np.zeros(1 << SLOT_BITS, np.int64)
        often[slots] = counts
        seen: set[int] = set()
        tokens, nodes, sizes, held = [], [], [], 0
        for b in batches:
            for s in shingle_sets(b.column("text")):
                if not len(s):
                    continue
                node = set_keys(s, seed)[0]
                if node in seen:  # a copy in this task
                    continue
                seen.add(node)
                first = prefix(s, often)
                tokens.append(first)
                nodes.append(np.full(len(first), node, np.int64))
                sizes.append(np.full(len(first), len(s), np.int32))
                held += len(first)
                if held > HELD:
                    yield from _packed(tokens, nodes, sizes, buckets)
                    tokens, nodes, sizes, held = [], [], [], 0
        if held:
            yield from _packed(tokens, nodes, sizes, buckets)

    return docs.select("text").mapInArrow(run, "bucket int, tokens binary, nodes binary, sizes binary")


def _packed(tokens, nodes, sizes, buckets):
    token, node, size = np.concatenate(tokens), np.concatenate(nodes), np.concatenate(sizes)
    at = (token % U(buckets)).astype(np.int32)
    order = np.argsort(at, kind="stable")
    edge = np.searchsorted(at[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(edge)):
        rows = order[edge[k] : edge[k + 1]]
        # half of the hash is enough inside a bucket: shingles that meet by chance only add candidates
        blob = [(token[rows] >> U(32)).astype("<u4").tobytes(), node[rows].tobytes(), size[rows].astype("<i4").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), *(pa.array([x], pa.binary()) for x in blob)], schema=BLOCK)


def _lists(t: pa.Table) -> pa.Table:
    """Distinct lists of the nodes that share a shingle of this bucket, cut where sizes are too far apart."""
    token, node, size = (np.frombuffer(b"".join(t.column(c).to_pylist()), kind) for c, kind in (("tokens", "<u4"), ("nodes", "<i8"), ("sizes", "<i4")))
    order = np.argsort(token, kind="stable")
    sorted_ = token[order]
    same = sorted_[1:] == sorted_[:-1]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    token, node, size = token[order], node[order], size[order]
    order = np.lexsort((node, size, token))
    token, node, size = token[order], node[order], size[order]
    new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])]) if len(token) else np.zeros(0, bool)
    token, node, size = token[new], node[new], size[new]
    if not len(token):
        return pa.table({"list": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})
    cut = np.concatenate([[True], (token[1:] != token[:-1]) | (4 * size[:-1].astype(np.int64) < 3 * size[1:].astype(np.int64))])
    run = np.cumsum(cut) - 1
    length = np.bincount(run)
    keep = length[run] > 1
    run, node = run[keep], node[keep]
    if not len(run):
        return pa.table({"list": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})
    start = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    with np.errstate(over="ignore"):
        name = np.add.reduceat(mix(node.view(U)), start)  # equal lists have equal names
    _, first = np.unique(name, return_index=True)
    ends = np.append(start[1:], len(run))
    rows = np.concatenate([np.arange(start[i], ends[i]) for i in first])
    name = np.repeat(name[first], ends[first] - start[first])
    return pa.table({"list": pa.array(name.view(np.int64)), "node": pa.array(node[rows])})


def link(docs: DataFrame, scratch: Scratch, k: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of (doc_id, text).

    A text without words, or null, has size 0 and is its own component; so is any document without a
    link. Rows of equal sets are linked. ``component_id`` is the smallest doc_id that is not null of the
    component; rows with a null doc_id are linked like others. An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    for seed in range(8):
        profiles = scratch.keep(profile(docs, seed))
        rows = profiles.filter("node IS NOT NULL")
        nodes = rows.groupBy("node").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.min("second").alias("low"), F.max("second").alias("high"), F.first("point").alias("point"))
        nodes = scratch.keep(nodes)
        if nodes.filter("low <> high").isEmpty():
            break
    else:
        raise ValueError("set keys meet under every seed")
    told = docs.sparkSession.sparkContext.broadcast(frequent(profiles))
    sums = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("shingles"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
    buckets = max(8, sums.shingles // (4 * PER_BUCKET) + 1)
    lists, met = met_in_lists(blocks(docs, seed, buckets, told), _lists, scratch)

    def texts(wanted: DataFrame) -> DataFrame:
        return node_texts(docs, nodes.join(wanted, "node").select("node", "doc"), seed, scratch)

    roots = connect(lists, met, nodes.select("node", "point"), texts, scratch)
    joined = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = joined.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = scratch.keep(joined.join(smallest, "root").select("node", "copies", "component_id"))
    out = attach(rows.select("doc_id", "n", "node"), named, "node", "copies", sums.rows)
    # documents without words are not linked with each other
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def leaders(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each connected group is kept: the one with the
    smallest doc_id. All columns stay. Rows without a doc_id stay; rows that share a doc_id stay or go
    together, and go if none of them leads its group.
    """
    found = scratch.keep(link(docs, scratch))
    led = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("leads"))
    gone = scratch.keep(led.filter("leads = 0").select(F.col("doc_id").alias("__gone")))
    return semi(docs, "doc_id", gone, "left_anti")


def node_texts(docs: DataFrame, wanted: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """(node, text), once each, for wanted (node, doc): a text is found by its document and known by its key."""

    def run(batches):
        let_go()
        for b in batches:
            keys = [set_keys(s, seed)[0] for s in shingle_sets(b.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), b.column("text")], names=["node", "text"])

    found = semi(docs, "doc_id", scratch.keep(wanted.select("doc").distinct())).select("text")
    keyed = found.mapInArrow(run, "node bigint, text string")
    return keyed.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])
