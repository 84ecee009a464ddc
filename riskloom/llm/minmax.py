"""Near duplicates by min-max hashing: both the least and the greatest hash of a set under each permutation.

A permutation of the shingles' hashes gives two values of the signature, the smallest and the largest, so a
signature of 2 K values costs K hash evaluations a shingle; each value is shared by two sets with probability
equal to their similarity. Bands are made of the minima, or of the maxima, of ``ROWS`` permutations.

Sets that share a band are a list. Equal sets are one node throughout. Of every list, each node is first
compared with one centre (the smallest node, mostly the same one in all lists of a group). Lists whose nodes
are then not yet all connected are looked at in tiles of a bounded number of nodes: inside a task the signatures
say which pairs are worth a look, and only nodes with such a pair fetch their sets, which are compared exactly.
A pair belongs to the first band that its nodes share, so it is looked at once. Tasks give out links between
nodes that are not connected yet, never the pairs of a list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, U, attach, mix, semi, shingle_sets
from riskloom.llm.components import components

#: Similarity, in percent, from which sets link.
PERCENT = 85
#: Permutations in a band; bands, one half of minima and one of maxima. At the threshold two sets share no band
#: with probability (1 - 0.85 ** 6) ** 24 = 1.2e-5.
ROWS, BANDS = 6, 24
#: Values of a signature that two sets must share to be compared: 4.5 standard deviations under the
#: threshold's mean for independent values, which loses a link with probability 3.4e-6 (less for min-max pairs).
VALUES = ROWS * BANDS
FEWEST = int(np.floor(VALUES * PERCENT / 100 - 4.5 * np.sqrt(VALUES * PERCENT / 100 * (1 - PERCENT / 100))))
#: Nodes of one side of a tile.
TILE = 1024
#: Bits of a list's name that hold its band.
BAND_BITS = 5
#: Shingles whose hashes are evaluated together.
HELD = 1 << 18

PROFILE_DDL = "doc_id bigint, n bigint, node bigint, second bigint, sig binary, lists array<bigint>"
PROFILE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("second", pa.int64()), ("sig", pa.binary()), ("lists", pa.list_(pa.int64()))])
LINK_DDL = "a bigint, b bigint"
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _constants(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """An odd multiplier and a mask for each permutation."""
    with np.errstate(over="ignore"):
        k = np.arange(VALUES // 2, dtype=U) + U(1000 * seed)
        return mix(k * U(2) + U(1)) | U(1), mix(k * U(2) + U(2))


def signatures(sets: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """Minima (first half of the columns) and maxima of every non-empty set under all permutations."""
    times, mask = _constants(seed)
    all_ = np.concatenate(sets)
    start = np.append(0, np.cumsum([len(s) for s in sets])[:-1])
    half = len(times)
    out = np.empty((len(sets), 2 * half), U)
    with np.errstate(over="ignore"):
        for k in range(half):
            h = (all_ ^ mask[k]) * times[k]
            out[:, k] = np.minimum.reduceat(h, start)
            out[:, half + k] = np.maximum.reduceat(h, start)
    return out


def list_names(sig: np.ndarray, seed: int = 0) -> np.ndarray:
    """The list of each signature in each band, the band in the lowest bits."""
    name = np.empty((len(sig), BANDS), U)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            h = np.full(len(sig), U(band + 100 * seed + 1))
            for column in range(band * ROWS, (band + 1) * ROWS):
                h = mix(h * U(0xD6E8FEB86659FD93) + sig[:, column])
            name[:, band] = (h << U(BAND_BITS)) | U(band)
    return name.view(np.int64)


def set_keys(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    """Two 64-bit keys of a set, as signed numbers; 0 for the empty set."""
    with np.errstate(over="ignore"):
        one, two = (mix(shingles ^ mix(np.full(1, U(2 * seed + i + 77)))).sum(dtype=U) for i in range(2))
    return int(one.view(np.int64)), int(two.view(np.int64))


def profile(docs: DataFrame, seed: int) -> DataFrame:
    """A row for every document; signature and lists only at the first row that a task has of a set."""

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            rows, fresh, held = [], [], 0
            for doc, s in zip(b.column("doc_id").to_pylist(), shingle_sets(b.column("text")), strict=True):
                node, second = set_keys(s, seed)
                rows.append([doc, len(s), node, second, None, None])
                if len(s) and node not in seen:
                    seen.add(node)
                    fresh.append((len(rows) - 1, s))
                    held += len(s)
                if held > HELD:
                    _sign(rows, fresh, seed)
                    fresh, held = [], 0
            _sign(rows, fresh, seed)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PROFILE, strict=True)], schema=PROFILE)

    return docs.select("doc_id", "text").mapInArrow(run, PROFILE_DDL)


def _sign(rows: list[list], fresh: list[tuple[int, np.ndarray]], seed: int) -> None:
    if not fresh:
        return
    sig = signatures([s for _, s in fresh], seed)
    low = (sig >> U(8)).astype(np.uint8)  # one byte of each value; the lowest bits of a product mix least
    for (k, _), one, names in zip(fresh, low, list_names(sig, seed), strict=True):
        rows[k][4], rows[k][5] = one.tobytes(), names


def shared_values(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many values rows of x and rows of y share, and the first band that they share (BANDS if none)."""
    same = x == y
    whole = same.reshape(*same.shape[:-1], BANDS, ROWS).all(axis=-1)
    first = np.where(whole.any(axis=-1), whole.argmax(axis=-1), BANDS)
    return same.sum(axis=-1), first


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    small, large = min(len(x), len(y)), max(len(x), len(y))
    if 100 * small < PERCENT * large:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return (100 + PERCENT) * common >= PERCENT * (len(x) + len(y))


def _sets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, U) for x in column.to_pylist()]


def _alike(batches):
    """(a, b) of rows (a, b, sig_a, sig_b) whose signatures are alike enough."""
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, VALUES) for c in (2, 3))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=LINK).filter(pa.array((x == y).sum(axis=1) >= FEWEST))


def _compared(batches):
    """(a, b) of rows (a, b, set_a, set_b) that link."""
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            b = batch.slice(i, 512)
            ok = [linked(x, y) for x, y in zip(_sets(b.column(2)), _sets(b.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=LINK).filter(pa.array(ok, pa.bool_()))


def groups(batches, keys: int) -> Iterator[pa.Table]:
    """Whole groups, one after another, of batches sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)], axis=1)
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        edge = [0, *cut.tolist(), b.num_rows]
        for s, e in zip(edge[:-1], edge[1:], strict=True):
            if held and tuple(key[s]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = tuple(key[s])
    if held:
        yield pa.Table.from_batches(held)


def _worth(t: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Of a tile (list, i, j, side, node, root, sig ...): rows of one side and the rows of the other that are worth
    comparing with it: of another component, alike, and in no earlier list together. On the diagonal i = j every
    pair comes once."""
    band = t.column("list")[0].as_py() & ((1 << BAND_BITS) - 1)
    diagonal = t.column("i")[0].as_py() == t.column("j")[0].as_py()
    side, root = t.column("side").to_numpy(), t.column("root").to_numpy()
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(-1, VALUES)
    left = np.arange(len(root)) if diagonal else np.flatnonzero(side == 0)
    right = left if diagonal else np.flatnonzero(side == 1)
    for k, x in enumerate(left.tolist()):
        other = right[k + 1 :] if diagonal else right
        other = other[root[other] != root[x]]
        if not len(other):
            continue
        same, first = shared_values(sig[x], sig[other])
        other = other[(same >= FEWEST) & (first == band)]
        if len(other):
            yield x, other


TILE_DDL = "list bigint, i int, j int, side int, node bigint, root bigint, sig binary"


def _wanted(batches):
    """The rows of tiles that have a pair worth comparing."""
    for t in groups(batches, 3):
        keep = np.zeros(t.num_rows, bool)
        for x, other in _worth(t):
            keep[x] = True
            keep[other] = True
        if keep.any():
            yield from t.filter(pa.array(keep)).to_batches()


def _joined(batches):
    """Links of tiles with sets, at most one less than the components that a tile joins."""
    for t in groups(batches, 3):
        sets = _sets(t.column("shingles").combine_chunks())
        root, node = t.column("root").to_pylist(), t.column("node").to_pylist()
        top = {r: r for r in root}

        def find(r, top=top):
            while top[r] != r:
                top[r] = top[top[r]]
                r = top[r]
            return r

        a, b = [], []
        for x, other in _worth(t):
            for y in other.tolist():
                if find(root[x]) != find(root[y]) and linked(sets[x], sets[y]):
                    top[find(root[x])] = find(root[y])
                    a.append(node[x])
                    b.append(node[y])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=LINK)


def node_sets(docs: DataFrame, wanted: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """(node, shingles) once each for wanted (node, doc): a set is found by its document and known by its key."""

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                sets = list(shingle_sets(b.column("text").slice(i, 256)))
                yield pa.RecordBatch.from_arrays([pa.array([set_keys(s, seed)[0] for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])

    found = semi(docs, "doc_id", scratch.keep(wanted.select("doc").distinct())).select("text")
    keyed = found.mapInArrow(run, "node bigint, shingles binary")
    return scratch.keep(keyed.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def _pairs_with(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    left = side.select(F.col("node").alias("a"), F.col(column).alias("x"))
    right = side.select(F.col("node").alias("b"), F.col(column).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def _by_centres(member: DataFrame, sigs: DataFrame, sets, scratch: Scratch) -> DataFrame:
    """Links of nodes with the centre of a list they are in."""
    met = member.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    alike = scratch.keep(_pairs_with(met, sigs, "sig").mapInArrow(_alike, LINK_DDL))
    nodes = alike.select(F.col("a").alias("node")).union(alike.select(F.col("b").alias("node"))).distinct()
    return scratch.keep(_pairs_with(alike, sets(nodes), "shingles").mapInArrow(_compared, LINK_DDL))


def _by_tiles(member: DataFrame, roots: DataFrame, sigs: DataFrame, sets, scratch: Scratch) -> DataFrame:
    """Links between components of lists that hold more than one."""
    at = scratch.keep(member.join(roots, "node", "left").select("list", "node", F.coalesce("root", "node").alias("root")))
    mixed = at.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).filter("low < high").select("list", "n")
    slabs = F.ceil(F.col("n") / TILE).cast("int")
    rows = at.join(mixed, "list").withColumn("s", slabs).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("s")).cast("int"))
    # a node meets every slab of its list: once as the lower and once as the upper side of a tile
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("s") - 1))).select(
        "list", F.least("mine", "o").alias("i"), F.greatest("mine", "o").alias("j"), (F.col("mine") > F.col("o")).cast("int").alias("side"), "node", "root"
    )
    tiles = rows.join(sigs, "node").select("list", "i", "j", "side", "node", "root", "sig")
    dealt = tiles.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j", "node")
    wanted = scratch.keep(dealt.mapInArrow(_wanted, TILE_DDL))
    full = wanted.join(sets(wanted.select("node").distinct()), "node").select("list", "i", "j", "side", "node", "root", "sig", "shingles")
    return scratch.keep(full.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j", "node").mapInArrow(_joined, LINK_DDL).distinct())


def link(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of (doc_id, text).

    A text without words, or null, has size 0 and is its own component; so is any document without a link.
    Rows of equal sets are linked. ``component_id`` is the smallest doc_id that is not null of the component;
    rows with a null doc_id are linked like others and are not kept. Rows that share a doc_id are kept
    together. An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    for seed in range(8):
        profiles = scratch.keep(profile(docs, seed))
        nodes = profiles.groupBy("node").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.min("second").alias("low"), F.max("second").alias("high"))
        nodes = scratch.keep(nodes)
        if nodes.filter("low <> high").isEmpty():
            break
    else:
        raise ValueError("set keys meet under every seed")
    signed = profiles.filter("sig IS NOT NULL")
    entries = signed.select("node", F.explode("lists").alias("list"))
    # a list of one node has no pair; the smallest node is the centre
    shared = entries.groupBy("list").agg(F.min("node").alias("centre"), F.max("node").alias("high")).filter("centre < high").select("list", "centre")
    member = scratch.keep(entries.join(shared, "list").select("list", "node", "centre").distinct())
    sigs = scratch.keep(signed.select("node", "sig").join(member.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]))

    def sets(wanted: DataFrame) -> DataFrame:
        return node_sets(docs, nodes.join(wanted, "node").select("node", "doc"), seed, scratch)

    links = _by_centres(member, sigs, sets, scratch)
    roots = components(links, scratch)
    more = _by_tiles(member.select("list", "node"), roots, sigs, sets, scratch)
    if not more.isEmpty():
        roots = components(links.union(more), scratch)
    joined = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = joined.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = scratch.keep(joined.join(smallest, "root").select("node", "copies", "component_id"))
    total = nodes.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first().rows
    out = attach(profiles.select("doc_id", "n", "node"), named, "node", "copies", total)
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))  # documents without words are not linked
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
